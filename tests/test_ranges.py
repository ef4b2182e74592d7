"""CSV files read in ranges against the reader that takes a task per file."""

import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from millrace.sources.files import read_csv_na
from millrace.sources.ranges import csv_records, read_csv_ranges
from millrace.sources.schemas import REVIEWS

HEADER = "reviewId,userName,content,score,thumbsUpCount,at,an odd, name"
FAILURES = (PySparkException, Py4JJavaError)


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few hundred bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def value(rng, end):
    text = "".join(rng.choice(["a", "é", "👍", ",", '"', end, end, "word ", "NA", ""]) for _ in range(rng.choice([0, 1, 3, 12, 400])))
    return '"' + text.replace('"', '""') + '"' if rng.random() < 0.2 or set(text) & set(',"\r\n') else text


def written(path, rng, n, end="\n", last=True):
    lines = [HEADER.replace("an odd, name", '"an ""odd"",' + end + 'name"')]
    for i in range(n):
        lines.append(",".join([f"r{i}", value(rng, end), value(rng, end), str(i % 6), "n/a", value(rng, end), value(rng, end)]))
        if rng.random() < 0.1:
            lines.append("")
    path.write_bytes((end.join(lines) + (end if last else "")).encode())


@pytest.mark.parametrize(("seed", "end", "last"), [(1, "\n", True), (2, "\r\n", True), (3, "\n", False), (4, "\r\n", False)])
def test_rows_of_the_other_reader(spark, rows, tmp_path, small_ranges, seed, end, last):
    rng = random.Random(seed)
    for name, n in (("a", 60), ("b", 0), ("c", 7)):
        written(tmp_path / f"{name}.csv", rng, n, end, last)
    got = read_csv_ranges(spark, str(tmp_path), REVIEWS)
    want = read_csv_na(spark, str(tmp_path), REVIEWS)
    assert got.schema == want.schema
    assert sorted(rows(got), key=repr) == sorted(rows(want), key=repr) and got.count() == 67
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10


def test_records_are_numbered_as_they_stand(spark, rows, tmp_path, small_ranges):
    (tmp_path / "x.csv").write_text('h\n"a\nb"\n\nc\n"' + "line\n" * 500 + '"\nd\n')
    got = sorted((r.record, r.value) for r in csv_records(spark, str(tmp_path)).collect())
    assert [v for _, v in got] == ["h", '"a\nb"', "c", '"' + "line\n" * 500 + '"', "d"]


@pytest.mark.parametrize("bad", ['r1,u,5" pipe,1,1,-\nr2,u,6" pipe,1,1,-\n', 'r1,u,"open,1,1,-\n', 'r1,u,"a"b,1,1,-\n', "r1,u,c,five,1,-\n"])
def test_what_cannot_be_told_apart_fails(spark, tmp_path, bad):
    (tmp_path / "bad.csv").write_text(",".join(REVIEWS.names) + "\n" + bad)
    with pytest.raises(FAILURES):
        read_csv_ranges(spark, str(tmp_path / "bad.csv"), REVIEWS).collect()


def test_headers(spark, rows, tmp_path):
    names = REVIEWS.names
    (tmp_path / "zero.csv").write_text("")
    assert read_csv_ranges(spark, str(tmp_path / "zero.csv"), REVIEWS).schema.names == names
    assert rows(read_csv_ranges(spark, str(tmp_path / "zero.csv"), REVIEWS)) == []
    (tmp_path / "a.csv").write_text(",".join(names) + "\nr1,u,c,1,1,-")
    (tmp_path / "only.csv").write_text(",".join(names))
    assert rows(read_csv_ranges(spark, str(tmp_path / "only.csv"), REVIEWS)) == []
    assert rows(read_csv_ranges(spark, str(tmp_path / "[ao]*.csv"), REVIEWS)) == [("r1", "u", "c", 1, 1, "-")]
    (tmp_path / "b.csv").write_text(",".join([names[1], names[0], *names[2:]]) + "\nr1,u,c,1,1,-\n")
    with pytest.raises(FAILURES):
        read_csv_ranges(spark, str(tmp_path / "[ab].csv"), REVIEWS).collect()
