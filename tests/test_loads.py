import glob
import json
import xml.etree.ElementTree as ET
from datetime import date, datetime
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.describe import preview, profile
from millrace.operators.keyed import insert_if_absent, latest_per_key, upsert
from millrace.plans import rooms as rooms_plan
from millrace.sinks import constraints, exports, published, tables
from millrace.sources import files, jdbc
from millrace.sources.schemas import BOM, REVIEWS, ROOM_LENGTHS, ROOMS, STUDENT_LENGTHS, STUDENTS


def text(path):
    return "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/part-*")))


# --- sources -----------------------------------------------------------------------


def test_jdbc_options_split_on_the_registered_key():
    options = jdbc.jdbc_options("jdbc:x", "public.rental", jdbc.FILM_TABLES["rental"], 5, 900, 10, {"user": "u"})
    assert options == {
        "user": "u", "url": "jdbc:x", "dbtable": "public.rental", "partitionColumn": "rental_id",
        "lowerBound": "5", "upperBound": "900", "numPartitions": "10", "fetchsize": "10000",
    }
    assert [jdbc.partitions_for(n) for n in (0, 1, 1_000_000, 1_000_001)] == [1, 1, 1, 2]
    assert jdbc.jdbc_options("u", "t", "k", 0, 9, 2, {"fetchsize": "7"})["fetchsize"] == "7"
    assert jdbc.jdbc_options("u", "t", "k", 3, 3, 2, {})["upperBound"] == "4"
    assert len(jdbc.FILM_TABLES) == 15
    assert jdbc.FILM_TABLES["film_actor"] == "actor_id" and jdbc.FILM_TABLES["film_category"] == "category_id"
    assert jdbc.bounds_query("t", "k") == "(SELECT MIN(k) AS lo, MAX(k) AS hi, COUNT(*) AS n FROM t) AS bounds"


def test_json_records(spark, rows, tmp_path):
    path = tmp_path / "students.json"
    path.write_text(
        json.dumps(
            [
                {"id": 1, "name": "a", "birthday": "2000-01-01T00:00:00", "room": 3, "sex": "M", "more": [1]},
                {"id": 2, "name": "b", "birthday": None, "room": None, "sex": "F"},
                {"id": 1, "name": "c", "birthday": None, "room": 4, "sex": None},
            ],
            indent=2,
        )
    )
    df = files.read_json_records(spark, str(path), STUDENTS.schema, position="pos")
    assert [r[:5] for r in rows(df)] == [
        (1, "a", datetime(2000, 1, 1), 3, "M"), (2, "b", None, None, "F"), (1, "c", None, 4, None),
    ]
    last = latest_per_key(df, ["id"], ["pos"]).select("id", "name").orderBy("id")
    assert rows(last) == [(1, "c"), (2, "b")]
    assert files.missing_keys(spark, str(path), STUDENTS.columns).count() == 0
    files.require_keys(spark, str(path), STUDENTS.columns)


def test_json_missing_key_and_bad_json(spark, rows, tmp_path):
    path = tmp_path / "rooms.json"
    path.write_text('[{"id": 1, "name": null}, {"id": 2}, {"name": "x"}, {"id": 3}]')
    assert sorted(rows(files.missing_keys(spark, str(path), ["id", "name"]))) == [("id", 1), ("name", 2)]
    with pytest.raises(ValueError, match="name"):
        files.require_keys(spark, str(path), ["name"])
    lines = tmp_path / "lines.json"
    lines.write_text('{"id": 1}\n{"id": 2, "name": "x"}\n')
    assert rows(files.missing_keys(spark, str(lines), ["id", "name"], array=False)) == [("name", 1)]
    broken = tmp_path / "broken.json"
    broken.write_text('[{"id": 1, "name": ')
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_json_records(spark, str(broken), ROOMS.schema).collect()
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.require_keys(spark, str(broken), ["id"])


def test_json_keys_of_a_large_file(spark, tmp_path):
    path = tmp_path / "large.json"
    with open(path, "w") as f:
        f.write("[" + ",".join(json.dumps({"id": i, "name": "x" * 100_000}) for i in range(1_400)) + ',{"id": 1, "name": null}]')
    assert path.stat().st_size > 128 << 20
    files.require_keys(spark, str(path), ["id", "name"])
    assert files.missing_keys(spark, str(path), ["room"]).first()["records"] == 1_401


def test_csv_by_name_with_extra_columns(spark, rows, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(
        "extra,reviewId,userName,content,score,thumbsUpCount,at\n"
        'e1,r1,NA,"say ""hi""\nthere",5,n/a,-\n'
        ',r2,u,"",,3, padded \n'
    )
    df = files.read_csv_na(spark, str(path), REVIEWS)
    assert df.columns == REVIEWS.names + ["extra"]
    assert rows(df) == [
        ("r1", None, 'say "hi"\nthere', 5, None, "-", "e1"), ("r2", "u", None, None, 3, " padded ", None),
    ]
    bad = tmp_path / "bad.csv"
    bad.write_text("reviewId,userName,content,score,thumbsUpCount,at\nr1,u,c,five,1,-\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_csv_na(spark, str(bad), REVIEWS).collect()


def test_csv_files_of_another_column_order_fail(spark, rows, tmp_path):
    names = REVIEWS.names
    line = "r1,u,c,1,1,-\n"
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + line)
    (tmp_path / "b.csv").write_text(",".join(names) + "\n" + line.replace("r1", "r2"))
    assert sorted(r[0] for r in rows(files.read_csv_na(spark, str(tmp_path), REVIEWS))) == ["r1", "r2"]
    (tmp_path / "c.csv").write_text(",".join([names[1], names[0], *names[2:]]) + "\n" + line)
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_csv_na(spark, str(tmp_path), REVIEWS).collect()


def test_empty_files_have_no_rows(spark, tmp_path):
    (tmp_path / "zero.csv").write_text("")
    (tmp_path / "header.csv").write_text(",".join(REVIEWS.names) + "\n")
    for name in ("zero", "header"):
        df = files.read_csv_na(spark, str(tmp_path / f"{name}.csv"), REVIEWS)
        assert df.columns == REVIEWS.names and not files.has_rows(df)
    assert files.has_rows(spark.range(1))


def test_first_file_by_name(spark, tmp_path):
    assert files.first_file(spark, str(tmp_path)) is None
    (tmp_path / "deeper").mkdir()
    for name in ("b.csv", "a b.csv", "0.txt", "deeper/0.csv"):
        (tmp_path / name).write_text(",".join(REVIEWS.names) + "\n")
    found = files.first_file(spark, str(tmp_path))
    assert found.endswith("/a b.csv")
    assert files.read_csv_na(spark, found, REVIEWS).columns == REVIEWS.names


def test_number_list(spark, rows, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text("70, 120,50 , 110\n")
    got = rows(files.read_number_list(spark, str(path)).select("idx", "value"))
    assert got == [(0, 70.0), (1, 120.0), (2, 50.0), (3, 110.0)]


def test_bom_from_csv_and_parquet(spark, rows, frame, tmp_path):
    data = [(2023, 1, 5, None, "FIN", Decimal("1.500000"), 6, 2, "RM", None, "A")]
    frame(BOM, data).write.parquet(str(tmp_path / "p"))
    assert rows(files.read_bom(spark, str(tmp_path / "p"))) == data
    frame(BOM, data).write.option("header", True).csv(str(tmp_path / "c"))
    assert rows(files.read_bom(spark, str(tmp_path / "c"), "csv")) == data
    floats = frame(BOM, data).withColumn("component_material_quantity", F.lit(float("nan")))
    floats.write.parquet(str(tmp_path / "f"))
    assert rows(files.read_bom(spark, str(tmp_path / "f"))) == data


# --- merges --------------------------------------------------------------------------


def test_upsert_last_wins_and_replaces_by_null(frame, rows):
    target = frame("id int, name string", [(1, "a"), (2, "b"), (3, None)])
    source = frame("id int, name string, pos int", [(2, "x", 1), (2, None, 2), (4, "n", 3), (4, "m", 4), (3, "c", 5)])
    merged = upsert(target, source, ["id"], ["pos"])
    expected = [(1, "a"), (2, None), (3, "c"), (4, "m")]
    assert sorted(rows(merged), key=lambda r: r[0]) == expected
    again = upsert(merged, source, ["id"], ["pos"])
    assert sorted(rows(again), key=lambda r: r[0]) == expected


def test_insert_if_absent(frame, rows):
    target = frame("a int, b int", [(1, 1)])
    source = frame("a int, b int", [(1, 1), (1, 2), (1, 2)])
    assert rows(insert_if_absent(target, source, ["a", "b"], ["a"])) == [(1, 2)]
    first = frame("a int, b int, pos int", [(1, 5, 0), (2, 7, 3), (2, 6, 1), (2, 6, 2), (None, 1, 1)])
    assert sorted(rows(insert_if_absent(target, first, ["a"], ["pos"])), key=str) == [(2, 6), (None, 1)]


def test_published_table_merges(spark, frame, rows, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, path)
    published.publish(frame("id int, name string", [(1, "a"), (2, "b")]), path)
    source = frame("id int, name string, pos int", [(2, "x", 1), (3, "y", 2), (3, "z", 3)])
    assert tables.upsert_published(spark, path, source, ["id"], ["pos"]) == 2
    assert sorted(rows(published.read_published(spark, path))) == [(1, "a"), (2, "x"), (3, "z")]
    more = frame("id int, name string", [(3, "no"), (4, "new")])
    assert tables.insert_absent_published(spark, path, more, ["id"], ["name"]) == 1
    assert sorted(rows(published.read_published(spark, path))) == [(1, "a"), (2, "x"), (3, "z"), (4, "new")]
    assert published.superseded(spark, path).count() == 2


def test_unfinished_version_stays_invisible(spark, frame, rows, tmp_path):
    path = str(tmp_path / "t")
    published.publish(frame("id int", [(1,)]), path)
    before = published.read_published(spark, path)
    frame("id int", [(9,)]).write.parquet(f"{path}/versions/unfinished")
    assert rows(published.read_published(spark, path)) == [(1,)]
    published.publish(published.read_published(spark, path).unionByName(frame("id int", [(2,)])), path)
    assert rows(before) == [(1,)]
    assert sorted(rows(published.read_published(spark, path))) == [(1,), (2,)]


def test_table_loads(spark, frame, rows):
    df = frame("id int, x double", [(1, float("nan")), (2, 0.5)])
    assert tables.replace_table(df, "loads") == 2
    assert tables.replace_table(df, "loads") == 2
    assert sorted(rows(spark.table("loads")), key=lambda r: r[0]) == [(1, None), (2, 0.5)]
    tables.append(df.limit(1), "loads")
    loaded, stored, sample = tables.load_summary(2, spark.table("loads"))
    assert (loaded, stored, sample.count()) == (2, 3, 3)
    tables.replace_table(df, "parents")
    tables.empty_tables(spark, "loads", "parents")
    assert spark.table("loads").count() == spark.table("parents").count() == 0


def test_switched_table(spark, frame, rows, tmp_path):
    df = frame("id int, x double", [(1, float("nan")), (2, 0.5)])
    folder = str(tmp_path / "loads")
    assert tables.switch_table(df, "switched", folder) == 2
    reader = spark.table("switched")
    assert tables.switch_table(df.where("id = 2"), "switched", folder) == 1
    assert rows(spark.table("switched")) == [(2, 0.5)]
    broken = frame("id int, x double", [(i, float(i)) for i in range(100)])
    broken = broken.withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.col("x")))
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.switch_table(broken, "switched", folder)
    assert rows(spark.table("switched")) == [(2, 0.5)]
    with pytest.raises(ValueError, match="switched"):
        tables.switch_table(df.withColumn("y", F.lit(1)), "switched", folder)
    assert sorted(rows(reader.select("id"))) in ([(1,), (2,)], [(2,)])
    assert len(tables.places_left(spark, "switched", folder)) == 2
    assert tables.switch_table(df.where("false"), "switched", folder) == 0
    assert spark.table("switched").count() == 0


def test_jdbc_write_options():
    options = tables.jdbc_write_options("jdbc:x", "bom_data", {"year": "INTEGER", "plant_id": "TEXT"}, {"user": "u"})
    assert options["createTableColumnTypes"] == "year INTEGER, plant_id TEXT"
    assert options["batchsize"] == "1000" and options["user"] == "u"


def test_constraints(frame, rows):
    rooms = frame(ROOMS.schema, [(1, "a"), (1, "b"), (None, "c"), (2, "x" * 51)])
    assert sorted(rows(constraints.check_constraints(rooms, ["id"], ROOM_LENGTHS)), key=str) == sorted(
        [("key repeats", "id", "1", 2), ("key is null", "id", "", 1), ("too long", "name", "x" * 51, 1)], key=str
    )
    students = frame(
        STUDENTS.schema, [(1, "a", None, 1, "M"), (2, "b", None, None, None), (3, "c", None, 9, "FM"), (4, "d", None, 9, "F")]
    )
    found = constraints.check_constraints(students, ["id"], STUDENT_LENGTHS, {"room": (rooms, "id")})
    assert sorted(rows(found)) == [("too long", "sex", "FM", 1), ("unknown reference", "room", "9", 2)]


# --- exports ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def mixed(frame):
    return frame(
        "id int, amount decimal(10,2), at timestamp_ntz, day date, note string",
        [
            (1, Decimal("2.50"), datetime(2024, 1, 2, 3, 4, 5), date(2024, 1, 2), '<a> & "é"'),
            (2, None, datetime(2024, 1, 2, 3, 4, 5, 250000), None, None),
        ],
    )


EXPECTED = [
    {"id": 1, "amount": "2.50", "at": "2024-01-02 03:04:05", "day": "2024-01-02", "note": '<a> & "é"'},
    {"id": 2, "amount": None, "at": "2024-01-02 03:04:05.250000", "day": None, "note": None},
]


def test_json_export(mixed, tmp_path):
    exports.export_json(mixed, str(tmp_path / "lines"))
    lines = [json.loads(x) for x in text(tmp_path / "lines").splitlines()]
    assert sorted(lines, key=lambda r: r["id"]) == EXPECTED


def test_xml_export(mixed, tmp_path):
    exports.export_xml(mixed.coalesce(1), str(tmp_path / "x"))
    root = ET.fromstring(text(tmp_path / "x").strip())
    assert root.tag == "records" and [c.tag for c in root] == ["record", "record"]
    got = [{f.tag: f.text for f in record} for record in root]
    assert sorted(got, key=lambda r: r["id"]) == [{k: None if v is None else str(v) for k, v in r.items()} for r in EXPECTED]


def test_documents_in_parts(spark, frame, mixed, tmp_path):
    exports.export_json_document(mixed, str(tmp_path / "j"), ["id"])
    assert json.loads(text(tmp_path / "j")) == EXPECTED
    exports.export_xml_document(mixed, str(tmp_path / "x"), ["id"])
    got = [{f.tag: f.text for f in record} for record in ET.fromstring(text(tmp_path / "x"))]
    assert got == [{k: None if v is None else str(v) for k, v in r.items()} for r in EXPECTED]
    many = frame("k int, value string, `__kind` int", [(i % 7 or None, f'<{i}>,\n"]', i) for i in range(200)] * 2).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    exports.export_json_document(many, str(tmp_path / "m"), ["k", "value"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{tmp_path}/m/part-*")) > 1
    parsed = json.loads(text(tmp_path / "m"))
    assert [(r["k"] or 0, r["value"]) for r in parsed] == sorted((i % 7, f'<{i}>,\n"]') for i in [*range(200)] * 2)
    exports.export_xml_document(many, str(tmp_path / "mx"), ["k"])
    assert len(ET.fromstring(text(tmp_path / "mx"))) == 400
    for export, parse in ((exports.export_json_document, json.loads), (exports.export_xml_document, ET.fromstring)):
        export(mixed.where("false"), str(tmp_path / "none"), ["id"])
        assert len(parse(text(tmp_path / "none"))) == 0


def test_load_query_export(spark, rows, tmp_path):
    (tmp_path / "rooms.json").write_text('[{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]')
    (tmp_path / "students.json").write_text(
        '[{"id": 5, "name": "x", "birthday": "2000-01-01T00:00:00", "room": 1, "sex": "M"}]'
    )
    rooms = files.read_json_records(spark, str(tmp_path / "rooms.json"), ROOMS.schema)
    students = files.read_json_records(spark, str(tmp_path / "students.json"), STUDENTS.schema)
    assert constraints.check_constraints(students, ["id"], STUDENT_LENGTHS, {"room": (rooms, "id")}).isEmpty()
    exports.export_json(rooms_plan.students_per_room(rooms, students), str(tmp_path / "out"))
    lines = [json.loads(x) for x in text(tmp_path / "out").splitlines()]
    assert sorted(r["student_count"] for r in lines) == [0, 1]


def test_profile(frame):
    df = frame("a int, b string", [(1, "x"), (3, "y"), (None, "z")])
    got = {r["summary"]: r["a"] for r in profile(df).collect()}
    assert (got["count"], got["mean"], got["min"], got["max"]) == ("2", "2.0", "1", "3")
    assert preview(df, 2).count() == 2


def test_first_drop_of_parts(spark, rows, tmp_path):
    assert files.first_drop(spark, str(tmp_path)) is None
    header = ",".join(REVIEWS.names) + "\n"
    for name in ("b.csv", "a +1.part-0.csv", "a +1.part-1.csv", "a +1x.csv", "a1.part-0.csv"):
        (tmp_path / name).write_text(header + f"{name},u,c,5,,-\n")
    (tmp_path / "a1.part-0.csv").unlink()
    found = files.read_csv_na(spark, files.first_drop(spark, str(tmp_path)), REVIEWS)
    assert sorted(r[0] for r in rows(found)) == ["a +1.part-0.csv", "a +1.part-1.csv"]


def test_merges_touch_few_parts(spark, frame, tmp_path):
    """Changes to one key in a hundred rewrite the parts of those keys only."""
    schema = "k long, g string, v int"
    old = [(i, "y" if i % 5 else "x", i) for i in range(500)]
    target = frame(schema, old)
    keyed_table = tables.KeyedTable(spark, str(tmp_path), target.schema, ["k", "g"], parts=64)
    keyed_table.load(target)
    before = published.part_directories(spark, str(tmp_path))[1]
    assert len(before) > 60
    source = frame("k long, g string, v int, at int", [(i, "x", -1, 0) for i in range(0, 25, 5)] + [(0, "x", -2, 1), (1, "y", -3, 0)])
    assert keyed_table.upsert(source, ["at"]) == 6
    expected = {(k, g): v for k, g, v in old} | {(i, "x"): -1 for i in range(0, 25, 5)} | {(0, "x"): -2, (1, "y"): -3}
    assert {(r.k, r.g): r.v for r in keyed_table.read().collect()} == expected
    after = published.part_directories(spark, str(tmp_path))[1]
    moved = {p for p in after if after[p] != before.get(p)}
    assert 1 <= len(moved) <= 6 and before.keys() == after.keys()
    more = frame("k long, g string, v int, at int", [(0, "x", 7, 0), (9000, "n", 8, 1), (9000, "n", 9, 0)])
    assert keyed_table.insert_if_absent(more, ["at"]) == 1
    assert {(r.k, r.g): r.v for r in keyed_table.read().collect()} == expected | {(9000, "n"): 9}
    assert len([p for p, d in published.part_directories(spark, str(tmp_path))[1].items() if d != after.get(p)]) == 1
    assert keyed_table.insert_if_absent(more, ["at"]) == 0 == keyed_table.upsert(source.limit(0), ["at"])


def test_keyed_table_without_rows(spark, frame, tmp_path):
    empty = frame("k long, v int", [])
    keyed_table = tables.KeyedTable(spark, str(tmp_path), empty.schema, ["k"], parts=4)
    assert keyed_table.read().count() == 0
    keyed_table.load(empty)
    assert keyed_table.read().count() == 0
    assert keyed_table.upsert(frame("k long, v int", [(1, 2)]), ["v"]) == 1
    assert keyed_table.read().count() == 1
    keyed_table.load(empty)
    assert keyed_table.read().count() == 0
