import pytest

from millrace.sinks import published
from millrace.sinks.published import compact, read_published, superseded
from millrace.streaming.pickup import ingest_new_files, publish_new_files

HEADER = "reviewId,userName,content,score,thumbsUpCount,at\n"


def run(spark, base):
    query = ingest_new_files(spark, str(base / "in"), str(base / "out"), str(base / "checkpoint"))
    query.awaitTermination()
    assert query.exception() is None
    return sorted(r[0] for r in spark.read.parquet(str(base / "out")).collect())


def test_each_file_is_taken_once(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "deeper").mkdir(parents=True)
    (folder / "a.csv").write_text(HEADER + 'a1,u,"line\nbreak 👍",5,,2024-01-01\na2,NA,x,,1,never\n')
    (folder / "deeper" / "z.csv").write_text(HEADER + "z1,u,x,1,1,-\n")
    (folder / "note.txt").write_text("not a review")
    assert run(spark, tmp_path) == ["a1", "a2"]
    assert run(spark, tmp_path) == ["a1", "a2"]
    (folder / "b.csv").write_text(HEADER + "b1,u,x,1,1,-\n")
    (folder / "c.csv").write_text(HEADER)
    assert run(spark, tmp_path) == ["a1", "a2", "b1"]
    rows = {r[0]: tuple(r[1:]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows["a1"] == ("u", "line\nbreak ", 5, None, "2024-01-01 00:00:00")
    assert rows["a2"] == ("-", "x", None, 1, "-")


def publish_run(spark, base):
    query = publish_new_files(spark, str(base / "in"), str(base / "out"), str(base / "checkpoint"))
    query.awaitTermination()
    return sorted(r[0] for r in read_published(spark, str(base / "out")).collect())


def test_published_batches(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "empty.csv").write_text(HEADER)
    with pytest.raises(FileNotFoundError):
        publish_run(spark, tmp_path)
    for i in range(3):
        (folder / f"a.part-{i}.csv").write_text(HEADER + f"a{i},u,x,1,1,-\n")
    assert publish_run(spark, tmp_path) == ["a0", "a1", "a2"]
    assert publish_run(spark, tmp_path) == ["a0", "a1", "a2"]
    (folder / "b.csv").write_text(HEADER + "b,u,x,1,1,-\n")
    assert publish_run(spark, tmp_path) == ["a0", "a1", "a2", "b"]
    compact(spark, str(tmp_path / "out"))
    (folder / "c.csv").write_text(HEADER + "c,u,x,1,1,-\n")
    assert publish_run(spark, tmp_path) == ["a0", "a1", "a2", "b", "c"]
    assert superseded(spark, str(tmp_path / "out")).count() == 2


@pytest.mark.parametrize("after_commit", [False, True])
def test_killed_batch_is_published_once(spark, tmp_path, monkeypatch, after_commit):
    """A batch that dies between write and commit, or between commit and checkpoint, and runs again."""
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + "a,u,x,1,1,-\nb,u,x,1,1,-\n")
    commit = published._commit

    def dies(*args):
        if after_commit:
            commit(*args)
        raise RuntimeError("killed")

    monkeypatch.setattr(published, "_commit", dies)
    with pytest.raises(Exception, match="killed"):
        publish_run(spark, tmp_path)
    monkeypatch.setattr(published, "_commit", commit)
    assert publish_run(spark, tmp_path) == ["a", "b"]
    assert len(list((tmp_path / "out" / "versions").iterdir())) == (1 if after_commit else 2)
