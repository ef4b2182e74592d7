from datetime import datetime

import pytest

from millrace.plans import reviews as plan
from millrace.sinks.published import read_published

SCHEMA = "reviewId string, userName string, content string, score int, thumbsUpCount int, at string"


@pytest.fixture(scope="module")
def cleaned(frame):
    return frame(
        SCHEMA,
        [
            ("r1", "u", " nice APP ", 5, 1, "2024-01-02 00:00:00"),
            ("r2", "u", "Nice app", 4, None, "2024-01-01 10:00:00"),
            ("r3", "u", "\tnice app", None, 2, "-"),
            ("r4", "u", "bad", 1, None, "2024-01-01 09:00:00"),
            ("r5", "u", "BAD", 2, None, "2024-01-01 09:00:00"),
            ("r6", "u", "   ", 3, 1, "2024-01-03 00:00:00"),
            ("r7", "u", "-", 3, 9, "2024-01-03 00:00:00"),
            ("r8", "u", None, 3, 9, "2024-01-03 00:00:00"),
            ("r9", "u", "a😀bc", 2, 0, "2024-01-03 23:59:59"),
            ("ra", "u", "a😀bcd", 2, 0, "no date"),
        ],
    )


def test_top_comments(cleaned, rows):
    assert rows(plan.top_comments(cleaned, n=4)) == [
        (3, 3, "Nice app", 4.5),
        (2, 0, "bad", 1.5),
        (1, 1, "   ", 3.0),
        (1, 0, "a😀bc", 2.0),
    ]


def test_averages_round_half_to_even(frame, rows):
    scores = [2] * 7 + [3]  # 2.125
    df = frame(SCHEMA, [(f"r{i}", "u", "x", s, 0, "2024-01-01 00:00:00") for i, s in enumerate(scores)])
    assert rows(plan.top_comments(df)) == [(8, 0, "x", 2.12)]
    assert rows(plan.avg_score_per_day(df)) == [(8, datetime(2024, 1, 1), 2.12)]


def test_short_content_counts_code_points(cleaned, rows):
    got = sorted(rows(plan.short_content(cleaned)))
    assert [r[0] for r in got] == ["r4", "r5", "r6", "r7", "r9"]


def test_avg_score_per_day(cleaned, rows):
    assert rows(plan.avg_score_per_day(cleaned)) == [
        (3, datetime(2024, 1, 1), 2.33),
        (1, datetime(2024, 1, 2), 5.0),
        (4, datetime(2024, 1, 3), 2.75),
    ]


def test_clean_reviews_keeps_stage_order(frame, rows):
    raw = frame(
        SCHEMA + ", extra string",
        [
            ("r1", None, "ok 👍", 5, 1, "2024-01-02 00:00:00.5", None),
            ("r2", "NA", "👍", None, None, None, "x"),
            ("r3", "u", "NA👍", 1, None, "whenever", "x"),
            ("r4", "u", None, 1, None, "2024-01-02", "x"),
            ("r0", "u", "  ", 1, None, "2024-01-02", "x"),
        ],
    )
    got = rows(plan.clean_reviews(raw))
    assert got == [
        ("r0", "u", "  ", 1, None, "2024-01-02 00:00:00", "x"),
        ("r4", "u", "-", 1, None, "2024-01-02 00:00:00", "x"),
        ("r1", "-", "ok ", 5, 1, "2024-01-02 00:00:00", "-"),
        ("r2", "-", None, None, None, "-", "x"),
        ("r3", "u", None, 1, None, "-", "x"),
    ]
    assert sorted(rows(plan.clean_reviews(raw, ordered=False))) == sorted(got)


def test_process_reviews_leaves_target_on_empty_input(spark, rows, tmp_path):
    header = "reviewId,userName,content,score,thumbsUpCount,at\n"
    (tmp_path / "full.csv").write_text(header + 'r1,u,"two\nlines, ""quoted"" 👍",5,,2024-01-01 00:00:00\n')
    (tmp_path / "header.csv").write_text(header)
    (tmp_path / "empty.csv").write_text("")
    out = str(tmp_path / "out")
    assert plan.process_reviews(spark, str(tmp_path / "full.csv"), out)
    assert not plan.process_reviews(spark, str(tmp_path / "header.csv"), out)
    assert not plan.process_reviews(spark, str(tmp_path / "empty.csv"), out)
    assert rows(read_published(spark, out)) == [
        ("r1", "u", 'two\nlines, "quoted" ', 5, None, "2024-01-01 00:00:00")
    ]


def test_first_file_of_a_folder(spark, rows, tmp_path):
    header = "reviewId,userName,content,score,thumbsUpCount,at\n"
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    assert plan.process_folder(spark, str(folder), out) is None
    for name in ("b", "a"):
        (folder / f"{name}.csv").write_text(header + f"{name},u,c,5,,2024-01-01 00:00:00\n")
    assert plan.process_folder(spark, str(folder), out).endswith("/a.csv")
    assert [r[0] for r in rows(read_published(spark, out))] == ["a"]
