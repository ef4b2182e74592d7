from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import text, times


def apply(frame, rows, values, expression, kind="string"):
    df = frame(f"i int, v {kind}", list(enumerate(values)))
    return [r[1] for r in sorted(rows(df.select("i", expression(F.col("v")))))]


def test_strip_symbols_keeps_words_space_and_ascii_punctuation(frame, rows):
    values = ["Nice 👍!", "éa naïve", "é", "½ x_y №", "a b\tc", "~!@#$%^&*()", "日本語 ok", None, "😀"]
    expected = ["Nice !", "éa naïve", "e", "½ x_y ", "a b\tc", "~!@#$%^&*()", "日本語 ok", None, ""]
    assert apply(frame, rows, values, text.strip_symbols) == expected


def test_comparison_key_trims_more_than_blanks(frame, rows):
    values = ["Nice app", " nice APP ", "\tNICE app\n", " nice app ", "   "]
    assert apply(frame, rows, values, text.comparison_key) == ["nice app"] * 4 + [""]


def test_every_missing_value_text_becomes_null(frame, rows):
    assert set(apply(frame, rows, text.NA_TOKENS, text.na_to_null)) == {None}
    assert apply(frame, rows, ["-", " ", "na", "0"], text.na_to_null) == ["-", " ", "na", "0"]


def test_fill_text_nulls_leaves_numbers_alone(frame, rows):
    df = frame("a string, b int, `c.d` string", [(None, None, None), ("x", 1, "y")])
    assert rows(text.fill_text_nulls(df)) == [("-", None, "-"), ("x", 1, "y")]


def test_nan_becomes_null(frame, rows):
    df = frame("a double, b string", [(float("nan"), "x"), (1.0, "y")])
    assert rows(text.nan_to_null(df)) == [(None, "x"), (1.0, "y")]


@pytest.mark.parametrize(
    "start, end, years",
    [
        (datetime(2020, 2, 29), datetime(2021, 2, 28), 0),
        (datetime(2020, 2, 29), datetime(2021, 3, 1), 1),
        (datetime(2000, 1, 1, 12), datetime(2001, 1, 1, 11), 0),
        (datetime(2000, 1, 1, 12), datetime(2001, 1, 1, 12), 1),
        (datetime(2001, 6, 1), datetime(2000, 1, 1), -1),
        (datetime(2000, 6, 1), datetime(2000, 1, 1), 0),
    ],
)
def test_whole_years(frame, rows, start, end, years):
    df = frame("a timestamp_ntz, b timestamp_ntz", [(start, end)])
    assert rows(df.select(times.whole_years(F.col("a"), F.col("b")))) == [(years,)]


def test_hours_keep_fractions(frame, rows):
    df = frame("a timestamp_ntz, b timestamp_ntz", [(datetime(2020, 1, 1), datetime(2020, 1, 1, 1, 0, 0, 800000))])
    hours = times.micros_to_hours(times.micros_between(F.col("a"), F.col("b")))
    assert rows(df.select(hours)) == [(pytest.approx(3600.8 / 3600, abs=1e-12),)]


def test_parse_first_and_day(frame, rows):
    values = ["2024-01-02 03:04:05", "2024-01-02 03:04:05.25", "2024-01-02T03:04:05", "2024-01-02", "01/02/2024", "-", None, "soon"]
    day = datetime(2024, 1, 2)
    assert apply(frame, rows, values, times.parse_first) == [
        datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 250000), datetime(2024, 1, 2, 3, 4, 5),
        day, day, None, None, None,
    ]
    assert apply(frame, rows, ["2024-01-02 03:04:05", "-", None], times.day_of) == [day, None, None]
