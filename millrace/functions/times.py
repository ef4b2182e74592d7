"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how a cleaned timestamp is written.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"

# Accepted inputs, tried in this order.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
)

MICROS_PER_HOUR = 3_600_000_000


def whole_years(start: Column, end: Column) -> Column:
    """Completed years from ``start`` to ``end``; time of day and 29 February count."""
    return F.timestamp_diff("YEAR", start, end)


def micros_between(start: Column, end: Column) -> Column:
    """Signed microseconds, as a decimal wide enough to be summed over any table."""
    return F.timestamp_diff("MICROSECOND", start, end).cast(T.DecimalType(20, 0))


def micros_to_hours(micros: Column) -> Column:
    return micros.cast("double") / F.lit(float(MICROS_PER_HOUR))


def parse_first(text: Column, formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> Column:
    """Timestamp from the first format that fits, NULL when none does.

    Texts without a digit, such as a placeholder, are not tried: a failed parse is slow.
    """
    return F.when(text.rlike("[0-9]"), F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]))


def day_of(text: Column) -> Column:
    """Midnight timestamp of a cleaned timestamp text, NULL when it is none."""
    return F.date_trunc("day", F.try_to_timestamp(text, F.lit(TIMESTAMP_TEXT)))
