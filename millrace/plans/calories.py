"""Statistics of one column of numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.operators.quantiles import lowest_percentile_above, median, share_above

__all__ = [
    "lowest_percentile_above", "mean_gap", "median", "population_std", "share_above", "sorted_values",
]


def mean_gap(df: DataFrame, column: str, reference: float = 60) -> DataFrame:
    """Mean of ``column`` and how far it lies above ``reference``."""
    mean = F.avg(quoted(column))
    return df.agg(mean.alias("mean"), (mean - F.lit(reference)).alias("gap"))


def sorted_values(df: DataFrame, column: str, tie_break: list[str] | None = None) -> DataFrame:
    """The values in ascending order.

    The tie-break (default: row number at the scan) lets the range sort spread a
    value that fills much of the table over several tasks.
    """
    ties = [quoted(c) for c in tie_break] if tie_break else [F.monotonically_increasing_id()]
    keyed = df.select(quoted(column), *[t.alias(f"__t{i}") for i, t in enumerate(ties)])
    return keyed.orderBy(quoted(column), *[f"__t{i}" for i in range(len(ties))]).select(quoted(column))


def population_std(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.stddev_pop(quoted(column)).alias("std"))
