"""Descriptive statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import quoted
from millrace.operators.quantiles import TASK_VALUES, percentiles_of

QUARTILES = [0.25, 0.5, 0.75]


def numeric_columns(df: DataFrame, besides: list[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in besides
    ]


def describe_by(
    df: DataFrame,
    keys: list[str],
    columns: list[str] | None = None,
    task_values: int = TASK_VALUES,
) -> DataFrame:
    """Per group and numeric column: count, mean, std (sample), min, quartiles, max.

    One row per group and column. Groups with a NULL key are left out. The moments come from the
    scan that brackets the quartiles.
    """
    columns = columns or numeric_columns(df, besides=keys)
    present = df.select(*[quoted(k) for k in keys], *[quoted(c).cast("double").alias(f"s{i}") for i, c in enumerate(columns)])
    for k in keys:
        present = present.where(quoted(k).isNotNull())
    moments = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(f"s{i}").alias("count"),
            F.avg(f"s{i}").alias("mean"),
            F.stddev_samp(f"s{i}").alias("std"),
            F.min(f"s{i}").alias("min"),
            F.max(f"s{i}").alias("max"),
        )
        for i, c in enumerate(columns)
    ]
    places = [f"s{i}" for i in range(len(columns))]
    described = percentiles_of(present, keys, places, QUARTILES, [F.array(*moments).alias("moments")], task_values)
    each = described.select(*[quoted(k) for k in keys], F.inline(F.arrays_zip("moments", "percentiles")))
    return each.select(
        *[quoted(k) for k in keys],
        "moments.column",
        "moments.count",
        "moments.mean",
        "moments.std",
        "moments.min",
        F.col("percentiles")[0].alias("p25"),
        F.col("percentiles")[1].alias("p50"),
        F.col("percentiles")[2].alias("p75"),
        "moments.max",
    )


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of each column, as text."""
    return df.describe(*(columns or []))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows, for display."""
    return df.limit(n)
