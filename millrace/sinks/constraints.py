"""Checks of key, reference and length constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted


def check_constraints(
    df: DataFrame,
    keys: list[str],
    lengths: dict[str, int] | None = None,
    references: dict[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Violations as ``rule, column, value, rows``; empty when all constraints hold.

    ``keys`` must be unique and not null, texts at most ``lengths`` characters, and
    a non-null value of a ``references`` column must exist in the parent's column.
    Rows are counted per value first, so only distinct values meet the parents.
    """
    key_name = ",".join(keys)
    key_value = F.concat_ws(",", *[quoted(k).cast("string") for k in keys])
    some_null = reduce(lambda a, b: a | b, [quoted(k).isNull() for k in keys])
    per_key = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("rows"))
    found = [
        per_key.where(some_null | (F.col("rows") > 1)).select(
            F.when(some_null, "key is null").otherwise("key repeats").alias("rule"),
            F.lit(key_name).alias("column"),
            key_value.alias("value"),
            "rows",
        )
    ]
    for column, limit in (lengths or {}).items():
        found.append(
            df.where(F.char_length(quoted(column)) > limit)
            .groupBy(quoted(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit("too long").alias("rule"), F.lit(column).alias("column"), "value", "rows")
        )
    for column, (parent, parent_column) in (references or {}).items():
        used = df.where(quoted(column).isNotNull()).groupBy(quoted(column).alias("value")).agg(
            F.count(F.lit(1)).alias("rows")
        )
        known = parent.select(quoted(parent_column).alias("value"))
        found.append(
            used.join(known, "value", "left_anti").select(
                F.lit("unknown reference").alias("rule"),
                F.lit(column).alias("column"),
                F.col("value").cast("string").alias("value"),
                "rows",
            )
        )
    return reduce(DataFrame.unionByName, found)
