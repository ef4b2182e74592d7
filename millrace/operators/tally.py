"""Counts, shares and conditional counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted


def is_true(condition: Column) -> Column:
    """Condition with NULL read as false."""
    return F.coalesce(condition, F.lit(False))


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Non-null values of ``column`` with their frequency, most frequent first."""
    return (
        df.where(quoted(column).isNotNull())
        .groupBy(quoted(column).alias(column))
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(name).desc(), quoted(column).asc())
    )


def count_by_condition(df: DataFrame, keys: list[str], conditions: dict[str, Column]) -> DataFrame:
    """Per key, the number of rows meeting each named condition."""
    return df.groupBy(*[quoted(k) for k in keys]).agg(
        *[F.count_if(c).alias(name) for name, c in conditions.items()]
    )


def share_where(condition: Column) -> Column:
    """Aggregate: share of rows meeting ``condition``; NULL counts as no."""
    return F.avg(is_true(condition).cast("int"))


def all_true(condition: Column) -> Column:
    """Aggregate: do all rows meet ``condition``? True over no rows at all."""
    return F.coalesce(F.bool_and(is_true(condition)), F.lit(True))
