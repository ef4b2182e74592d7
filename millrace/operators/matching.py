"""Existence joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted


def without_match(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right``.

    The right side is reduced to its distinct keys first: the map-side half of
    that distinct collapses a hot key before anything is shuffled, and the join
    reuses the partitioning it leaves behind. For a ``left`` of unique keys.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*[quoted(k) for k in keys]).distinct(), keys, "left_anti")


def with_match(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``left`` whose key is present in ``right``, the table the key belongs to.

    Both sides are shuffled as they are, so that the adaptive skew join can split
    a key that is hot on the left. It cannot when one side is an aggregate by the
    join key, which keeps its partitioning: store such a side first.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*[quoted(k) for k in keys]), keys, "left_semi")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; key columns appear once."""
    if not keys:
        raise ValueError("null_safe_join needs at least one key")
    renamed = right.select(
        *[quoted(c).alias(f"__r_{c}") if c in keys else quoted(c) for c in right.columns]
    )
    condition = reduce(
        lambda a, b: a & b,
        [quoted(k).eqNullSafe(quoted(f"__r_{k}")) for k in keys],
    )
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def peak_of(df: DataFrame, column: str) -> Column:
    """The maximum of ``column`` as a scalar subquery: one value, no join."""
    return df.agg(F.max(quoted(column))).scalar()
