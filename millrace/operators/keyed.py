"""Keyed merges: last row per key, upsert, insert if absent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.operators.matching import without_match


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, as an aggregate.

    A ranking window would sort a hot key inside one task; this keeps a single
    candidate per key and task before the shuffle.
    """
    return _edge_row(df, keys, order, F.max_by)


def _edge_row(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    """The row that ``pick`` takes by ``order`` per key."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    kept = (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(
            pick(
                F.struct(*[quoted(c).alias(c) for c in rest]),
                F.struct(*[quoted(c).alias(f"o{i}") for i, c in enumerate(order)]),
            ).alias("__row")
        )
    )
    return kept.select(
        *[quoted(c) if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns]
    )


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``target`` after applying ``source`` in ``order``.

    Every non-key column of a matched row is replaced, by NULL too. Columns of
    ``source`` named in ``order`` but absent from ``target`` only order the rows.
    """
    applied = latest_per_key(source, keys, order).select(*[quoted(c) for c in target.columns])
    return without_match(target, source, keys).unionByName(applied)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of ``source`` to append: for each key that ``target`` lacks the first one in ``order``.

    Columns of ``source`` named in ``order`` but absent from ``target`` only order the rows.
    """
    kept = _edge_row(source, keys, order, F.min_by).select(*[quoted(c) for c in target.columns])
    return kept.join(target.select(*[quoted(k) for k in keys]), keys, "left_anti")
