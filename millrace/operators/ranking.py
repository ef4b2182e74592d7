"""Top-k, with and without ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.operators.matching import peak_of


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows in ``order``; each task keeps only its own ``k``."""
    return df.orderBy(*order).limit(k)


def top_k_with_ties(df: DataFrame, measure: str, k: int) -> DataFrame:
    """All rows holding one of the ``k`` greatest distinct values of ``measure``.

    A global dense rank would move every row into one partition; the ``k``
    distinct values fit in a broadcast whatever the size of ``df``. ``df`` is read
    twice, so store it first if it is costly.
    """
    best = (
        df.select(quoted(measure).alias("__best"))
        .where(F.col("__best").isNotNull())
        .distinct()
        .orderBy(F.col("__best").desc())
        .limit(k)
    )
    return df.join(F.broadcast(best), quoted(measure) == F.col("__best"), "left_semi")


def argmax_with_ties(df: DataFrame, measure: str) -> DataFrame:
    """All rows holding the maximum of ``measure``; ``df`` is read twice."""
    return df.where(quoted(measure) == peak_of(df, measure))
