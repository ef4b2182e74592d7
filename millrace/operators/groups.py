"""Operations on whole groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.operators.matching import with_match
from millrace.session import materialise


def keep_groups(df: DataFrame, key: str, tests: dict[str, Column]) -> DataFrame:
    """Original rows of the groups passing every aggregate test.

    Groups are judged by a partial aggregate and their keys stored: few of them
    are broadcast to the rows, and with many a hot group's rows can be split in
    the join. NULL keys form no group.
    """
    judged = df.where(quoted(key).isNotNull()).groupBy(quoted(key)).agg(
        *[test.alias(name) for name, test in tests.items()]
    )
    for name in tests:
        judged = judged.where(F.col(name))
    return with_match(df, materialise(judged.select(quoted(key))), key)


def describe_groups(df: DataFrame, key: str) -> DataFrame:
    """Per group of ``key``: count, distinct values, most common value, its frequency.

    Inside a group the key has one value, so the last three follow from the count.
    """
    return (
        df.where(quoted(key).isNotNull())
        .groupBy(quoted(key).alias(key))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            quoted(key),
            "count",
            F.lit(1).cast("long").alias("unique"),
            quoted(key).alias("top"),
            F.col("count").alias("freq"),
        )
    )
