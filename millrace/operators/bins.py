"""Labelled, right-closed bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import quoted


def label_bins(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Label of the bin ``(edge, next edge]`` holding ``value``; NULL outside all."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one label per pair of neighbouring edges")
    chain = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > F.lit(low)) & (value <= F.lit(high))
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain


def bin_order(spark: SparkSession, labels: list[str], name: str) -> DataFrame:
    """The labels as a dimension with their order; as long as the label list."""
    rows = [F.struct(F.lit(l).alias(name), F.lit(i).alias("ord")) for i, l in enumerate(labels)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def bin_counts(df: DataFrame, column: str, labels: list[str], count: str = "count") -> DataFrame:
    """Rows per label with empty bins as 0, plus the label order in ``ord``."""
    counts = df.groupBy(quoted(column)).agg(F.count(F.lit(1)).alias(count))
    dimension = F.broadcast(bin_order(df.sparkSession, labels, column))
    return (
        dimension.join(counts, column, "left")
        .select(quoted(column), F.coalesce(F.col(count), F.lit(0)).cast("long").alias(count), "ord")
        .orderBy("ord")
    )


def top_bin(counts: DataFrame, count: str = "count") -> DataFrame:
    """The fullest bin; the first in label order when several tie."""
    return counts.orderBy(F.col(count).desc(), F.col("ord").asc()).limit(1)
