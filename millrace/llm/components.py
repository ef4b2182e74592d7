"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import discard, materialise, materialise_counted


def stars(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that is not the least one of its component.

    ``edges`` holds two columns ``a, b`` of one type. Alternates large and small
    stars: every node hands its larger neighbours, then its smaller ones, to the
    least node it knows. Both steps keep the components, and the least node of a
    component ends as the centre of a star after a number of rounds that grows
    with the logarithm of its size. The driver sees a count and a checksum a round.

    Nulls and loops are dropped; repeated and reversed edges count once; no edges
    give no rows.
    """
    a, b = F.col("a"), F.col("b")
    kept, total = _stored(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")))
    while total[0]:
        wide, _ = _stored(_large_star(kept))
        narrow, after = _stored(_small_star(wide))
        discard(kept, wide)
        kept, before, total = narrow, total, after
        if before == after:
            break
    return kept.select(a.alias("node"), b.alias("root"))


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Distinct edges, written once, with their number and a checksum."""
    stored, rows = materialise_counted(edges.distinct())
    check = stored.agg(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()[0]
    return stored, (rows, check)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges run from the larger node to the smaller one.
    least = materialise(edges.groupBy("a").agg(F.min("b").alias("m")))
    handed = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.union(least.select("a", F.col("m").alias("b")))
