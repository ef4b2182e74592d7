"""Transitive closure by rounds of distributed joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import discard_path, materialise, scratch_path, shuffles_removed

# Pairs a bucket, so that a task sorts them in memory; batches of files after which a
# table is written anew; rows that a driver can hold for a broadcast.
PAIRS_A_BUCKET = 500_000
BATCHES = 8
BROADCAST_ROWS = 50_000


def reachable(
    edges: DataFrame,
    seeds: DataFrame,
    scope: list[str] | None = None,
    max_depth: int | None = None,
    prepared: bool = False,
) -> DataFrame:
    """Every ``(scope, root, node)`` reachable from the seeds, with its least depth.

    ``edges`` holds ``scope + [src, dst]``, ``seeds`` holds ``scope + [root, node]``
    and counts as depth 1. Edges never leave their scope. Cycles are safe: a pair
    enters the result once, in the round that first meets it, so the rounds end
    when a round adds nothing or ``max_depth`` is reached. ``prepared`` says
    that edges and seeds are distinct and the edges stored already.

    The driver only learns each round's row count. What was seen is one stored table,
    bucketed by its key, with a batch of files per round: a round appends its new pairs
    and the next one reads that batch, so lineage is one round long and only new
    pairs are moved. Buckets follow the number of rows, and a table of many batches is
    written anew, so its files stay few. The frontier and the edges are shuffled for
    their join, with a hot node split by the adaptive skew join; only a frontier of
    few rows is broadcast.
    """
    scope = list(scope or [])
    key = scope + ["root", "node"]
    kept = edges if prepared else materialise(edges.select(*scope, "src", "dst").distinct())
    hops = kept.select(*scope, F.col("src").alias("node"), F.col("dst").alias("__next"))
    first = seeds.select(*key)
    seen = _Seen(first, key, kept.count())
    depth = 1
    added = seen.add(first if prepared else first.distinct(), depth)
    while added and (max_depth is None or depth < max_depth):
        seen.tidy()
        frontier = seen.newest()
        stepped = (
            frontier.hint("broadcast" if added <= BROADCAST_ROWS else "merge").join(hops, scope + ["node"])
            .select(*scope, "root", F.col("__next").alias("node"))
            .repartition(seen.buckets, *key)
            .distinct()
        )
        depth += 1
        added = seen.add(stepped.join(seen.pairs().hint("merge"), key, "left_anti"), depth)
    return seen.close()


class _Seen:
    """Pairs met so far with their depth, as a bucketed table of one partition per batch; the last batch is the last depth."""

    def __init__(self, like: DataFrame, key: list[str], expected: int):
        self.spark, self.key = like.sparkSession, key
        self.schema = like.withColumn("depth", F.lit(0)).schema
        self.rows, self.batch, self.depth, self.expected = 0, 0, 0, expected
        self._begin()

    def _begin(self) -> None:
        self.path = scratch_path(self.spark)
        self.name = "seen_" + self.path.rsplit("/", 1)[1]
        most = max(self.rows, self.expected)
        self.buckets = max(self.spark.sparkContext.defaultParallelism, -(-most // PAIRS_A_BUCKET))

    def add(self, level: DataFrame, depth: int) -> int:
        """Store the pairs of one depth; returns their number."""
        self.batch, self.depth = self.batch + 1, depth
        self._append(level.withColumn("depth", F.lit(depth)).withColumn("batch", F.lit(self.batch)))
        added = self.newest().count()
        self.rows += added
        return added

    def tidy(self) -> None:
        """Write the table anew where it has many batches or has outgrown its buckets."""
        if self.batch <= BATCHES and self.rows <= 2 * self.buckets * PAIRS_A_BUCKET:
            return
        name, path = self.name, self.path
        stored = self.spark.table(name).select(*self.key, "depth")
        self._begin()
        self.batch = 1
        self._append(stored.withColumn("batch", (F.col("depth") == self.depth).cast("int")))
        self.spark.sql(f"DROP TABLE {name}")
        discard_path(self.spark, path)

    def _append(self, rows: DataFrame) -> None:
        placed = rows.repartition(self.buckets, *self.key)
        with shuffles_removed(self.spark):
            placed.write.partitionBy("batch").bucketBy(self.buckets, *self.key).option("path", self.path).saveAsTable(
                self.name, mode="append"
            )

    def pairs(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.key)

    def newest(self) -> DataFrame:
        return self.spark.table(self.name).where(F.col("batch") == self.batch).select(*self.key)

    def close(self) -> DataFrame:
        """The rows, after the name is given up."""
        self.spark.sql(f"DROP TABLE {self.name}")
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.key, "depth")
