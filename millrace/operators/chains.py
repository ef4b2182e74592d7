"""Transitive closure of graphs with long chains or rings.

A node with one edge in and one edge out is inside a chain. Each chain becomes one weighted
edge, found by pointer jumping, so a chain of ``n`` nodes takes about ``log2(n)`` rounds;
a ring that nothing enters or leaves is first cut at its least node. What is left is
walked by rounds of joins, one per weighted edge of a path, and the nodes
inside the chains get their depths from their places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.session import discard, materialise, scratch_path, shuffles_removed


def reachable_over_chains(
    edges: DataFrame, seeds: DataFrame, scope: list[str] | None = None, max_depth: int | None = None
) -> DataFrame:
    """As ``closure.reachable``: every ``(scope, root, node)`` below the seeds with its least ``depth``.

    Seeds count as depth 1 and may lie inside a chain. Repeated edges and seeds count once, edges with a
    null end are passed over, a null scope matches none, and no seeds give no rows. The
    driver sees row counts only.
    """
    scope = list(scope or [])
    key = scope + ["root", "node"]
    kept = materialise(edges.where("src IS NOT NULL AND dst IS NOT NULL").select(*scope, "src", "dst").distinct())
    places = chain_places(kept, scope)
    hops, entries, exits = _contracted(kept, places, scope)
    starts = materialise(seeds.select(*key).distinct().join(places, scope + ["node"], "left"))
    outer = starts.where("chain IS NULL").select(*key, F.lit(1).cast("long").alias("depth"))
    inner = starts.where("chain IS NOT NULL")
    left = inner.join(exits, scope + ["chain"]).select(
        *scope, "root", F.col("dst").alias("node"), (F.col("last") - F.col("place") + 2).alias("depth")
    )
    met = _walk(outer.union(left), hops, scope, max_depth)
    # A chain entered from its head is passed from place 0, one with a seed in it from the seed's place.
    entered = met.join(entries, scope + ["node"]).groupBy(*scope, "root", "chain").agg((F.min("depth") + 1).alias("base"))
    entered = entered.withColumn("since", F.lit(0).cast("long"))
    within = inner.select(*scope, "root", "chain", (1 - F.col("place")).alias("base"), F.col("place").alias("since"))
    spans = materialise(entered.unionByName(within))
    passed = spans.join(places, scope + ["chain"]).where("place >= since").select(*key, (F.col("base") + F.col("place")).alias("depth"))
    if max_depth is not None:
        passed = passed.where(F.col("depth") <= max_depth)
    done = materialise(met.union(passed.groupBy(*key).agg(F.min("depth").alias("depth"))).withColumn("depth", F.col("depth").cast("int")))
    discard(kept, places, hops, entries, exits, starts, met, spans)
    return done


def chain_places(edges: DataFrame, scope: list[str]) -> DataFrame:
    """``scope, node, chain, place`` of all nodes inside chains: the chain's first node and the steps from it.

    ``edges`` are distinct and without nulls.
    """
    nothing = F.lit(None).cast(edges.schema["src"].dataType)
    ends = edges.select(*scope, F.col("src").alias("node"), nothing.alias("prev"), F.lit(1).alias("outs")).union(
        edges.select(*scope, "dst", "src", F.lit(0))
    )
    degrees = ends.groupBy(*scope, "node").agg(F.sum("outs").alias("outs"), F.count("prev").alias("ins"), F.min("prev").alias("prev"))
    inside = materialise(degrees.where("ins = 1 AND outs = 1").select(*scope, "node", "prev"))
    chained, rings = _jumped(inside, scope)
    # Only rings are left undone; each loses its least node, which makes a chain of the rest.
    opened = materialise(rings.where("node != least").select(*scope, "node").join(inside, scope + ["node"]))
    rest, none = _jumped(opened, scope)
    placed = materialise(chained.union(rest))
    discard(inside, chained, rings, opened, rest, none)
    return placed


def _jumped(inside: DataFrame, scope: list[str]) -> tuple[DataFrame, DataFrame]:
    """Places of nodes in chains, and ``scope, node, least`` of the nodes of rings with the ring's least node."""
    first = inside.select(*scope, F.col("node").alias("prev"), F.lit(True).alias("follows"))
    begun = inside.join(first, scope + ["prev"], "left").withColumn("done", F.col("follows").isNull())
    rows = begun.select(
        *scope, "node", F.when(F.col("done"), F.col("node")).otherwise(F.col("prev")).alias("up"),
        F.when(F.col("done"), 0).otherwise(1).cast("long").alias("off"), "done", F.least("node", "prev").alias("least"),
    )
    rows, open_ = _counted(rows)
    covered, before = 1, None
    # A round doubles the stretch that each pointer spans. Each one ends some pointer of a chain, if one is open.
    while open_ and not (open_ == before and covered > open_):
        ahead = rows.select(
            *scope, F.col("node").alias("up"), F.col("up").alias("up2"), F.col("off").alias("off2"),
            F.col("done").alias("done2"), F.col("least").alias("least2"),
        )
        moved = rows.where("NOT done").join(ahead, scope + ["up"]).select(
            *scope, "node", F.col("up2").alias("up"), (F.col("off") + F.col("off2")).alias("off"),
            F.col("done2").alias("done"), F.least("least", "least2").alias("least"),
        )
        before = open_
        stepped, open_ = _counted(rows.where("done").union(moved))
        discard(rows)
        rows, covered = stepped, covered * 2
    chained = materialise(rows.where("done").select(*scope, "node", F.col("up").alias("chain"), F.col("off").alias("place")))
    rings = materialise(rows.where("NOT done").select(*scope, "node", "least"))
    discard(rows)
    return chained, rings


def _counted(rows: DataFrame) -> tuple[DataFrame, int]:
    """Stored rows and how many are not done."""
    seen = Observation()
    stored = materialise(rows.observe(seen, F.count_if(~F.col("done")).alias("open")))
    return stored, seen.get["open"]


def _contracted(edges: DataFrame, places: DataFrame, scope: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Weighted edges between nodes outside chains (``node, next, far``), ways into chains (``node, chain``) and out of them."""
    source = places.select(*scope, F.col("node").alias("src"), F.col("chain").alias("from"), F.col("place").alias("last"))
    target = places.select(*scope, F.col("node").alias("dst"), F.col("chain").alias("into"))
    known = materialise(edges.join(source, scope + ["src"], "left").join(target, scope + ["dst"], "left"))
    plain = known.where("from IS NULL AND into IS NULL")
    entries = materialise(known.where("from IS NULL AND into IS NOT NULL").select(*scope, F.col("src").alias("node"), F.col("into").alias("chain")))
    exits = materialise(known.where("from IS NOT NULL AND into IS NULL").select(*scope, F.col("from").alias("chain"), "last", "dst"))
    through = entries.join(exits, scope + ["chain"]).select(*scope, "node", F.col("dst").alias("next"), (F.col("last") + 2).alias("far"))
    direct = plain.select(*scope, F.col("src").alias("node"), F.col("dst").alias("next"), F.lit(1).cast("long").alias("far"))
    hops = materialise(direct.union(through).groupBy(*scope, "node", "next").agg(F.min("far").alias("far")))
    discard(known)
    return hops, entries, exits


def _walk(starts: DataFrame, hops: DataFrame, scope: list[str], max_depth: int | None) -> DataFrame:
    """Least depth of each ``scope, root, node``; a pair goes on whenever its depth has become less."""
    key = scope + ["root", "node"]
    found = _Depths(starts, key)

    def least(rows: DataFrame) -> DataFrame:
        rows = rows if max_depth is None else rows.where(F.col("depth") <= max_depth)
        return rows.groupBy(*key).agg(F.min("depth").alias("depth"))

    turn = 0
    added = found.add(least(starts), turn)
    while added:
        stepped = found.turn(turn).join(hops, scope + ["node"]).select(
            *scope, "root", F.col("next").alias("node"), (F.col("depth") + F.col("far")).alias("depth")
        )
        known = found.least().withColumnRenamed("depth", "known")
        better = least(stepped).join(known, key, "left").where("known IS NULL OR depth < known").drop("known")
        turn += 1
        added = found.add(better.select(*key, "depth"), turn)
    return found.close()


class _Depths:
    """Depths met so far: a table of one bucket per shuffle partition and one partition per round."""

    def __init__(self, like: DataFrame, key: list[str]):
        self.spark, self.key, self.path = like.sparkSession, key, scratch_path(like.sparkSession)
        self.name = "depths_" + self.path.rsplit("/", 1)[1]
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def add(self, rows: DataFrame, turn: int) -> int:
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("turn", F.lit(turn))
        with shuffles_removed(self.spark):
            counted.repartition(self.buckets, *self.key).write.partitionBy("turn").bucketBy(self.buckets, *self.key).option(
                "path", self.path
            ).saveAsTable(self.name, mode="append")
        return seen.get["rows"]

    def turn(self, turn: int) -> DataFrame:
        return self.spark.table(self.name).where(F.col("turn") == turn).select(*self.key, "depth")

    def least(self) -> DataFrame:
        return self.spark.table(self.name).groupBy(*self.key).agg(F.min("depth").alias("depth"))

    def close(self) -> DataFrame:
        """The least depths, stored, after the name is given up."""
        done = materialise(self.least())
        self.spark.sql(f"DROP TABLE {self.name}")
        return done
