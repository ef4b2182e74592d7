import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import closure
from millrace.operators.closure import reachable


def walk(edges, seeds, max_depth=None):
    """Least depth of every node below each root, breadth first, seeds at depth 1."""
    found = {}
    for root, node in set(seeds):
        found[(root, node)] = 1
    frontier, depth = set(found), 1
    while frontier and (max_depth is None or depth < max_depth):
        depth += 1
        frontier = {(r, t) for r, n in frontier for s, t in edges if s == n} - set(found)
        found.update({pair: depth for pair in frontier})
    return found


def run(frame, rows, edges, seeds, max_depth=None):
    e = frame("src long, dst long", edges)
    s = frame("root long, node long", seeds)
    got = rows(reachable(e, s, max_depth=max_depth))
    assert len(got) == len(set(r[:2] for r in got))
    return {(r[0], r[1]): r[2] for r in got}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    edges=st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=25),
    seeds=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=5),
    depth=st.sampled_from([None, 1, 3]),
)
def test_equals_breadth_first_search(frame, rows, edges, seeds, depth):
    assert run(frame, rows, edges, seeds, depth) == walk(edges, seeds, depth)


def test_hot_node(frame, rows):
    rng = random.Random(1)
    edges = [(i, 0) for i in range(1, 60)] + [(0, i) for i in range(60, 90)] + [(60, 1)]
    seeds = [(r, rng.randrange(1, 60)) for r in range(20)]
    assert run(frame, rows, edges, seeds) == walk(edges, seeds)


def test_edges_stay_in_their_scope(frame, rows):
    edges = frame("p string, src long, dst long", [("a", 1, 2), ("b", 2, 3), ("a", 2, 4)])
    seeds = frame("p string, root long, node long", [("a", 9, 1)])
    assert sorted(rows(reachable(edges, seeds, ["p"]))) == [("a", 9, 1, 1), ("a", 9, 2, 2), ("a", 9, 4, 3)]


def test_no_seeds(frame, rows):
    assert rows(reachable(frame("src long, dst long", [(1, 2)]), frame("root long, node long", []))) == []


@pytest.mark.parametrize("depth, count", [(20, 20), (None, 25)])
def test_long_chain(frame, rows, depth, count):
    edges = [(i, i + 1) for i in range(1, 25)]
    assert len(run(frame, rows, edges, [(0, 1)], depth)) == count


def test_files_follow_the_pairs(spark, frame):
    """Neither a high setting nor many rounds leave many small files to be listed in every round."""
    edges = frame("src long, dst long", [(r * 100 + i, r * 100 + i + 1) for r in range(30) for i in range(25)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        found = reachable(edges, frame("root long, node long", [(r, r * 100) for r in range(30)]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found.count() == 30 * 26
    assert len(found.inputFiles()) <= (closure.BATCHES + 1) * spark.sparkContext.defaultParallelism


def test_large_frontier_is_not_sent_to_the_driver(spark, monkeypatch):
    plans, add = [], closure._Seen.add

    def noted(seen, level, depth):
        plans.append(level._jdf.queryExecution().sparkPlan().toString())
        return add(seen, level, depth)

    monkeypatch.setattr(closure._Seen, "add", noted)
    n = closure.BROADCAST_ROWS + 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        roots = spark.range(n).select(F.col("id").alias("root"), (F.col("id") % 7 + n).alias("node"))
        edges = spark.range(n, n + 7).select(F.col("id").alias("src"), (F.col("id") + 7).alias("dst"))
        assert reachable(edges, roots).count() == 2 * n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 3 and "BroadcastNestedLoopJoin" not in plans[1]
    assert "BroadcastHashJoin" not in plans[1]


def test_outgrown_buckets(spark, frame, rows, monkeypatch):
    monkeypatch.setattr(closure, "PAIRS_A_BUCKET", 5)
    rng = random.Random(3)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(70)]
    seeds = [(r, r) for r in range(40)]
    assert run(frame, rows, edges, seeds) == walk(edges, seeds)
