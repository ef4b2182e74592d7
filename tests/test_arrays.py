import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import arrays


def test_negate_between_excludes_bounds(frame, rows):
    df = frame("v int", [(i,) for i in (2, 3, 4, 7, 8, 9, None)])
    assert rows(df.select(arrays.negate_between(F.col("v"), 3, 8))) == [(i,) for i in (2, 3, -4, -7, 8, 9, None)]
    vector = frame("v array<int>", [([3, 5, 8],)])
    assert rows(vector.select(arrays.negate_between_in(F.col("v"), 3, 8))) == [([3, -5, 8],)]


def test_zero_max_replaces_every_maximum(frame, rows):
    df = frame("k int, v int", [(1, 5), (2, 9), (3, 9), (4, None)])
    assert sorted(rows(arrays.zero_max(df, "v"))) == [(1, 5), (2, 0), (3, 0), (4, None)]
    vector = frame("v array<int>", [([9, 1, 9],)])
    assert rows(vector.select(arrays.zero_max_in(F.col("v")))) == [([0, 1, 0],)]


def test_direct_product_keeps_duplicates(frame, rows):
    df = frame("k int, a array<int>, b array<string>", [(1, [1, 1, 2], ["x", "y"]), (2, [], ["z"])])
    expected = sorted((1, p, q) for p, q in itertools.product([1, 1, 2], ["x", "y"]))
    assert sorted(rows(arrays.direct_product(df, ["a", "b"], ["p", "q"]))) == expected


@pytest.mark.parametrize("batch", [4096, 2])
def test_rows_hitting_all(frame, rows, batch):
    rng = random.Random(3)
    # Value 1 is hot on both sides.
    a = [(i, [rng.choice([1, 1, rng.randrange(7)]) for _ in range(3)]) for i in range(60)] + [(60, None), (61, [None, 1, 2])]
    b = [([1, 2],), ([3, 1],), ([1, 2],), ([1, None],), ([5, 1],), ([2, 4],)]
    fa, fb = frame("i int, v array<int>", a), frame("p array<int>", b)
    got = rows(arrays.rows_hitting_all(fa, "v", fb, "p", batch_patterns=batch))
    expected = [r for r in a if r[1] and all(set(p) & set(r[1]) - {None} for (p,) in b)]
    assert expected and sorted(got) == expected
    assert arrays.rows_hitting_all(fa, "v", fb.limit(0), "p").count() == len(a)


def test_rows_hitting_all_with_wide_rows_and_many_patterns(spark, rows):
    wide = spark.range(200).select("id", F.transform(F.sequence(F.lit(0), F.lit(29)), lambda i: (F.col("id") * 7 + i * i) % 400).alias("v"))
    patterns = spark.range(20_000).select(F.transform(F.sequence(F.lit(0), F.lit(29)), lambda i: (F.col("id") + i * 13) % 400).alias("p"))
    sets = {frozenset((n + i * 13) % 400 for i in range(30)) for n in range(20_000)}
    expected = [n for n in range(200) if all({(n * 7 + i * i) % 400 for i in range(30)} & s for s in sets)]
    assert sorted(r[0] for r in rows(arrays.rows_hitting_all(wide, "v", patterns, "p"))) == expected


def test_rows_not_constant_keeps_nan_rows(frame, rows):
    nan = float("nan")
    df = frame("k int, v array<double>", [(1, [2.0, 2.0, 3.0]), (2, [3.0, 3.0, 3.0]), (3, [nan, nan, nan])])
    assert sorted(r[0] for r in rows(arrays.rows_not_constant(df, "v"))) == [1, 3]


def test_unique_rows_are_sorted(frame, rows):
    df = frame("a int, b int", [(2, 1), (0, 2), (2, 1), (0, 1)])
    assert rows(arrays.unique_rows(df)) == [(0, 1), (0, 2), (2, 1)]


def entries(matrix):
    return [(i, j, v) for i, row in enumerate(matrix) for j, v in enumerate(row)]


def test_diagonal_product(frame, rows):
    # The published example; its answer is 3.
    example = [[1, 0, 1], [2, 0, 2], [3, 0, 3], [4, 4, 4]]
    schema = "i long, j long, value long"
    assert rows(arrays.diagonal_product(frame(schema, entries(example)))) == [(3.0,)]
    assert rows(arrays.diagonal_product(frame(schema, entries([[0, 5], [5, 0]])))) == [(1.0,)]
    assert rows(arrays.diagonal_product(frame(schema, []))) == [(1.0,)]


def test_same_multiset(frame, rows):
    def vector(*values):
        return frame("v int", [(v,) for v in values])

    def same(x, y):
        return rows(arrays.same_multiset(x, y, "v"))[0][0]

    # The published example; its answer is yes.
    assert same(vector(1, 2, 2, 4), vector(4, 2, 1, 2))
    assert not same(vector(1, 2, 2, 4), vector(4, 2, 1, 1))
    assert not same(vector(1), vector(1, 1))
    assert same(vector(None, 1), vector(1, None))
    assert same(vector(), vector())


def test_pairwise_distance(frame, rows):
    rng = random.Random(12)
    x, y = ([[rng.uniform(-3, 3) for _ in range(4)] for _ in range(n)] for n in (6, 3))
    y.append(list(x[2]))
    df = frame("k int, x array<array<double>>, y array<array<double>>", [(7, x, y)])
    got = {(r[1], r[2]): r[3] for r in rows(arrays.pairwise_distance(df, "x", "y"))}
    expected = {(i, j): math.dist(p, q) for i, p in enumerate(x) for j, q in enumerate(y)}
    assert got == pytest.approx(expected)
    assert got[(2, 3)] == 0
    uneven = frame("x array<array<double>>, y array<array<double>>", [([[1.0]], [[1.0, 2.0]])])
    assert rows(arrays.pairwise_distance(uneven, "x", "y")) == [(0, 0, None)]


def test_as_matrix(frame, rows):
    df = frame("v array<int>", [(list(range(8)),)])
    got = rows(df.select(arrays.as_matrix(F.col("v"), rows=2, width=3, start=1)))[0][0]
    assert got == np.arange(1, 7).reshape(2, 3).tolist()
