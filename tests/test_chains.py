import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators import chains
from tests.test_closure import walk


def run(frame, rows, edges, seeds, max_depth=None):
    found = chains.reachable_over_chains(
        frame("src long, dst long", edges), frame("root long, node long", seeds), max_depth=max_depth
    )
    assert found.dtypes[-1] == ("depth", "int")
    got = rows(found)
    assert len(got) == len(set(r[:2] for r in got))
    return {(r[0], r[1]): r[2] for r in got}


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    edges=st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=16),
    seeds=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 12)), min_size=1, max_size=5),
    depth=st.sampled_from([None, 1, 3]),
)
def test_equals_breadth_first_search(frame, rows, edges, seeds, depth):
    assert run(frame, rows, edges, seeds, depth) == walk(edges, seeds, depth)


def test_chains_of_many_lengths_meet(frame, rows):
    rng = random.Random(4)
    edges, new = [], 100
    for _ in range(14):
        a, b = rng.randrange(6), rng.randrange(6)
        path = [a, *range(new, new + rng.randrange(9)), b]
        new += 9
        edges += list(zip(path, path[1:]))
    edges += [(500 + i, 500 + (i + 1) % 7) for i in range(7)] + [(600, 600)]
    seeds = [(1, 0), (2, 103), (3, 503), (4, 600), (5, 118), (5, 2), (6, 900)]
    assert run(frame, rows, edges, seeds) == walk(edges, seeds)


def counted(monkeypatch):
    rounds = []
    kept, added = chains._counted, chains._Depths.add
    monkeypatch.setattr(chains, "_counted", lambda r: rounds.append("jump") or kept(r))
    monkeypatch.setattr(chains._Depths, "add", lambda self, r, turn: rounds.append("walk") or added(self, r, turn))
    return rounds


@pytest.mark.parametrize("closed", [False, True])
def test_rounds_grow_with_the_logarithm(frame, rows, monkeypatch, closed):
    n = 5_000 if closed else 2_000
    rounds = counted(monkeypatch)
    edges = [(i, i + 1) for i in range(1, n)] + [(n, 1)] * closed
    found = run(frame, rows, edges, [(0, 5)])
    assert found == {(0, node): (node - 5) % n + 1 for node in range(1 if closed else 5, n + 1)}
    assert len(rounds) < (36 if closed else 20)


def test_scopes_nulls_and_nothing(frame, rows):
    edges = frame("p string, src string, dst string", [("a", "1", "2"), ("b", "2", "3"), ("a", "2", "4"), ("a", None, "5"), ("a", "4", None)])
    seeds = frame("p string, root string, node string", [("a", "9", "1"), (None, "9", "1")])
    got = rows(chains.reachable_over_chains(edges, seeds, ["p"]))
    assert sorted(r for r in got if r[0]) == [("a", "9", "1", 1), ("a", "9", "2", 2), ("a", "9", "4", 3)]
    assert run(frame, rows, [], []) == {}
