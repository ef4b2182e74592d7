import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import parts
from millrace.plans import bom as plan
from millrace.session import materialise
from millrace.sources.schemas import BOM

from .test_closure import walk


def line(year, month, made, made_type, release, made_qty, part, part_type, part_release, part_qty, plant="A"):
    def amount(x):
        return None if x is None else Decimal(x)

    return (year, month, made, made_type, release, amount(made_qty), part, part_type, part_release, amount(part_qty), plant)


def annual_by_hand(data, max_depth=None):
    """The annual result straight from its definition, row by row."""
    produced = {r[2] for r in data}
    out = defaultdict(lambda: [Decimal(0), Decimal(0), False, False])
    for plant in {r[10] for r in data if r[10] is not None}:
        mine = [r for r in data if r[10] == plant]
        edges = {(r[2], r[6]) for r in mine if r[6] in produced}
        seeds = {(r[2], r[6]) for r in mine if r[4] == "FIN" and r[6] in produced}
        attributes = {(r[2], r[4], r[3]) for r in mine if r[4] == "FIN"}
        quantities = defaultdict(set)
        for r in mine:
            if r[4] == "FIN":
                quantities[(r[2], r[0])].add((r[1], r[5]))
        for fin, member in walk(edges, seeds, max_depth):
            for r in mine:
                if r[2] != member or (fin, r[0]) not in quantities:
                    continue
                known = [q for _, q in quantities[(fin, r[0])] if q is not None]
                total = sum(known) if known else None
                for attr in attributes:
                    if attr[0] != fin:
                        continue
                    cell = out[(plant, fin, attr[1], attr[2], total, r[2], r[4], r[3], r[6], r[8], r[7], r[0])]
                    for i, q in ((0, r[5]), (1, r[9])):
                        if q is not None:
                            cell[i] += q
                            cell[i + 2] = True
    return {k: (v[0] if v[2] else None, v[1] if v[3] else None) for k, v in out.items()}


def monthly_by_hand(data):
    produced = {r[2] for r in data}
    fins = {r[2] for r in data if r[4] == "FIN"}
    edges = {(r[2], r[6]) for r in data if r[6] in produced}
    seeds = {(s, t) for s, t in edges if s in fins}
    info = {(r[10], r[0], r[1], r[2], r[4], r[3], r[5]) for r in data if r[2] in fins}
    out = defaultdict(lambda: [Decimal(0)] * 3)
    for fin, member in walk(edges, seeds):
        for r in data:
            if r[2] != member:
                continue
            for plant, year, month, f, release, kind, q in info:
                if f == fin and (plant, year, month) == (r[10], r[0], r[1]):
                    key = (plant, fin, release, kind, r[2], r[4], r[3], r[6], r[8], r[7], year)
                    out[key] = [a + (b or 0) for a, b in zip(out[key], (q, r[5], r[9]))]
    return {k: tuple(v) for k, v in out.items()}


def annual(frame, rows, data, **kw):
    got = rows(plan.bom_explosion_annual(frame(BOM, data), **kw))
    assert [(r[0], r[1], r[5], r[9], r[13]) for r in got] == sorted((r[0], r[1], r[5], r[9], r[13]) for r in got)
    keyed = {(r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7], r[9], r[10], r[11], r[13]): (r[8], r[12]) for r in got}
    assert len(keyed) == len(got)
    return keyed


def monthly(frame, rows, data):
    got = rows(plan.bom_explosion_monthly(frame(BOM, data)))
    keyed = {(r[0], r[1], r[2], r[3], r[5], r[6], r[7], r[9], r[10], r[11], r[13]): (r[4], r[8], r[12]) for r in got}
    assert len(keyed) == len(got)
    return keyed


SMALL = [
    # FIN 1 and 2 share sub-assembly 10; 11 is reached over two paths and leads back to 10.
    line(2023, 1, 1, 5, "FIN", "7", 10, 3, "PROD", "2"),
    line(2023, 1, 1, 5, "FIN", "7", 11, 3, "PROD", "1"),
    line(2023, 2, 1, 5, "FIN", "4", 10, 3, "PROD", "2"),
    line(2023, 2, 1, 5, "FIN", "6", 10, 3, "PROD", "2"),
    line(2024, 1, 1, 5, "FIN", None, 10, 3, "PROD", "2"),
    line(2023, 1, 2, 5, "FIN", "9", 10, 3, "PROD", "1"),
    line(2023, 1, 2, 6, "FIN", "9", 10, 3, "PROD", "1"),
    line(2023, 1, 10, 3, "PROD", "20", 11, 3, "PROD", "5"),
    line(2023, 3, 10, 3, "PROD", "30", 11, 3, "PROD", "6"),
    line(2023, 1, 10, 3, "PROD", "20", 90, None, "RM", "8"),
    line(2024, 1, 10, 3, "PROD", None, 90, None, "RM", None),
    line(2023, 1, 11, None, "PROD", "3", 10, 3, "PROD", "1"),
    line(2023, 1, 11, None, "PROD", "3", 91, None, "ADD", "1"),
    # Made in another plant only; a cycle back to the FIN.
    line(2023, 1, 11, None, "PROD", "2", 12, 3, "PROD", "1"),
    line(2023, 1, 12, 3, "PROD", "2", 1, 5, "FIN", "1", plant="B"),
    line(2023, 1, 1, 5, "FIN", "5", 12, 3, "PROD", "1", plant="B"),
    line(2023, 1, 1, 5, "PROD", "8", 92, None, "RM", "1", plant="B"),
    line(2023, 1, 10, 3, "PROD", "1", 93, None, "RM", "1", plant=None),
    line(2023, 1, 1, 5, "FIN", "3", 94, None, "RM", "1", plant=None),
]


def test_annual_small(frame, rows):
    assert annual(frame, rows, SMALL) == annual_by_hand(SMALL)


def test_monthly_small(frame, rows):
    assert monthly(frame, rows, SMALL) == monthly_by_hand(SMALL)


@pytest.mark.parametrize("seed", [1, 2])
def test_random(frame, rows, seed):
    rng = random.Random(seed)
    release = {m: "FIN" if m < 3 else "PROD" for m in range(8)}
    data = []
    for _ in range(60):
        made, part = rng.randrange(8), rng.randrange(10)
        # A third of the rows make one material.
        made = 3 if rng.random() < 0.33 else made
        data.append(
            line(
                rng.choice([2023, 2024]), rng.randrange(1, 4), made, rng.choice([1, 2, None]), release[made],
                str(rng.randrange(5)), part, rng.choice([1, None]), release.get(part, "RM"), str(rng.randrange(5)),
                rng.choice(["A", "B"]),
            )
        )
    assert annual(frame, rows, data) == annual_by_hand(data)
    assert monthly(frame, rows, data) == monthly_by_hand(data)


def test_depth_guard_only_where_asked_for(frame, rows):
    data = [line(2023, 1, 1, 1, "FIN", "1", 2, 1, "PROD", "1")]
    data += [line(2023, 1, i, 1, "PROD", "1", i + 1, 1, "PROD", "1") for i in range(2, 27)]
    data += [line(2023, 1, 27, 1, "PROD", "1", 99, 1, "RM", "1")]
    assert {k[5] for k in annual(frame, rows, data)} == set(range(2, 28))
    guarded = plan.bom_explosion_annual(frame(BOM, data), plan.GUARD_DEPTH, ordered=False)
    assert {r.prod_material_id for r in guarded.collect()} == set(range(2, 22))
    assert {k[4] for k in monthly(frame, rows, data)} == set(range(2, 28))


def test_repeated_rows_do_not_widen_the_tree(frame, rows):
    once = plan.fin_members(frame(BOM, SMALL), True, 20)
    twice = plan.fin_members(frame(BOM, SMALL + SMALL), True, 20)
    assert sorted(rows(once)) == sorted(rows(twice))


def test_view(spark, frame):
    plan.register_annual_view(frame(BOM, SMALL))
    assert spark.table("bom_explosion").count() == len(annual_by_hand(SMALL))


def test_rows_of_the_explosions_stay_where_they_are_made(frame, rows, monkeypatch):
    """Neither what is summed up nor what is sorted crosses a shuffle: all of them are dealt by part, before the joins."""
    stored = []
    monkeypatch.setattr(plan, "materialise", lambda df: stored.append(df) or materialise(df))
    data = SMALL * 2
    for explosion in (plan.bom_explosion_monthly, plan.bom_explosion_annual):
        stored.clear()
        exploded = explosion(frame(BOM, data))
        assert not [df for df in stored if "component_consumption_quantity" in df.columns]
        above = exploded._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[0]
        assert "Exchange" not in above


def test_parts_smaller_than_a_tree(frame, rows, monkeypatch):
    monkeypatch.setattr(parts, "ROWS_A_PART", 2)
    assert annual(frame, rows, SMALL) == annual_by_hand(SMALL)
    assert monthly(frame, rows, SMALL) == monthly_by_hand(SMALL)


def test_positions_of_ordered_keys(spark, frame, rows, monkeypatch):
    """Rows are numbered by partition and place; keys alone carry the order too."""
    monkeypatch.setattr(parts, "ROWS_A_PART", 2)
    keys = ["plant", "fin_material_id", "prod_material_id", "component_id", "year"]
    stored = []
    monkeypatch.setattr(plan, "materialise", lambda df: stored.append(df) or materialise(df))
    ordered = plan.bom_explosion_annual(frame(BOM, SMALL)).select(*keys)
    assert not [df for df in stored if "component_id" in df.columns]
    at = ordered.withColumn("at", F.monotonically_increasing_id())
    got = [r[:-1] for r in sorted(rows(materialise(at)), key=lambda r: r[-1])]
    assert got == sorted(got) and len(got) == len(annual_by_hand(SMALL))
