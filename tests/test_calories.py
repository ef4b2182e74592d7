import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from millrace.operators import quantiles
from millrace.operators.quantiles import percentiles_by
from millrace.plans import calories

# Calories per serving of 77 cereals.
CALORIES = [
    70, 120, 70, 50, 110, 110, 110, 130, 90, 90, 120, 110, 120, 110, 110, 110, 100, 110, 110, 110, 100, 110, 100, 100,
    110, 110, 100, 120, 120, 110, 100, 110, 100, 110, 120, 120, 110, 110, 110, 140, 110, 100, 110, 100, 150, 150, 160,
    100, 120, 140, 90, 130, 120, 100, 50, 50, 100, 100, 120, 100, 90, 110, 110, 80, 90, 90, 110, 110, 90, 110, 140,
    100, 110, 110, 100, 100, 110,
]


@pytest.fixture(scope="module")
def cereals(frame):
    return frame("value double", [(float(c),) for c in CALORIES])


def test_golden_values(cereals, rows):
    assert rows(calories.mean_gap(cereals, "value")) == [(pytest.approx(106.88311688), pytest.approx(46.88311688))]
    assert rows(calories.population_std(cereals, "value")) == [(pytest.approx(19.35718534),)]
    assert rows(calories.share_above(cereals, "value", 60)) == [(pytest.approx(96.10389610),)]
    values = [r[0] for r in rows(calories.sorted_values(cereals, "value"))]
    assert values == sorted(CALORIES) and (values[0], values[-1]) == (50, 160)


@pytest.mark.parametrize("limit", [1 << 20, 4])
def test_golden_percentiles(cereals, rows, limit):
    assert rows(calories.median(cereals, "value", limit)) == [(110.0,)]
    assert rows(calories.lowest_percentile_above(cereals, "value", 60, limit)) == [(4, 70.0)]
    assert rows(calories.lowest_percentile_above(cereals, "value", 160, limit)) == [(None, None)]
    third = rows(percentiles_by(cereals, [], "value", [0.03], limit))
    assert third[0][0] == [pytest.approx(55.6)]


@pytest.mark.parametrize("limit", [1 << 20, 10])
def test_grouped_percentiles_match_numpy(frame, rows, limit):
    rng = random.Random(11)
    groups = {None: 5, "one": 1, "small": 7, "hot": 300}
    data = {g: [rng.choice([1.0, rng.gauss(0, 5)]) for _ in range(n)] for g, n in groups.items()}
    df = frame("g string, v double", [(g, v) for g, vs in data.items() for v in vs] + [("hot", None)])
    fractions = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    got = {r[0]: r[1] for r in rows(percentiles_by(df, ["g"], "v", fractions, limit))}
    assert set(got) == set(groups)
    for g, values in data.items():
        assert got[g] == pytest.approx(list(np.percentile(values, [100 * f for f in fractions])))


@pytest.mark.parametrize("accuracy", [1, 3, 2000])
def test_ranks_outside_their_bracket(spark, rows, monkeypatch, accuracy):
    """A coarse sketch misplaces brackets; the values are found in the parts beside them."""
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    df = spark.range(60_000).selectExpr("id % 3 AS g", "pow(pmod(hash(id), 30011), 2) AS v", "IF(id % 3 = 1, NULL, pmod(hash(id), 7)) AS w")
    fractions = [0.0, 0.01, 0.25, 0.5, 0.777, 1.0]
    data = df.toPandas()
    for limit in (500, quantiles.TASK_VALUES):
        got = rows(quantiles.percentiles_of(df, ["g"], ["v", "w"], fractions, [F.count("*").alias("n")], limit))
        assert sorted(r[0] for r in got) == [0, 1, 2]
        for g, n, (v, w) in got:
            own = data[data.g == g]
            assert n == len(own) and v == pytest.approx(list(np.percentile(own.v, [100 * f for f in fractions])))
            assert w == ([None] * 6 if g == 1 else pytest.approx(list(np.percentile(own.w, [100 * f for f in fractions]))))
