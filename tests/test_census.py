import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators.describe import describe_by
from millrace.operators.tally import value_counts
from millrace.plans import census
from millrace.sources.schemas import CENSUS

COLUMNS = [f.name for f in CENSUS.fields]


def person(**values):
    base = dict(
        age=30, workclass="w", fnlwgt=1, education="Masters", marital="Never-married", occupation="Sales",
        race="White", sex="Male", hours=40, country="United-States", salary="<=50K",
    )
    base.update(values)
    return (
        base["age"], base["workclass"], base["fnlwgt"], base["education"], 1, base["marital"], base["occupation"], "r",
        base["race"], base["sex"], 0, 0, base["hours"], base["country"], base["salary"],
    )


PEOPLE = [
    person(age=16, salary=">50K"),
    person(age=17, salary=">50K", marital="Married-civ-spouse"),
    person(age=35, salary=">50K", sex="Female", education="HS-grad"),
    person(age=36, salary=">50K", country=None, marital="Married-AF-spouse"),
    person(age=70, salary=">50K", marital=None, education=None),
    person(age=71, occupation="Craft", hours=99, race="Asian-Pac-Islander"),
    person(age=9, occupation="Craft", hours=5),
    person(age=101, salary=">50K", occupation="Old", race=None),
    person(age=40, occupation="Edge", hours=99, country="Peru", salary=">50K"),
    person(age=40, occupation="Edge", hours=6, country="Peru", salary=">50K", marital="married"),
    person(age=20, occupation="Gap", hours=None, sex=None),
    person(age=20, occupation=None, hours=50, salary=None),
]


@pytest.fixture(scope="module")
def people(frame):
    return frame(CENSUS, PEOPLE)


def test_counts_and_means(people, rows):
    assert rows(census.count_by_sex(people)) == [("Male", 10), ("Female", 1)]
    ages = [p[0] for p in PEOPLE if p[9] == "Male"]
    assert rows(census.mean_age(people)) == [(pytest.approx(statistics.mean(ages)),)]
    assert rows(census.share_of_country(people)) == [(pytest.approx(9 / 12),)]


def test_age_by_salary_uses_sample_deviation(people, rows):
    got = {r[0]: r[1:] for r in rows(census.age_by_salary(people))}
    for salary in (">50K", "<=50K"):
        ages = [p[0] for p in PEOPLE if p[14] == salary]
        assert got[salary] == (pytest.approx(statistics.mean(ages)), pytest.approx(statistics.stdev(ages)))
    single = census.mean_and_std(people.where(F.col("age") == 71), "salary", "age")
    assert rows(single) == [("<=50K", 71.0, None)]


def test_degrees(people, rows):
    assert rows(census.high_earners_have_degree(people)) == [(False,)]
    assert sorted(r[0] for r in rows(census.high_earners_without_degree(people))) == [35, 70]
    with_degree = people.where(F.col("education") == "Masters")
    assert rows(census.high_earners_have_degree(with_degree)) == [(True,)]
    assert rows(census.high_earners_have_degree(people.limit(0))) == [(True,)]


def test_describe(people, rows):
    got = {(r["race"], r["sex"], r["column"]): r for r in census.describe_by_race_and_sex(people).collect()}
    assert len(got) == 3 * 6  # three groups without NULL keys, six numeric columns
    ages = [p[0] for p in PEOPLE if p[8] == "White" and p[9] == "Male"]
    r = got[("White", "Male", "age")]
    assert r["count"] == len(ages)
    assert (r["mean"], r["std"]) == (pytest.approx(np.mean(ages)), pytest.approx(np.std(ages, ddof=1)))
    assert [r["min"], r["p25"], r["p50"], r["p75"], r["max"]] == pytest.approx(
        [min(ages), *np.percentile(ages, [25, 50, 75]), max(ages)]
    )
    assert rows(census.max_age(people)) == [(71,)]


def test_describe_is_the_same_when_every_group_is_hot(people, rows):
    plain = sorted(rows(describe_by(people, ["race", "sex"])), key=repr)
    assert sorted(rows(describe_by(people, ["race", "sex"], task_values=1)), key=repr) == plain


def test_marriage_prefix_is_case_sensitive(people, rows):
    men = [p for p in PEOPLE if p[9] == "Male" and p[5] is not None]
    expected = {}
    for married in (True, False):
        group = [p for p in men if p[5].startswith("Married") == married]
        expected[married] = sum(p[14] == ">50K" for p in group) / len(group)
    assert dict(rows(census.high_share_by_marriage(people))) == pytest.approx(expected)


def test_longest_hours(people, rows):
    assert rows(census.longest_hours(people)) == [(99, 2, 50.0)]


def test_hours_by_country(people, rows):
    got = {r[0]: r[1:] for r in rows(census.hours_by_country(people))}
    assert got["Peru"] == (None, 52.5)
    assert set(got) == {"Peru", "United-States"}


def test_age_groups(people, rows):
    groups = {r["age"]: r["AgeGroup"] for r in census.with_age_group(people).collect()}
    assert groups == {
        16: None, 17: "young", 35: "young", 36: "adult", 70: "adult", 71: "retiree", 9: None, 101: None,
        40: "adult", 20: "young",
    }
    assert rows(census.high_earners_per_age_group(people)) == [("young", 2, 0), ("adult", 4, 1), ("retiree", 0, 2)]
    assert rows(census.top_age_group(people)) == [("adult",)]
    tied = people.where(F.col("age").isin(17, 36))
    assert rows(census.top_age_group(tied)) == [("young",)]


def test_occupations(people, rows):
    described = {r[0]: r[1:] for r in rows(census.describe_occupations(people))}
    assert described["Edge"] == (2, 1, "Edge", 2)
    assert None not in described
    # Craft has a 5-hour row, Gap an unknown one, Old is too old; a mean of exactly 40 stays.
    assert {r["occupation"] for r in census.young_busy_occupations(people).collect()} == {"Sales", "Edge"}


def test_value_counts_orders_by_frequency(frame, rows):
    df = frame("v string", [("b",), ("a",), ("a",), (None,), ("c",)])
    assert rows(value_counts(df, "v")) == [("a", 2), ("b", 1), ("c", 1)]
