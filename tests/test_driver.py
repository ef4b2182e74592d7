"""Every registered query against its SQL statement on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as driver
from millrace import session

from .compare import database, difference

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def db():
    return database(SF)


def test_names():
    assert set(driver.core_queries()) == set(driver.STATEMENTS)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(driver.core_queries()))
def test_query(spark, db, name, monkeypatch):
    """Results and plans, those of stored steps included."""
    plans, write = [], session._write_scratch

    def watched(df):
        plans.append(plan_of(df))
        return write(df)

    monkeypatch.setattr(session, "_write_scratch", watched)
    df = driver.core_queries()[name](spark, SF)
    assert difference(df, db, driver.STATEMENTS[name]) is None
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "Python"):
        assert not any(unwanted in plan for plan in [*plans, plan_of(df)])


def test_filters_and_columns_reach_the_scan(spark):
    plan = driver.max_price_of_group(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_brand,Brand#7), EqualTo(p_type,PROMO)" in plan
    assert "ReadSchema: struct<p_brand:string,p_type:string,p_retailprice:double>" in plan
    plan = driver.flag_counts(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_returnflag:string>" in plan


def test_entry(spark):
    assert driver.entry(spark).count() > 0
