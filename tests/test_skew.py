"""A third of the rows under one key: the join must be split, the result whole."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.groups import keep_groups
from millrace.operators.ordered import run_length_encode
from millrace.operators.quantiles import percentiles_by
from millrace.plans import bom, film
from millrace.sources.schemas import BOM

ROWS = 300_000
KEYS = 5_000


@pytest.fixture()
def small_limits(spark):
    """Limits under which these tables count as large: nothing is broadcast, skew is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed(spark):
    """``key, id``: key 0 holds a third of the rows."""
    rows = spark.range(0, ROWS, 1, 8)
    return rows.select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % KEYS).alias("key"), "id")


def is_split(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_group_filter(small_limits, skewed):
    kept = keep_groups(skewed, "key", {"many": F.count("*") > 1})
    assert is_split(kept)
    assert kept.count() == ROWS


def test_films_of_many_actors(small_limits, spark, skewed):
    films = spark.range(KEYS).select(F.col("id").alias("film_id"), F.lit("t").alias("title"))
    copies = films.select(F.col("film_id").alias("inventory_id"), "film_id")
    rentals = copies.select(F.col("inventory_id").alias("rental_id"), "inventory_id")
    listed = skewed.select((F.col("id") % 100_000).alias("actor_id"), F.col("key").alias("film_id"))
    actors = spark.range(100_000).select(
        F.col("id").alias("actor_id"), F.lit("a").alias("first_name"), F.lit("b").alias("last_name")
    )
    top = film.top_actors_by_rentals(actors, listed, films, copies, rentals, n=3)
    assert is_split(top)
    # Every actor is listed three times and every film rented once.
    assert [tuple(r) for r in top.collect()] == [(i, "a", "b", 3) for i in range(3)]


def test_component_of_many_materials(small_limits, spark, skewed):
    rows = skewed.select(
        F.lit("A").alias("plant_id"), F.col("id").alias("produced_material"), F.col("key").alias("component_material")
    )
    edges = bom.produced_edges(rows, by_plant=False)
    assert is_split(edges)
    assert edges.count() == ROWS


def test_series_and_group_cut_into_ranges(small_limits, skewed):
    valued = skewed.withColumn("v", F.floor(F.col("id") / 600) % 2)
    runs = run_length_encode(valued, ["key"], ["id"], "v")
    assert runs.agg(F.sum("length")).first()[0] == ROWS
    hot = runs.where(F.col("key") == 0)
    # Key 0 has the multiples of 3 and of 5000: each block of 600 ids is one run.
    assert hot.count() == ROWS // 600
    assert hot.agg(F.max("run_no")).first()[0] == ROWS // 600
    exact = skewed.where(F.col("key") == 0).agg(F.percentile("id", [0.1, 0.5, 0.9])).first()[0]
    ranged = percentiles_by(skewed, ["key"], "id", [0.1, 0.5, 0.9], task_values=200)
    assert ranged.where(F.col("key") == 0).first()["percentiles"] == pytest.approx(exact)
    assert ranged.count() == KEYS


def test_explosion_with_one_hot_material(small_limits, frame, spark):
    rows = spark.range(0, 30_000, 1, 8).select(
        F.lit(2024).alias("year"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
        F.when(F.col("id") % 3 == 0, F.lit(5_000)).otherwise(F.col("id") % 100).cast("long").alias("produced_material"),
        F.lit(1).alias("produced_material_production_type"),
        F.when((F.col("id") % 3 != 0) & (F.col("id") % 100 < 50), "FIN").otherwise("PROD").alias(
            "produced_material_release_type"
        ),
        F.lit(1).cast("decimal(38,6)").alias("produced_material_quantity"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 2_000 + 10_000).otherwise(5_000).cast("long").alias("component_material"),
        F.lit(1).alias("component_material_production_type"),
        F.lit("PROD").alias("component_material_release_type"),
        F.lit(2).cast("decimal(38,6)").alias("component_material_quantity"),
        F.lit("A").alias("plant_id"),
    ).select(*BOM.names)
    exploded = bom.bom_explosion_annual(rows)
    # Each of 50 FINs reaches material 5000 and carries all of its components.
    parts = rows.where(F.col("produced_material") == 5_000).select("component_material").distinct().count()
    assert exploded.count() == 50 * parts
    total = exploded.where(F.col("fin_material_id") == 1).agg(F.sum("prod_material_production_quantity")).first()[0]
    assert total == 10_000
