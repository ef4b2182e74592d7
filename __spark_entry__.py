"""

``queries()`` gives each operator the whole tables under the column names it
works on; ``oracle_sql()`` states the same result in SQL over those tables.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from py4j.protocol import Py4JJavaError  # noqa: E402
from pyspark.errors import PySparkException  # noqa: E402
from pyspark.sql import Column, DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from millrace.functions.text import fill_text_nulls, strip_symbols  # noqa: E402
from millrace.operators import arrays, bins, describe, groups, keyed, ordered, tally  # noqa: E402
from millrace.operators.chains import reachable_over_chains  # noqa: E402
from millrace.operators.closure import reachable  # noqa: E402
from millrace.plans import bom as bom_plan  # noqa: E402
from millrace.plans import calories, census, film, reviews, rooms  # noqa: E402
from millrace.session import materialise, scratch_path  # noqa: E402
from millrace.sinks import exports, tables  # noqa: E402
from millrace.sinks.constraints import check_constraints  # noqa: E402
from millrace.sinks.published import publish, read_published  # noqa: E402
from millrace.sources.files import (  # noqa: E402
    has_rows,
    missing_keys,
    read_bom,
    read_csv_na,
    read_json_records,
    read_number_list,
)
from millrace.sources.ranges import read_csv_ranges  # noqa: E402
from millrace.sources.schemas import REVIEWS  # noqa: E402
from millrace.streaming.pickup import publish_new_files  # noqa: E402
from oracle_statements import STATEMENTS  # noqa: E402

FLAGSHIP_DIR = "/root/testdata/sf0.001"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round sums of doubles, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


# --- the star schema: parts are films of one copy each, lines their rentals, -----
# --- brands or types the categories, suppliers the actors ------------------------


def film_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    part, lineitem = table(spark, sf, "part"), table(spark, sf, "lineitem")
    customer = table(spark, sf, "customer")
    brand = F.substring("p_brand", 7, 10).cast("int")
    return {
        "film": part.select(F.col("p_partkey").alias("film_id"), F.col("p_name").alias("title")),
        "category": part.select(brand.alias("category_id"), F.col("p_brand").alias("name")).distinct(),
        "film_category": part.select(F.col("p_partkey").alias("film_id"), brand.alias("category_id")),
        "type": part.select(F.col("p_type").alias("category_id"), F.col("p_type").alias("name")).distinct(),
        "film_type": part.select(F.col("p_partkey").alias("film_id"), F.col("p_type").alias("category_id")),
        "actor": table(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("actor_id"),
            F.col("s_name").alias("first_name"),
            F.concat(F.lit("of nation "), F.col("s_nationkey").cast("string")).alias("last_name"),
        ),
        "film_actor": lineitem.select(
            F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id")
        ).distinct(),
        "inventory": part.select(F.col("p_partkey").alias("inventory_id"), F.col("p_partkey").alias("film_id")),
        "rental": lineitem.select(
            F.col("l_orderkey").alias("rental_id"), F.col("l_partkey").alias("inventory_id")
        ),
        "dated_rental": lineitem.join(
            table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
        ).select(
            F.col("l_orderkey").alias("rental_id"),
            F.col("l_partkey").alias("inventory_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("rental_date"),
            F.col("l_shipdate").alias("return_date"),
        ),
        "payment": table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("payment_id"),
            F.col("o_orderkey").alias("rental_id"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        ),
        "customer": customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("address_id"),
            (F.col("c_acctbal") >= 0).cast("int").alias("active"),
        ),
        "address": customer.select(F.col("c_custkey").alias("address_id"), F.col("c_nationkey").alias("city_id")),
        "city": table(spark, sf, "nation").select(
            F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city")
        ),
    }


def parts_per_type(spark: SparkSession, sf: str) -> DataFrame:
    t = film_tables(spark, sf)
    return film.films_per_category(t["film"], t["film_type"], t["type"])


def top10_suppliers_by_lines(spark: SparkSession, sf: str) -> DataFrame:
    t = film_tables(spark, sf)
    return film.top_actors_by_rentals(t["actor"], t["film_actor"], t["film"], t["inventory"], t["rental"])


def spend_per_brand(spark: SparkSession, sf: str) -> DataFrame:
    t = film_tables(spark, sf)
    spend = film.category_spend(t["category"], t["film_category"], t["inventory"], t["rental"], t["payment"])
    return as_double(spend, "spent_money")


def top_type_by_revenue(spark: SparkSession, sf: str) -> DataFrame:
    t = film_tables(spark, sf)
    best = film.top_category_by_spend(t["type"], t["film_type"], t["inventory"], t["rental"], t["payment"])
    return as_double(best, "spent_money")


def orders_without_lines(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("film_id"), F.col("o_orderkey").cast("string").alias("title")
    )
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("film_id"))
    return film.films_without_inventory(orders, lines)


def top3_counts_suppliers_promo(spark: SparkSession, sf: str) -> DataFrame:
    t = film_tables(spark, sf)
    return film.top_actors_in_category(
        t["actor"], t["film_actor"], t["film"], t["film_type"], t["type"], name="PROMO"
    )


def customers_by_nation_balance(spark: SparkSession, sf: str) -> DataFrame:
    t = film_tables(spark, sf)
    return film.customers_by_city(t["customer"], t["address"], t["city"])


def top_brand_by_ship_hours(spark: SparkSession, sf: str) -> DataFrame:
    t = film_tables(spark, sf)
    best = film.top_category_by_hours(
        t["category"], t["film_category"], t["film"], t["inventory"], t["dated_rental"],
        t["customer"], t["address"], t["city"],
        title_pattern="S%", city_pattern="%1%", tags=("part starts with s", "nation contains 1"),
    )
    return rounded(best, "rental_hours", digits=3)


# --- rooms and students: orders or customers housing lines or orders ----------


def lines_per_order(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name")
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("id"), F.col("l_orderkey").alias("room")
    )
    return rooms.students_per_room(orders, lines)


def customer_rooms(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return (
        table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("room"), F.col("o_orderdate").alias("birthday")
        ),
    )


def lowest_avg_order_age(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit("2002-01-01").cast("timestamp_ntz")
    return as_double(rooms.lowest_avg_age_rooms(*customer_rooms(spark, sf), as_of=as_of), "avg_age_years")


def largest_order_span(spark: SparkSession, sf: str) -> DataFrame:
    return rooms.largest_age_gap_rooms(*customer_rooms(spark, sf))


def orders_mixed_flags(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name")
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("room"), F.col("l_returnflag").alias("sex")
    )
    return rooms.mixed_sex_rooms(orders, lines)


# --- reviews: documents, conversations and events ------------------------------

MARKS = " \U0001f600 é ✔ № ½ a b"


def document_reviews(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    day = F.lpad((F.col("n_chars") % 28 + 1).cast("string"), 2, "0")
    return documents.join(labels, "doc_id", "left").select(
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("reviewId"),
        F.col("source").alias("userName"),
        F.col("text").alias("content"),
        (F.col("quality") * 4 + 1).cast("int").alias("score"),
        (F.col("n_chars") % 7).cast("int").alias("thumbsUpCount"),
        F.concat(F.lit("2024-01-"), day, F.lit(" 00:00:00")).alias("at"),
    )


def fill_event_types(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("event_type") != "click", F.col("value")).alias("value"),
    )
    return fill_text_nulls(events)


def sort_by_time(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    at = (
        F.when(kind == "error", F.lit("no time"))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return reviews.sort_by_time(table(spark, sf, "events").select("event_id", at.alias("at")), tie_break="event_id")


def strip_document_symbols(spark: SparkSession, sf: str) -> DataFrame:
    marked = F.concat("text", F.lit(MARKS))
    return table(spark, sf, "documents").select("doc_id", strip_symbols(marked).alias("text"))


def clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.clean_reviews(dirty_reviews(spark, sf))


def dirty_reviews(spark: SparkSession, sf: str) -> DataFrame:
    raw = document_reviews(spark, sf)
    # Symbols to strip, texts that empty or turn missing when stripped, and missing ones.
    content = (
        F.when(F.col("score") == 5, F.concat("content", F.lit(MARKS)))
        .when(F.col("thumbsUpCount") == 3, F.lit("NA\U0001f600"))
        .when(F.col("thumbsUpCount") == 4, F.lit(None).cast("string"))
        .otherwise(F.col("content"))
    )
    at = F.when(F.col("thumbsUpCount") != 5, F.col("at"))
    return raw.withColumns({"content": content, "at": at})


def top_documents_text(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.top_comments(document_reviews(spark, sf))


def conversation_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("reviewId"),
        F.col("role").alias("userName"),
        F.col("text").alias("content"),
        F.col("turn").alias("score"),
        F.lit("-").alias("at"),
    )


def short_text(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.short_content(conversation_reviews(spark, sf), n=40)


def short_text_count(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.count_short_content(conversation_reviews(spark, sf), n=40)


def avg_value_per_day(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("at"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("score"),
    )
    return reviews.avg_score_per_day(events)


# --- bill of materials: each line makes its part out of a lower-numbered one ---


def bom_rows(spark: SparkSession, sf: str) -> DataFrame:
    attributes = table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_size") == 50, "FIN").otherwise("PROD").alias("release"),
        F.when(F.col("p_type") != "PROMO", F.length("p_type")).alias("production"),
    )
    produced = attributes.select(
        F.col("p_partkey").alias("produced_material"),
        F.col("release").alias("produced_material_release_type"),
        F.col("production").alias("produced_material_production_type"),
    )
    component = attributes.select(
        F.col("p_partkey").alias("component_material"),
        F.col("release").alias("component_material_release_type"),
        F.col("production").alias("component_material_production_type"),
    )
    lines = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.col("l_partkey").alias("produced_material"),
        F.col("l_quantity").cast("decimal(8,2)").alias("produced_material_quantity"),
        F.floor(F.col("l_partkey") / (F.col("l_linenumber") + 1)).cast("long").alias("component_material"),
        (F.col("l_quantity") * F.col("l_linenumber")).cast("decimal(8,2)").alias("component_material_quantity"),
        F.col("l_linestatus").alias("plant_id"),
    )
    # Not broadcast: parts grow with the lines, and a driver would hold them twice.
    return lines.join(produced.hint("merge"), "produced_material").join(component.hint("merge"), "component_material")


QUANTITIES = ("fin_production_quantity", "prod_material_production_quantity", "component_consumption_quantity")


def bom_explosion_annual(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(bom_plan.bom_explosion_annual(bom_rows(spark, sf)), *QUANTITIES)


def bom_explosion_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(bom_plan.bom_explosion_monthly(bom_rows(spark, sf)), *QUANTITIES)


def reachable_materials(spark: SparkSession, sf: str) -> DataFrame:
    rows = materialise(
        bom_rows(spark, sf)
        .select("plant_id", "produced_material", "produced_material_release_type", "component_material")
        .distinct()
    )
    produced = materialise(bom_plan.produced_materials(rows))
    fins = rows.where(F.col("produced_material_release_type") == "FIN")
    edges = bom_plan.produced_edges(rows, by_plant=True, produced=produced)
    seeds = bom_plan.produced_edges(fins, by_plant=True, produced=produced)
    return reachable(edges, seeds.withColumnsRenamed({"src": "root", "dst": "node"}), ["plant_id"])


def reachable_over_successors(spark: SparkSession, sf: str) -> DataFrame:
    """Parts that succeed each brand's first part, in one ring of all parts by key."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    follows = part.select(F.col("p_partkey").alias("src"), (F.col("p_partkey") + 1).alias("dst"))
    follows = follows.join(part.select(F.col("p_partkey").alias("dst")), "dst", "left_semi").select("src", "dst")
    closing = part.agg(F.max("p_partkey").alias("src"), F.min("p_partkey").alias("dst"))
    seeds = part.groupBy(F.col("p_brand").alias("root")).agg(F.min("p_partkey").alias("node"))
    return reachable_over_chains(follows.union(closing), seeds)


def produced_materials(spark: SparkSession, sf: str) -> DataFrame:
    return bom_plan.produced_materials(bom_rows(spark, sf))


def fin_materials(spark: SparkSession, sf: str) -> DataFrame:
    return bom_plan.fin_materials(bom_rows(spark, sf))


def produced_edges(spark: SparkSession, sf: str) -> DataFrame:
    return bom_plan.produced_edges(bom_rows(spark, sf), by_plant=False)


def fin_quantity(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(bom_plan.fin_quantity(bom_rows(spark, sf)), "fin_production_quantity")


def fin_attr(spark: SparkSession, sf: str) -> DataFrame:
    return bom_plan.fin_attr(bom_rows(spark, sf))


def fin_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return as_double(bom_plan.fin_attributes(bom_rows(spark, sf)), "fin_production_quantity")


# --- census-style profiles -------------------------------------------------------


def flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tally.value_counts(table(spark, sf, "lineitem"), "l_returnflag")


def mean_qty_returned(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return rounded(census.mean_where(lines, F.col("l_returnflag") == "R", "l_quantity", "mean_qty"), "mean_qty")


def share_building(spark: SparkSession, sf: str) -> DataFrame:
    segments = table(spark, sf, "customer").select(F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment"))
    return rounded(census.share_of(segments, "segment", "BUILDING"), "share", digits=9)


def mean_std_by_event(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(census.mean_and_std(table(spark, sf, "events"), "event_type", "value"), "mean", "std")


LARGE, LARGE_TYPES = 40, ("PROMO", "STANDARD", "SMALL")


def all_large_parts_in_types(spark: SparkSession, sf: str) -> DataFrame:
    return census.all_in(table(spark, sf, "part"), F.col("p_size") > LARGE, "p_type", LARGE_TYPES)


def large_part_exceptions(spark: SparkSession, sf: str) -> DataFrame:
    return census.exceptions(table(spark, sf, "part"), F.col("p_size") > LARGE, "p_type", LARGE_TYPES)


def describe_price_by_brand_type(spark: SparkSession, sf: str) -> DataFrame:
    described = describe.describe_by(table(spark, sf, "part"), ["p_brand", "p_type"], ["p_size", "p_retailprice"])
    return rounded(described, "mean", "std", "p25", "p50", "p75")


def describe_lines_by_flags(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    described = describe.describe_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], columns)
    return rounded(described, "mean", "std", "p25", "p50", "p75")


def max_price_of_group(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "part").select(
        F.col("p_brand").alias("race"), F.col("p_type").alias("sex"), F.col("p_retailprice").alias("age")
    )
    return census.max_age(people, race="Brand#7", sex="PROMO").withColumnRenamed("max_age", "max_price")


def share_by_prefix(spark: SparkSession, sf: str) -> DataFrame:
    shares = census.share_by_prefix(
        table(spark, sf, "orders"), "o_orderpriority", "1-", F.col("o_orderstatus") == "F"
    )
    return rounded(shares, "share", digits=9)


def max_qty_share(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return rounded(census.share_at_maximum(lines, "l_quantity", F.col("l_returnflag") == "R"), "percent")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def avg_balance_pivot(spark: SparkSession, sf: str) -> DataFrame:
    pivoted = census.mean_pivot(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment", SEGMENTS, "c_acctbal")
    return rounded(pivoted, *SEGMENTS)


SIZE_EDGES, SIZE_LABELS = [0, 15, 35, 49], ["small", "medium", "large"]


def sized_parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", bins.label_bins(F.col("p_size"), SIZE_EDGES, SIZE_LABELS).alias("size_group")
    )


def bin_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bins.bin_counts(sized_parts(spark, sf), "size_group", SIZE_LABELS)


def top_bin(spark: SparkSession, sf: str) -> DataFrame:
    return bins.top_bin(bin_counts(spark, sf))


def group_describe(spark: SparkSession, sf: str) -> DataFrame:
    return groups.describe_groups(table(spark, sf, "customer"), "c_nationkey")


def group_filter(spark: SparkSession, sf: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return groups.keep_groups(
        table(spark, sf, "customer"),
        "c_nationkey",
        {"modest": F.avg(balance) <= 4500, "solvent": F.bool_and(tally.is_true(balance > -980))},
    )


# --- vectors, matrices, statistics ------------------------------------------------


def negate_between(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", arrays.negate_between(F.col("value"), 3, 8).alias("value"))


def zero_max(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return arrays.zero_max(lines, "l_quantity")


def direct_product(spark: SparkSession, sf: str) -> DataFrame:
    lists = table(spark, sf, "part").select(
        "p_partkey",
        F.split("p_name", " ").alias("words"),
        F.array("p_brand", "p_type").alias("kinds"),
        F.array(F.col("p_size"), F.col("p_size") * 2).alias("sizes"),
    )
    return arrays.direct_product(lists, ["words", "kinds", "sizes"], ["word", "kind", "size"])


def line_vectors(spark: SparkSession, sf: str) -> DataFrame:
    def percent(name: str) -> Column:
        return F.round(F.col(name) * 100).cast("int")

    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.array("l_linenumber", percent("l_discount"), percent("l_tax")).alias("v"),
    )


def rows_hitting_all(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("r_regionkey")
    patterns = table(spark, sf, "region").select(F.array(key, key + 1).alias("p"))
    return arrays.rows_hitting_all(line_vectors(spark, sf), "v", patterns, "p").drop("v")


def rows_not_constant(spark: SparkSession, sf: str) -> DataFrame:
    return arrays.rows_not_constant(line_vectors(spark, sf), "v", floating=False).drop("v")


def unique_flags(spark: SparkSession, sf: str) -> DataFrame:
    return arrays.unique_rows(
        table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    )


def diagonal_product(spark: SparkSession, sf: str) -> DataFrame:
    entries = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").alias("i"),
        (F.round(F.col("l_tax") * 100) + 1).cast("int").alias("j"),
        F.col("l_quantity").alias("value"),
    )
    return arrays.diagonal_product(entries, ["l_orderkey"])


def same_multiset(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    ordered_keys = orders.select(F.col("o_orderkey").alias("k"))
    line_keys = lines.select(F.col("l_orderkey").alias("k"))
    known = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderkey").alias("k"))
    return arrays.same_multiset(ordered_keys, line_keys, "k").withColumn("pair", F.lit("orders, lines")).unionByName(
        arrays.same_multiset(known, line_keys, "k").withColumn("pair", F.lit("joined lines, lines"))
    )


def event_series(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "user_id", "ts", "event_id", "event_type", F.floor("value").cast("int").alias("level")
    )


def max_after_level(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.max_after(event_series(spark, sf), ["user_id"], ["ts", "event_id"], "level", marker=5)


def event_runs(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.run_length_encode(event_series(spark, sf), ["user_id"], ["ts", "event_id"], "event_type")


def pairwise_distance(spark: SparkSession, sf: str) -> DataFrame:
    vector = F.col("embedding")
    matrices = table(spark, sf, "embeddings").select(
        "vec_id",
        arrays.as_matrix(vector, rows=4, width=8).alias("x"),
        arrays.as_matrix(vector, rows=4, width=8, start=32).alias("y"),
    )
    return rounded(arrays.pairwise_distance(matrices, "x", "y"), "d")


def mean_gap(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(calories.mean_gap(table(spark, sf, "lineitem"), "l_extendedprice", 60), "mean", "gap", digits=4)


def sorted_values(spark: SparkSession, sf: str) -> DataFrame:
    return calories.sorted_values(table(spark, sf, "part"), "p_retailprice", ["p_partkey"])


def median_price(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(calories.median(table(spark, sf, "lineitem"), "l_extendedprice"), "median")


def lowest_percentile_above(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        calories.lowest_percentile_above(table(spark, sf, "lineitem"), "l_extendedprice", 25000), "value"
    )


def share_above(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(calories.share_above(table(spark, sf, "lineitem"), "l_extendedprice", 25000), "share_above")


def std_price(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(calories.population_std(table(spark, sf, "part"), "p_retailprice"), "std")


# --- loads ----------------------------------------------------------------------


def customer_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Per order a changed balance of its customer, and every supplier as a new customer."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderpriority").alias("c_name"),
        F.lit(None).cast("int").alias("c_nationkey"),
        F.col("o_totalprice").alias("c_acctbal"),
        F.col("o_orderstatus").alias("c_mktsegment"),
        F.col("o_orderdate").alias("changed"),
        F.col("o_orderkey").alias("change_id"),
    )
    suppliers = table(spark, sf, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
        F.lit("2000-01-01").cast("timestamp_ntz").alias("changed"),
        F.col("s_suppkey").alias("change_id"),
    )
    return orders.unionByName(suppliers)


def upsert_customers(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.upsert(
        table(spark, sf, "customer"), customer_changes(spark, sf), ["c_custkey"], ["changed", "change_id"]
    )


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    changes = customer_changes(spark, sf)
    moved = changes.withColumn("c_custkey", F.col("c_custkey") + F.when(F.col("change_id") % 4 == 0, 10**9).otherwise(0))
    return keyed.insert_if_absent(table(spark, sf, "customer"), moved, ["c_custkey"], ["changed", "change_id"])


def constraint_violations(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    large = table(spark, sf, "part").where(F.col("p_size") > 2)
    return check_constraints(
        lines.withColumn("l_returnflag", F.concat("l_returnflag", "l_linestatus")),
        keys=["l_orderkey", "l_linenumber"],
        lengths={"l_returnflag": 1},
        references={"l_orderkey": (table(spark, sf, "orders"), "o_orderkey"), "l_partkey": (large, "p_partkey")},
    )


PROFILED = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def profile(spark: SparkSession, sf: str) -> DataFrame:
    described = describe.profile(table(spark, sf, "part"), PROFILED)
    numbers = {c: F.round(F.col(c).cast("double"), 6) for c in ("p_partkey", "p_size", "p_retailprice")}
    return described.withColumns(numbers)


# --- sources and sinks: tables written to the shared folder and read back ---------


def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as JSON lines and back; the export writes times as text."""
    path = scratch_path(spark)
    orders = table(spark, sf, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("1-URGENT")))
    exports.export_json(orders, path)
    return read_json_records(spark, path, orders.schema, array=False)


def json_missing_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays of customers, one file per task, that lack the balance where it is negative."""
    path = scratch_path(spark)
    customers = table(spark, sf, "customer").withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    batches = customers.groupBy(F.floor(F.col("c_custkey") / 500).alias("file")).agg(
        F.to_json(F.collect_list(F.struct(*customers.columns))).alias("value")
    )
    batches.repartition(F.col("file")).select("file", "value").write.partitionBy("file").text(path)
    return missing_keys(spark, path, customers.columns)


def xml_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark)
    suppliers = table(spark, sf, "supplier").withColumn("s_acctbal", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")))
    exports.export_xml(suppliers, path)
    reader = spark.read.format("xml").schema(suppliers.schema).option("rowTag", "record").option("nullValue", "")
    return reader.load(path)


def json_document(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as one JSON array in parts, and its records read back; the lines that open and close it stand apart."""
    path = scratch_path(spark)
    orders = table(spark, sf, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("1-URGENT")))
    exports.export_json_document(orders, path, ["o_orderdate", "o_orderkey"])
    lines = spark.read.text(path).where("value NOT IN ('[', ']')")
    record = F.from_json(F.ltrim("value", F.lit(",")), orders.schema, {"mode": "FAILFAST"})
    return lines.select(record.alias("record")).select("record.*")


def xml_document(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as one XML document in parts, and its records read back."""
    path = scratch_path(spark)
    customers = table(spark, sf, "customer").withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    exports.export_xml_document(customers, path, ["c_nationkey", "c_custkey"])
    reader = spark.read.format("xml").schema(customers.schema).option("rowTag", "record").option("nullValue", "")
    return reader.load(path)


EVENT_TYPES = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())])


def csv_with_missing_values(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark)
    events = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "view", F.concat(F.lit('say "'), "event_type", F.lit('"\nnow'))).otherwise(
            F.when(F.col("event_type") == "click", F.lit("n/a")).otherwise(F.col("event_type"))
        ).alias("event_type"),
        F.when(F.col("event_type") == "error", F.lit("NaN")).otherwise(F.col("value").cast("string")).alias("value"),
    )
    events.write.option("header", True).option("escape", '"').csv(path)
    return read_csv_na(spark, path, EVENT_TYPES)


NOTES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("note", T.StringType())])


def csv_in_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as CSV values that hold quotes and line feeds, read back in ranges of files."""
    path = scratch_path(spark)
    note = F.concat("text", F.lit('\nfrom "'), "source", F.lit('",\n\nin '), F.coalesce("lang", F.lit("no language")))
    documents = table(spark, sf, "documents").select("doc_id", note.alias("note"), F.col("lang").alias("spoken"))
    whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    documents.write.options(header=True, escape='"', **whole).csv(path)
    return read_csv_ranges(spark, path, NOTES)


def number_lists(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark)
    table(spark, sf, "part").select(F.concat_ws(" , ", "p_partkey", "p_size", "p_retailprice").alias("value")).write.text(path)
    numbers = read_number_list(spark, path)
    return numbers.groupBy("idx").agg(
        F.countDistinct("line").alias("lines"), F.round(F.sum("value"), 2).alias("total"), F.max("value").alias("greatest")
    )


def bom_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark)
    bom_rows(spark, sf).write.option("header", True).csv(path)
    return as_double(bom_plan.fin_quantity(read_bom(spark, path, "csv")), "fin_production_quantity")


def drop_files(df: DataFrame, folder: str, name: str) -> None:
    """``df`` as CSV files ``name.part-*.csv`` in ``folder``, one per task, each renamed into place."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession)
    df.write.option("header", True).option("escape", '"').option("nullValue", "").csv(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(folder))
    for i, written in enumerate(files.globStatus(hadoop.Path(f"{path}/part-*"))):
        files.rename(written.getPath(), hadoop.Path(f"{folder}/{name}.part-{i:05d}.csv"))


def picked_up_files(spark: SparkSession, sf: str) -> DataFrame:
    """Drops of many files each, picked up in three runs, the last without new files, and published batch by batch."""
    folder, out, log = (scratch_path(spark) for _ in range(3))
    raw = dirty_reviews(spark, sf).select(*REVIEWS.names)
    for name, scored in (("b", F.col("score").isNull()), ("a", F.col("score").isNotNull()), ("", None)):
        if scored is not None:
            drop_files(raw.where(scored), folder, name)
        publish_new_files(spark, folder, out, log).awaitTermination()
    return read_published(spark, out)


def processed_folder(spark: SparkSession, sf: str) -> DataFrame:
    """The first drop of a folder by name, cleaned and published; a later one is left alone."""
    folder, out = scratch_path(spark), scratch_path(spark)
    drop_files(conversation_reviews(spark, sf).withColumn("thumbsUpCount", F.lit(0)).select(*REVIEWS.names), folder, "b")
    drop_files(dirty_reviews(spark, sf).select(*REVIEWS.names), folder, "a")
    reviews.process_folder(spark, folder, out)
    return read_published(spark, out)


EVENT_KINDS = ("click", "view", "purchase", "signup", "error", "none")


def empty_files(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of CSV files per event type, one type without any, and whether the guard lets them through."""
    events = table(spark, sf, "events").select("event_id", "event_type", F.col("value").cast("string").alias("value"))
    found = []
    for kind in EVENT_KINDS:
        path = scratch_path(spark)
        mine = events.where(F.col("event_type") == kind)
        mine.write.option("header", True).csv(path)
        read = read_csv_na(spark, path, EVENT_TYPES)
        found.append(read.agg(F.lit(kind).alias("event_type"), F.count("*").alias("rows")).withColumn("passes", F.lit(has_rows(read))))
    return reduce(DataFrame.unionByName, found)


def published_merges(spark: SparkSession, sf: str) -> DataFrame:
    """Customers published, merged with their changes, and completed by suppliers' keys."""
    path = scratch_path(spark)
    customers, changes = table(spark, sf, "customer"), customer_changes(spark, sf)
    publish(customers, path)
    changed = tables.upsert_published(
        spark, path, changes.where(F.col("c_custkey") >= 0), ["c_custkey"], ["changed", "change_id"]
    )
    added = tables.insert_absent_published(spark, path, changes, ["c_custkey"], ["changed", "change_id"])
    return read_published(spark, path).withColumns(
        {"changed": F.lit(changed).cast("long"), "added": F.lit(added).cast("long")}
    )


def keyed_merges(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in parts by key, merged with their changes and completed; how many keys and parts that took."""
    path, customers = scratch_path(spark), table(spark, sf, "customer")
    keyed_table = tables.KeyedTable(spark, path, customers.schema, ["c_custkey"], parts=16)
    keyed_table.load(customers)
    changes, order = customer_changes(spark, sf), ["changed", "change_id"]
    changed = keyed_table.upsert(changes.where(F.col("c_custkey") >= 0), order)
    added = keyed_table.insert_if_absent(changes, order)
    return keyed_table.read().withColumns({"changed": F.lit(changed).cast("long"), "added": F.lit(added).cast("long")})


def reloaded_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced twice and appended to, with its load summary, and what is left after it was emptied."""
    name = "loaded_" + scratch_path(spark).rsplit("/", 1)[1]
    part = table(spark, sf, "part").withColumn("p_retailprice", F.when(F.col("p_size") > 2, F.col("p_retailprice")).otherwise(F.lit(float("nan"))))
    tables.replace_table(part.where(F.col("p_size") == 1), name)
    loaded = tables.replace_table(part, name)
    tables.append(table(spark, sf, "part").where(F.col("p_size") > 40), name)
    counted, stored, sample = tables.load_summary(loaded, spark.table(name))
    prices = materialise(spark.table(name).agg(F.count("p_retailprice").alias("prices")))
    shown = sample.count()
    tables.empty_tables(spark, name)
    left = spark.table(name).count()
    spark.sql(f"DROP TABLE {name}")
    numbers = {"loaded": counted, "stored": stored, "shown": shown, "left": left}
    return prices.withColumns({k: F.lit(v).cast("long") for k, v in numbers.items()})


def switched_table(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a table after two loads and a third one that fails half-way."""
    folder = scratch_path(spark)
    name = "switched_" + folder.rsplit("/", 1)[1]
    part = table(spark, sf, "part")
    tables.switch_table(part.where(F.col("p_size") == 1), name, folder)
    tables.switch_table(part, name, folder)
    halfway = F.when(F.col("p_size") > 40, F.raise_error(F.lit("load ended"))).otherwise(F.col("p_name"))
    try:
        tables.switch_table(part.withColumn("p_name", halfway), name, folder)
    except (PySparkException, Py4JJavaError):
        pass
    rows = materialise(spark.table(name))
    spark.sql(f"DROP TABLE {name}")
    return rows


# --- order contracts: position and key of every row ---------------------------------


def numbered(df: DataFrame, *keys: str) -> DataFrame:
    """Keys of ordered rows with their position from 1."""
    shift, mask = 33, (1 << 33) - 1
    at = F.monotonically_increasing_id()
    rows = materialise(df.select(*keys).withColumn("__at", at)).withColumn("__part", F.shiftright("__at", shift))
    sizes = rows.groupBy("__part").agg(F.count("*").alias("n"))
    before = sizes.select("__part", (F.sum("n").over(Window.orderBy("__part")) - F.col("n")).alias("__before"))
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit(mask)) + 1
    return rows.join(materialise(before), "__part").select(place.alias("position"), *keys)


ORDERED = {
    "parts_per_type": ["category_id"],
    "top10_suppliers_by_lines": ["actor_id"],
    "top3_counts_suppliers_promo": ["actor_id"],
    "customers_by_nation_balance": ["city_id"],
    "sort_by_time": ["event_id"],
    "avg_value_per_day": ["day"],
    "unique_flags": None,
    "sorted_values": None,
    "bom_explosion_annual": ["plant", "fin_material_id", "prod_material_id", "component_id", "year"],
}


def order_of(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def positions(spark: SparkSession, sf: str) -> DataFrame:
        df = globals()[name](spark, sf)
        return numbered(df, *(ORDERED[name] or df.columns))

    positions.__name__ = f"order_of_{name}"
    return positions


QUERIES = [
    parts_per_type, top10_suppliers_by_lines, spend_per_brand, top_type_by_revenue, orders_without_lines,
    top3_counts_suppliers_promo, customers_by_nation_balance, top_brand_by_ship_hours,
    lines_per_order, lowest_avg_order_age, largest_order_span, orders_mixed_flags,
    fill_event_types, sort_by_time, strip_document_symbols, clean_documents, top_documents_text, short_text,
    avg_value_per_day,
    produced_materials, fin_materials, produced_edges, reachable_materials, fin_quantity, fin_attr, fin_attributes,
    bom_explosion_annual, bom_explosion_monthly,
    flag_counts, mean_qty_returned, share_building, mean_std_by_event, all_large_parts_in_types,
    large_part_exceptions, describe_price_by_brand_type, describe_lines_by_flags, max_price_of_group,
    share_by_prefix, max_qty_share, avg_balance_pivot, sized_parts, bin_counts, top_bin, group_describe, group_filter,
    negate_between, zero_max, direct_product, rows_hitting_all, rows_not_constant, unique_flags, diagonal_product,
    same_multiset, max_after_level, event_runs, pairwise_distance,
    mean_gap, sorted_values, median_price, lowest_percentile_above, share_above, std_price,
    upsert_customers, insert_if_absent, constraint_violations, profile,
    json_round_trip, json_missing_keys, xml_round_trip, csv_with_missing_values, csv_in_ranges, number_lists, bom_from_csv,
    picked_up_files, processed_folder, empty_files, published_merges, keyed_merges, reloaded_table, switched_table, short_text_count,
    json_document, xml_document, reachable_over_successors,
    *(order_of(name) for name in ORDERED),
]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the annual bill-of-materials explosion."""
    return bom_explosion_annual(spark, FLAGSHIP_DIR)


def training_data() -> tuple[dict, dict]:
    """Queries and SQL of the optional subpackage; none where it is not installed."""
    try:
        import corpus_pipeline
        from millrace.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "millrace.llm"):
            raise
        return {}, {}
    found = llm.QUERIES | {"pipeline": corpus_pipeline.run}
    statements = llm.ORACLE_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return {name: with_library(query) for name, query in found.items()}, statements


def with_library(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``query`` for a session whose Python workers shall find this library too."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", os.path.dirname(os.path.abspath(__file__)))
        return query(spark, sf)

    return run


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core_queries() | training_data()[0]


def oracle_sql() -> dict[str, str]:
    return STATEMENTS | training_data()[1]
