"""Partitioned scans of relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The film-rental tables and the key each is split on.
FILM_TABLES = {
    "actor": "actor_id",
    "address": "address_id",
    "category": "category_id",
    "city": "city_id",
    "country": "country_id",
    "customer": "customer_id",
    "film": "film_id",
    "film_actor": "actor_id",
    "film_category": "category_id",
    "inventory": "inventory_id",
    "language": "language_id",
    "rental": "rental_id",
    "staff": "staff_id",
    "store": "store_id",
    "payment": "payment_id",
}


#: Rows fetched at a time, so that a task does not hold its whole slice.
FETCH_ROWS = 10_000
#: Rows that a task is to read.
TASK_ROWS = 1_000_000


def partitions_for(rows: int, task_rows: int = TASK_ROWS) -> int:
    """Tasks for a table of so many rows."""
    return max(1, -(-rows // task_rows))


def jdbc_options(
    url: str, table: str, partition_col: str, lower: int, upper: int, partitions: int, props: dict[str, str]
) -> dict[str, str]:
    """Reader options for a scan split on ``partition_col``; the bounds set the stride only."""
    return {
        "fetchsize": str(FETCH_ROWS),
        **props,
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_col,
        "lowerBound": str(lower),
        "upperBound": str(max(upper, lower + 1)),
        "numPartitions": str(partitions),
    }


def bounds_query(table: str, partition_col: str) -> str:
    """One-row derived table with the least and greatest key and the number of rows."""
    return f"(SELECT MIN({partition_col}) AS lo, MAX({partition_col}) AS hi, COUNT(*) AS n FROM {table}) AS bounds"


def key_bounds(
    spark: SparkSession, url: str, table: str, partition_col: str, props: dict[str, str]
) -> tuple[int, int, int]:
    """Least and greatest key, so that the stride fits the ids really in use, and the number of rows."""
    row = spark.read.format("jdbc").options(
        **props, url=url, dbtable=bounds_query(table, partition_col)
    ).load().first()
    return int(row[0] or 0), int(row[1] or 0), int(row[2])


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_col: str,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    props: dict[str, str] | None = None,
) -> DataFrame:
    """Table read by ``partitions`` tasks, each scanning one range of ``partition_col``.

    What is not given follows from one query for the bounds and the number of rows.
    """
    props = props or {}
    if lower is None or upper is None or partitions is None:
        low, high, rows = key_bounds(spark, url, table, partition_col, props)
        lower, upper = low if lower is None else lower, high if upper is None else upper
        partitions = partitions or partitions_for(rows)
    return spark.read.format("jdbc").options(
        **jdbc_options(url, table, partition_col, lower, upper, partitions, props)
    ).load()


def read_film_tables(
    spark: SparkSession, url: str, props: dict[str, str], schema: str = "public"
) -> dict[str, DataFrame]:
    """All film-rental tables by name."""
    return {
        name: read_jdbc_table(spark, url, f"{schema}.{name}", key, props=props)
        for name, key in FILM_TABLES.items()
    }
