"""Loads into stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import nan_to_null, quoted
from millrace.operators.keyed import insert_if_absent, latest_per_key
from millrace.operators.matching import without_match
from millrace.session import materialise
from millrace.sinks.published import part_of, publish, publish_parts, read_parts, read_published

# Fixed value: rows sent to a database per batch.
BATCH_ROWS = 1000


def replace_table(df: DataFrame, name: str) -> int:
    """Drop and reload ``name`` with NaN as NULL; returns the rows written."""
    seen = Observation()
    counted = nan_to_null(df).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").saveAsTable(name)
    return seen.get["rows"]


def switch_table(df: DataFrame, name: str, folder: str) -> int:
    """Reload ``name`` with NaN as NULL, all or nothing; returns the rows written.

    The rows go to a new place under ``folder``; once they are complete the catalog is told to look there, so
    readers see the old rows or the new ones and a load that fails changes nothing. The first load makes
    the table. Its columns stay the same; others are refused before anything is written. Earlier places are
    kept for readers that began there; ``places_left`` lists them.
    """
    spark, place = df.sparkSession, f"{folder.rstrip('/')}/load-{uuid.uuid4().hex}"
    known = spark.catalog.tableExists(name)
    if known and (given := df.dtypes) != (held := spark.table(name).dtypes):
        raise ValueError(f"{name} has the columns {held}, not {given}")
    seen = Observation()
    counted = nan_to_null(df).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.parquet(place)
    if known:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=place, source="parquet")
    return seen.get["rows"]


def places_left(spark: SparkSession, name: str, folder: str) -> list[str]:
    """Places under ``folder`` that ``name`` does not read: earlier loads and those that failed."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [str(f.getPath().toString()) for f in files.listStatus(root) if f.getPath().getName().startswith("load-")]
    return sorted(p for p in found if p.rsplit("/", 1)[1] != described.rsplit("/", 1)[1])


def append(df: DataFrame, name: str) -> None:
    """Add rows to ``name``; nothing is compared or removed."""
    df.write.mode("append").saveAsTable(name)


def empty_tables(spark: SparkSession, *names: str) -> None:
    """Empty the tables in the order given: children before parents."""
    for name in names:
        spark.sql(f"TRUNCATE TABLE {name}")


def jdbc_write_options(
    url: str, table: str, column_types: dict[str, str], props: dict[str, str], batch_rows: int = BATCH_ROWS
) -> dict[str, str]:
    """Writer options for a reload: declared column types, batched inserts, the table kept."""
    return {
        **props,
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "truncate": "false",
        "createTableColumnTypes": ", ".join(f"{c} {t}" for c, t in column_types.items()),
    }


def replace_jdbc_table(
    df: DataFrame, url: str, table: str, column_types: dict[str, str], props: dict[str, str]
) -> None:
    """Drop and reload a database table; load a staging table and swap it for all-or-nothing."""
    nan_to_null(df).write.format("jdbc").mode("overwrite").options(
        **jdbc_write_options(url, table, column_types, props)
    ).save()


def upsert_published(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], order: list[str]
) -> int:
    """Merge ``source`` into the published table at ``path``; returns the keys inserted or updated."""
    target = read_published(spark, path)
    latest = latest_per_key(source, keys, order).select(*target.columns)
    seen = Observation()
    applied = latest.observe(seen, F.count(F.lit(1)).alias("rows"))
    publish(without_match(target, source, keys).unionByName(applied), path)
    return seen.get["rows"]


def insert_absent_published(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], order: list[str]
) -> int:
    """Add the first row of each key that the published table lacks; returns their number."""
    target = read_published(spark, path)
    seen = Observation()
    added = insert_if_absent(target, source, keys, order).observe(seen, F.count(F.lit(1)).alias("rows"))
    publish(target.unionByName(added), path)
    return seen.get["rows"]


class KeyedTable:
    """Published table in parts by a hash of its keys; a merge rewrites the parts it touches.

    ``parts`` is fixed when the table is made: as many as make a part a good size for a task.
    """

    def __init__(self, spark: SparkSession, path: str, schema, keys: list[str], parts: int):
        self.spark, self.path, self.schema, self.keys, self.parts = spark, path, schema, keys, parts

    def load(self, df: DataFrame) -> None:
        """Replace all rows."""
        publish_parts(df.select(*self._columns()), self.path, self.keys, self.parts)

    def read(self) -> DataFrame:
        return read_parts(self.spark, self.path, self.schema)

    def upsert(self, source: DataFrame, order: list[str]) -> int:
        """Apply ``source`` in ``order``; returns the keys inserted or updated."""
        latest = materialise(latest_per_key(source, self.keys, order).select(*self._columns()))
        touched = self._touched(latest)
        if touched:
            target = read_parts(self.spark, self.path, self.schema, touched)
            publish_parts(without_match(target, latest, self.keys).unionByName(latest), self.path, self.keys, self.parts, touched)
        return latest.count()

    def insert_if_absent(self, source: DataFrame, order: list[str]) -> int:
        """Add the first row of each key that the table lacks; returns their number."""
        wanted = self._touched(source)
        target = read_parts(self.spark, self.path, self.schema, wanted)
        added = materialise(insert_if_absent(target, source, self.keys, order))
        touched = self._touched(added)
        if touched:
            rows = read_parts(self.spark, self.path, self.schema, touched)
            publish_parts(rows.unionByName(added), self.path, self.keys, self.parts, touched)
        return added.count()

    def _columns(self) -> list:
        return [quoted(name) for name in self.schema.names]

    def _touched(self, rows: DataFrame) -> set[int]:
        # At most one number per part.
        return {r["part"] for r in rows.select(part_of(self.keys, self.parts).alias("part")).distinct().collect()}


def load_summary(loaded: int, stored: DataFrame, sample: int = 5) -> tuple[int, int, DataFrame]:
    """Rows loaded, rows stored, and a few stored rows."""
    return loaded, stored.count(), stored.limit(sample)
