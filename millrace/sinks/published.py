"""Versioned output: readers see a whole version or the one before, never a part.

Each publication writes a directory of its own and then adds one file to a small
commit table next to it. That file appears when it is renamed into place, so
a version half written, or left behind by a failed job, is never read. A commit replaces what
was there before, or adds to it. The commit of a stream's batch carries the batch's name,
so a batch that is run again is published once.

A keyed table is cut into parts by a hash of its keys. Its commits name a directory per part,
so a merge writes the touched parts only and takes over the others.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import quoted

COMMITS = "seq long, version string, added boolean, batch string"
PART_COMMITS = "seq long, part int, directory string"
PART = "__part"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The table at ``path``, None if there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    return _stored(spark, f"{path}/commits", COMMITS)


def _current(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Number of the last commit and the versions in force: the last whole one and what was added since."""
    commits = _commits(spark, path)
    if commits is None:
        return 0, []
    whole = commits.where(~F.coalesce("added", F.lit(False))).agg(F.coalesce(F.max("seq"), F.lit(0)).alias("at"))
    since = commits.where(F.col("seq") >= whole.scalar()).orderBy("seq", "version").collect()
    return since[-1]["seq"], [r["version"] for r in since]


def _commit(spark: SparkSession, path: str, version: str, added: bool, batch: str | None) -> None:
    seq, _ = _current(spark, path)
    row = spark.range(1).select(
        F.lit(seq + 1).cast("long").alias("seq"), F.lit(version).alias("version"),
        F.lit(added).alias("added"), F.lit(batch).cast("string").alias("batch"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{path}/commits")


def publish(df: DataFrame, path: str) -> str:
    """Write ``df`` as the new version of ``path`` and return the version's directory.

    ``df`` may read the version it replaces. One publisher at a time, as with any
    overwrite. Earlier versions stay until ``superseded`` ones are removed.
    """
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/versions/{version}")
    _commit(df.sparkSession, path, version, False, None)
    return f"{path}/versions/{version}"


def publish_batch(df: DataFrame, path: str, batch: str) -> bool:
    """Add ``df`` to what is published at ``path``, once per ``batch``; tells whether it was added now.

    A job that died before its commit has left a directory that nobody reads, and runs
    again; one that died after it finds the batch's name in the commits.
    """
    spark = df.sparkSession
    commits = _commits(spark, path)
    if commits is not None and not commits.where(F.col("batch") == batch).isEmpty():
        return False
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/versions/{version}")
    _commit(spark, path, version, True, batch)
    return True


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """What is published at ``path`` now."""
    _, versions = _current(spark, path)
    if not versions:
        raise FileNotFoundError(f"nothing published at {path}")
    return spark.read.parquet(*[f"{path}/versions/{v}" for v in versions])


def compact(spark: SparkSession, path: str) -> str:
    """Publish what was added batch by batch as one version; the batches' names stay known."""
    return publish(read_published(spark, path), path)


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """Directories of the versions no longer current, for removal by the storage's own means."""
    _, versions = _current(spark, path)
    return _commits(spark, path).where(~F.col("version").isin(versions)).select(
        F.concat(F.lit(f"{path}/versions/"), "version").alias("directory")
    )


# --- tables in parts by key ---------------------------------------------------------


def part_of(keys: list[str], parts: int) -> Column:
    """Part of a row; equal keys are in one part."""
    return F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(parts)).cast("int")


def part_directories(spark: SparkSession, path: str) -> tuple[int, dict[int, str]]:
    """Number of the last commit of a keyed table and the directory of each of its parts."""
    commits = _stored(spark, f"{path}/commits", PART_COMMITS)
    if commits is None:
        return 0, {}
    last = commits.where(F.col("seq") == commits.agg(F.max("seq").alias("seq")).scalar())
    rows = last.select("seq", "part", "directory").collect()  # a row per part
    return rows[0]["seq"], {r["part"]: r["directory"] for r in rows if r["directory"]}


def publish_parts(df: DataFrame, path: str, keys: list[str], parts: int, touched: set[int] | None = None) -> None:
    """Write ``df``, the rows of the ``touched`` parts (None: of all), and commit them with the other parts' directories."""
    spark = df.sparkSession
    version = f"{path}/versions/{uuid.uuid4().hex}"
    df.withColumn(PART, part_of(keys, parts)).repartition(PART).write.partitionBy(PART).parquet(version)
    seq, before = part_directories(spark, path)
    kept = {p: d for p, d in before.items() if touched is not None and p not in touched}
    written = {r[PART]: f"{version}/{PART}={r[PART]}" for r in _parts_of(spark, version)}
    named = [(seq + 1, p, d) for p, d in (kept | written).items()] or [(seq + 1, None, None)]
    spark.createDataFrame(named, PART_COMMITS).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def _parts_of(spark: SparkSession, version: str) -> list:
    """Parts that a version has a directory for; none if it was written without rows."""
    try:
        return spark.read.parquet(version).select(PART).distinct().collect()
    except AnalysisException as empty:
        if empty.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return []


def read_parts(spark: SparkSession, path: str, schema, wanted: set[int] | None = None) -> DataFrame:
    """Rows of a keyed table, or of the ``wanted`` parts of it."""
    _, directories = part_directories(spark, path)
    mine = [d for p, d in directories.items() if wanted is None or p in wanted]
    return spark.read.schema(schema).parquet(*mine) if mine else spark.createDataFrame([], schema)
