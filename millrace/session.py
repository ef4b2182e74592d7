"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the next step could have reused the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Broadcasts are judged by size; stored tables are larger in memory than on disk.
    "spark.sql.sources.fileCompressionFactor": "3.0",
}


def build_session(app: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the jobs rely on; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shuffle_partitions(input_bytes: int, partition_bytes: int = 256 << 20, at_least: int = 8) -> str:
    """Setting for ``spark.sql.shuffle.partitions`` that fits the input.

    Adaptive execution merges small partitions but never adds any, so the number
    to start from must suit the largest shuffle.
    """
    return str(max(at_least, -(-input_bytes // partition_bytes)))


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    A session without one may fall back to a folder under its warehouse if all of
    it runs in this process; elsewhere the setting is demanded, as a folder of one
    machine would be lost with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder, below one folder per application."""
    application = spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/millrace/{application}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared scratch area and return a scan of it.

    The scan has no lineage behind it, survives lost executors, can be pruned by
    column, and its file sizes let Spark decide on broadcasts by real size. Being
    a scan, it is shuffled afresh for a join, which lets the adaptive skew join
    split a hot key of the other side; an aggregate by the join key would not be.
    """
    return _write_scratch(df)


def materialise_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """As ``materialise``, with the row count observed during the write."""
    seen = Observation()
    stored = _write_scratch(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return stored, seen.get["rows"]


def discard(*stored: DataFrame) -> None:
    """Remove tables of ``materialise`` that nothing reads any more."""
    for df in stored:
        path = getattr(df, "_scratch_path", None)
        if path:
            discard_path(df.sparkSession, path)


def discard_path(spark: SparkSession, path: str) -> None:
    """Remove a folder below ``scratch_root`` that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of the queries run inside as soon as each has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _write_scratch(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark)
    with shuffles_removed(spark):
        df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._scratch_path = path
    return stored
