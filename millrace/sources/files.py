"""File readers. Schemas are declared, so no reader scans the data to infer one."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import na_to_null, nan_to_null, quoted
from millrace.sources.schemas import BOM


#: Quotes inside quoted values are doubled.
CSV = {"escape": '"'}


def read_csv_na(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True, stream: bool = False
) -> DataFrame:
    """CSV with a header, quoted newlines and doubled quotes; missing-value texts become NULL.

    Columns are found by name and those outside ``schema`` pass through as text (a
    stream takes exactly the columns of ``schema``, in its order). Every column is
    read as text, cleared of missing-value texts and then cast, so a text that is
    not a number fails instead of turning into NULL. Files with quoted newlines
    cannot be split by this reader: ``ranges.read_csv_ranges`` reads large ones. Pass ``multi_line=False``
    for large files known to have none.
    """
    options = {"header": True, "multiLine": multi_line, **CSV}
    if stream:
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    else:
        texts = csv_columns(spark, path, multi_line)
        if not texts.fields:  # a zero-byte file has no header
            return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    # Every file's header is compared with the first one's: a file of another column order fails.
    reader = spark.readStream if stream else spark.read
    return cleared(reader.schema(texts).options(**options, enforceSchema=False).csv(path), schema)


def csv_columns(spark: SparkSession, path: str, multi_line: bool = True) -> T.StructType:
    """The columns of CSV files by their first header, all as text; none for a zero-byte file."""
    return spark.read.options(header=True, multiLine=multi_line, **CSV).csv(path).schema


def cleared(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cleared of missing-value texts, those of ``schema`` first and cast."""
    others = [c for c in raw.columns if c not in schema.names]
    return raw.select(
        *[na_to_null(quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields],
        *[na_to_null(quoted(c)).alias(c) for c in others],
    )


def first_file(spark: SparkSession, folder: str, pattern: str = "*.csv") -> str | None:
    """Path of the first file by name in ``folder`` itself, None when there is none.

    Only the listing is used; no file is opened.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return listed.agg(F.min("path")).first()[0]


def first_drop(spark: SparkSession, folder: str) -> str | None:
    """Path, or pattern of paths, of the first drop by name in ``folder`` itself, None when there is none.

    A drop is one file ``name.csv``, or all files ``name.part-*.csv``: a large one can so be written and
    read by many tasks. Only the listing is used; no file is opened.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    drop = F.regexp_replace("path", r"\.part-[^/]*\.csv$", ".part-")
    name = F.regexp_replace(drop, r"(\.part-|\.csv)$", "")
    first = listed.agg(F.min(F.struct(name.alias("name"), drop.alias("drop")))["drop"]).first()[0]
    if first is None or not first.endswith(".part-"):
        return first
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", first) + "*.csv"


def has_rows(df: DataFrame) -> bool:
    """Is there at least one row? A zero-byte and a header-only file have none."""
    return not df.isEmpty()


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType, array: bool = True, position: str | None = None
) -> DataFrame:
    """Records of a JSON array (or of JSON lines, with ``array=False``).

    Invalid JSON fails the read and keys outside the schema are ignored.
    ``position`` names a column that orders the records as they stand in a file.
    """
    df = spark.read.schema(schema).option("multiLine", array).option("mode", "FAILFAST").json(path)
    if position is None:
        return df
    return df.withColumn(
        position,
        F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row")),
    )


def missing_keys(spark: SparkSession, path: str, columns: list[str], array: bool = True) -> DataFrame:
    """Records lacking a key, per column: ``column, records``. A key holding null is present.

    A declared schema reads an absent key and a null alike. Read as variants an
    absent key is NULL and a null is not, and each record is a row of its own,
    however large the file. Invalid JSON fails.
    """
    asked = T.StructType([T.StructField(c, T.VariantType()) for c in columns])
    records = spark.read.schema(asked).option("multiLine", array).option("mode", "FAILFAST").json(path)
    absent = [
        F.struct(F.lit(c).alias("column"), F.count_if(quoted(c).isNull()).alias("records")) for c in columns
    ]
    return records.agg(F.array(*absent).alias("s")).select(F.inline("s")).where(F.col("records") > 0)


def require_keys(spark: SparkSession, path: str, columns: list[str], array: bool = True) -> None:
    """Fail when a record lacks one of ``columns``."""
    absent = {r["column"]: r["records"] for r in missing_keys(spark, path, columns, array).collect()}
    if absent:
        raise ValueError(f"records without a required key: {absent}")


def read_number_list(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Numbers of delimited text lines as ``line, idx, value``; blanks around them are allowed."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    numbered = lines.select(F.monotonically_increasing_id().alias("line"), F.split("value", sep).alias("items"))
    return numbered.select("line", F.posexplode("items").alias("idx", "item")).select(
        "line", "idx", F.trim("item").cast("double").alias("value")
    )


def read_bom(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Bill-of-materials rows from Parquet or CSV, with NaN as NULL."""
    if fmt == "csv":
        return read_csv_na(spark, path, BOM)
    stored = nan_to_null(spark.read.format(fmt).load(path))
    return stored.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in BOM.fields])
