"""Large CSV files with quoted newlines, read in ranges by many tasks.

A line alone does not tell whether it begins inside a quoted value. That follows from the number of
quotes before it: each range of a file counts the quotes and the possible record beginnings of its own lines,
a running sum over a file's ranges (one row each) adds what lies before, and then every line
knows its record. A record of one line is parsed as it is; only the lines of longer ones are
brought together, record by record, wherever ranges part them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import materialise
from millrace.sources.files import CSV, cleared, csv_columns


def read_csv_ranges(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As ``read_csv_na``, with the same rows, for files too large for a task each.

    A quote may stand only in a value that is quoted as a whole, doubled inside it: the read fails at a record
    that breaks this rule, and at a quoted value that is never closed, as quotes then do not tell where records end. Lines end
    in a line feed, with or without a carriage return before it. A file of another column order
    fails. The lines are stored once, in ``spark.checkpoint.dir``; a range is as long as
    ``spark.sql.files.maxPartitionBytes`` lets it be.
    """
    texts = csv_columns(spark, path)
    if not texts.fields:
        return cleared(spark.createDataFrame([], T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])), schema)
    records = csv_records(spark, path)
    parsed = F.from_csv("value", ", ".join(f"{_identifier(f.name)} STRING" for f in texts.fields), CSV)
    names = F.struct(*[F.lit(f.name).alias(f.name) for f in texts.fields])
    # Column names are compared as values: a file that begins with others is not read under these.
    is_row = F.when(F.col("record") > 0, F.lit(True)).when(parsed == names, F.lit(False)).otherwise(
        F.raise_error(F.concat(F.lit("header differs in "), "file")).cast("boolean")
    )
    return cleared(records.where(is_row).select(parsed.alias("row")).select("row.*"), schema)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, record, value`` of all records, header included, counted in each file from 0; empty lines are none."""
    lines = materialise(_numbered_lines(spark, path))
    # A file whose first line ends in a carriage return has one at all line ends; they are no part of its values.
    ranges = materialise(_ranges(lines))
    placed = lines.join(ranges, ["file", "range"]).select(
        "file", "range", "line", "odd",
        F.when(F.col("returns"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")).alias("value"),
        F.pmod(F.col("quotes") + F.col("inside"), F.lit(2)).alias("inside"),
        (F.col("records") + F.when(F.col("inside") == 0, F.col("evens")).otherwise(F.col("odds")) - 1).alias("record"),
        "unclosed",
    )
    closed = F.when(F.col("unclosed"), F.raise_error(F.concat(F.lit("a quoted value is never closed in "), "file")).cast("boolean"))
    placed = placed.where(F.coalesce(closed, F.lit(True)))
    alone = (F.col("inside") == 0) & (F.col("odd") == 0)
    in_order = F.array_sort(F.collect_list(F.struct("range", "line", "value")))
    longer = placed.where(~alone).groupBy("file", "record").agg(F.array_join(in_order["value"], "\n").alias("value"))
    records = placed.where(alone & (F.col("value") != "")).select("file", "record", "value").unionByName(longer)
    return records.withColumn("value", _checked(F.col("value")))


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place in a range, whether they hold an odd number of quotes, and running sums.

    ``quotes`` are those of the range's lines before, ``evens`` and ``odds`` count the lines so far that have an even or odd
    number of quotes before them.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("line"), "value", F.pmod(quotes, F.lit(2)).alias("odd"),
    )
    here = Window.partitionBy("file", "range").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = lines.withColumn("quotes", F.sum("odd").over(here) - F.col("odd"))
    odds = F.sum(F.pmod("quotes", F.lit(2))).over(here)
    return before.withColumns({"odds": odds, "evens": F.count(F.lit(1)).over(here) - odds})


def _ranges(lines: DataFrame) -> DataFrame:
    """Per range of a file whether it begins ``inside`` a quoted value and how many ``records`` began before."""
    own = lines.groupBy("file", "range").agg(
        F.sum("odd").alias("own"), F.max("evens").alias("evens"), F.max("odds").alias("odds"),
        F.min_by(F.col("value").endswith("\r"), "line").alias("first"),
    )
    whole = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entered = own.withColumn("inside", F.pmod(F.sum("own").over(whole) - F.col("own"), F.lit(2)))
    began = F.when(F.col("inside") == 0, F.col("evens")).otherwise(F.col("odds"))
    return entered.select(
        "file", "range", "inside", (F.sum(began).over(whole) - began).alias("records"),
        F.first("first").over(every).alias("returns"),
        (F.pmod(F.sum("own").over(every), F.lit(2)) == 1).alias("unclosed"),
    )


def _checked(record: Column) -> Column:
    """The record, or an error if a quote stands in a value that is not quoted as a whole."""
    marks = F.regexp_replace(record, '"[^"]*+"', '"')
    return F.when(~marks.rlike('[^,"]"|"[^,"]'), record).otherwise(
        F.raise_error(F.concat(F.lit("a quote inside an unquoted value: "), F.substring(record, 1, 200))).cast("string")
    )


def _identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
