"""Pick-up of CSV files dropped into a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.reviews import clean_reviews
from millrace.sinks.published import publish_batch
from millrace.sources.files import has_rows, read_csv_na
from millrace.sources.schemas import REVIEWS


def ingest_new_files(
    spark: SparkSession,
    in_dir: str,
    out: str,
    checkpoint: str,
    schema: T.StructType = REVIEWS,
    multi_line: bool = True,
) -> StreamingQuery:
    """Clean the files added to ``in_dir`` since the last run and append them to ``out``.

    Each file is taken once: the checkpoint remembers it, and the file sink's log
    makes a repeated batch invisible, so a run may be stopped anywhere and started
    again. The folder is not searched below its top level. A file without rows adds
    none. Nothing here needs an order; reports order by time and review id.
    """
    incoming: DataFrame = read_csv_na(spark, f"{in_dir}/*.csv", schema, multi_line, stream=True)
    return (
        clean_reviews(incoming, ordered=False)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def publish_new_files(
    spark: SparkSession,
    in_dir: str,
    out: str,
    checkpoint: str,
    schema: T.StructType = REVIEWS,
    multi_line: bool = True,
    source: str = "files",
) -> StreamingQuery:
    """Clean the files added to ``in_dir`` since the last run and add them to what is published at ``out``.

    Each batch of files is one commit, which carries ``source`` and the batch's number. A run may be
    stopped anywhere: the checkpoint has the files of a batch before the batch is written, so the next
    run repeats it with the same number, and a batch that was committed already is not added again.
    Readers of ``out`` see whole batches only. Files without rows leave it untouched.
    Streams that publish to one place need names of their own, and run one at a time.
    """

    def add(cleaned: DataFrame, batch: int) -> None:
        if has_rows(cleaned):
            publish_batch(cleaned, out, f"{source}/{batch}")

    incoming = read_csv_na(spark, f"{in_dir}/*.csv", schema, multi_line, stream=True)
    return (
        clean_reviews(incoming, ordered=False)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
