"""Review texts: cleaning and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import (
    PLACEHOLDER,
    comparison_key,
    fill_text_nulls,
    null_na_texts,
    quoted,
    strip_symbols,
)
from millrace.functions.times import TIMESTAMP_FORMATS, TIMESTAMP_TEXT, day_of, parse_first
from millrace.operators.ranking import top_k
from millrace.session import materialise
from millrace.sinks.published import publish
from millrace.sources.files import first_drop, has_rows, read_csv_na
from millrace.sources.schemas import REVIEWS


def rewrite_time(df: DataFrame, column: str = "at", formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> DataFrame:
    """``column`` as uniform timestamp text, the placeholder where it cannot be parsed."""
    text = F.date_format(parse_first(quoted(column), formats), TIMESTAMP_TEXT)
    return df.withColumn(column, F.coalesce(text, F.lit(PLACEHOLDER)))


def sort_by_time(
    df: DataFrame,
    column: str = "at",
    tie_break: str = "reviewId",
    formats: tuple[str, ...] = TIMESTAMP_FORMATS,
) -> DataFrame:
    """Rows by time, unparsable last, with ``column`` rewritten as uniform text.

    The tie-break also lets the range sort split a time shared by many rows.
    """
    keyed = df.withColumn("__time", parse_first(quoted(column), formats))
    return (
        keyed.orderBy(F.col("__time").asc_nulls_last(), quoted(tie_break))
        .withColumn(column, F.coalesce(F.date_format("__time", TIMESTAMP_TEXT), F.lit(PLACEHOLDER)))
        .drop("__time")
    )


def clean_reviews(raw: DataFrame, ordered: bool = True) -> DataFrame:
    """Fill, order by time, strip symbols, and turn emptied texts back into NULL.

    One lazy plan; ``ordered=False`` skips the sort, as on a stream.
    """
    filled = fill_text_nulls(null_na_texts(raw))
    # The range sort reads its input twice, to sample it and to move it: strip afterwards.
    timed = sort_by_time(filled) if ordered else rewrite_time(filled)
    return null_na_texts(timed.withColumn("content", strip_symbols(F.col("content"))), ["content"])


def process_reviews(spark: SparkSession, csv_path: str, out: str) -> bool:
    """Clean a CSV file and publish the result; an empty file leaves ``out`` untouched."""
    raw = read_csv_na(spark, csv_path, REVIEWS)
    if not has_rows(raw):
        return False
    publish(clean_reviews(raw), out)
    return True


def process_folder(spark: SparkSession, folder: str, out: str) -> str | None:
    """Process the first drop of ``folder`` by name, a CSV file or its parts; returns its path, None if there is none or it is empty."""
    path = first_drop(spark, folder)
    return path if path and process_reviews(spark, path, out) else None


def _commented(reviews: DataFrame) -> DataFrame:
    """Reviews with a comment, keyed by its comparison form; tested on the raw text."""
    return reviews.where(F.col("content").isNotNull() & ~F.col("content").isin("", PLACEHOLDER)).withColumn(
        "key", comparison_key(F.col("content"))
    )


def top_comments(reviews: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent comments, in the spelling of their earliest review.

    Comments are counted under a digest, with the earliest review's small key, so
    no text is shuffled or sorted. Texts are fetched for the comments that are at
    least as frequent as the ``n``-th, ties included.
    """
    undated = F.col("at").isNull() | (F.col("at") == PLACEHOLDER)
    earliest = F.struct(undated.alias("u"), "at", "reviewId")
    keyed = _commented(reviews).withColumn("digest", F.unhex(F.sha2("key", 256)))
    counts = materialise(
        keyed.groupBy("digest").agg(
            F.count(F.lit(1)).alias("count"),
            F.coalesce(F.sum("thumbsUpCount"), F.lit(0)).alias("totalThumbsUp"),
            F.min(earliest).alias("first"),
            F.bround(F.avg("score"), 2).alias("avgScore"),
        )
    )
    least = top_k(counts, [F.col("count").desc()], n).agg(F.min("count")).scalar()
    frequent = materialise(counts.where(F.col("count") >= least))
    texts = keyed.select("digest", earliest.alias("first"), F.col("content").alias("comment"), "key")
    same = texts["digest"] == frequent["digest"]
    spelled = texts.join(frequent, same & texts["first"].eqNullSafe(frequent["first"])).select(
        frequent["digest"], "count", "totalThumbsUp", "comment", "avgScore", "key"
    )
    # Repeated rows of the earliest review are one; only the frequent comments are left here.
    single = spelled.groupBy("digest", "count", "totalThumbsUp", "avgScore").agg(
        F.min(F.struct("key", "comment")).alias("text")
    )
    ranked = top_k(single, [F.col("count").desc(), F.col("text.key")], n)
    return ranked.select("count", "totalThumbsUp", F.col("text.comment").alias("comment"), "avgScore")


def count_short_content(reviews: DataFrame, n: int = 5) -> DataFrame:
    """How many reviews ``short_content`` lists."""
    return short_content(reviews, n).agg(F.count(F.lit(1)).alias("reviews"))


def short_content(reviews: DataFrame, n: int = 5) -> DataFrame:
    """Reviews whose content is under ``n`` characters, counted in code points."""
    return reviews.where(F.char_length("content") < n).select("reviewId", "userName", "content", "score", "at")


def avg_score_per_day(reviews: DataFrame) -> DataFrame:
    """Reviews and mean score per day; undated reviews are left out."""
    return (
        reviews.select(day_of(F.col("at")).alias("day"), "score")
        .where(F.col("day").isNotNull())
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("reviews"), F.bround(F.avg("score"), 2).alias("avgScore"))
        .select("reviews", "day", "avgScore")
        .orderBy("day")
    )
