"""Operators over ordered series, safe for one series holding most of the rows.

All rows are cut into ranges of series and order, one per shuffle partition, so a
long series lies in many ranges and a range holds many short ones. What a range
needs from its predecessors travels in a table of one row per series and range.
The order must be unique within a series: equal entries fail the job, as their
rows have no order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.operators.matching import null_safe_join
from millrace.session import materialise


def cut_into_ranges(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """Stored copy of ``df`` with ``__part``: its range in ``order``, by default one per shuffle partition.

    Range bounds come from a sample, so the part number is stored with the rows;
    recomputing it in a later stage could place a row elsewhere.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(
        df.repartitionByRange(parts, *[quoted(c) for c in order])
        .withColumn("__part", F.spark_partition_id())
    )


def _checked(value: Column, order: list[str], window) -> Column:
    """``value``, or an error where the preceding entry has the same place in the order."""
    here = F.struct(*[quoted(c).alias(f"o{i}") for i, c in enumerate(order)])
    repeated = F.lag(here).over(window).eqNullSafe(here)
    return F.when(repeated, F.raise_error(F.lit("the order of a series repeats an entry"))).otherwise(value)


def _windows(keys: list[str], order: list[str]):
    return Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*[quoted(c) for c in order])


def _previous(value: str, window) -> Column:
    """The preceding value in a struct: NULL means there is no predecessor."""
    return F.lag(F.struct(quoted(value).alias("v"))).over(window)


def _carried(cut: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Per (keys, part), the last value of the part before it, in a struct."""
    tails = cut.groupBy(*[quoted(k) for k in keys], "__part").agg(
        F.max_by(
            F.struct(quoted(value).alias("v")),
            F.struct(*[quoted(c).alias(f"o{i}") for i, c in enumerate(order)]),
        ).alias("__tail")
    )
    by_part = Window.partitionBy(*[quoted(k) for k in keys]).orderBy("__part")
    return tails.select(
        *[quoted(k) for k in keys], "__part", F.lag("__tail").over(by_part).alias("__carry")
    )


def with_previous(
    df: DataFrame, series: list[str], order: list[str], value: str, parts: int | None = None
) -> DataFrame:
    """``df`` with ``__prev``: the preceding value of the series in a struct ``v``."""
    cut = cut_into_ranges(df, series + order, parts)
    window = _windows(series + ["__part"], order)
    local = cut.withColumn("__prev", _checked(_previous(value, window), order, window))
    # Stored: one row per series and range, whose real size decides how it is joined.
    carried = materialise(_carried(cut, series, order, value))
    filled = null_safe_join(local, carried, series + ["__part"])
    return filled.withColumn("__prev", F.coalesce("__prev", "__carry")).drop("__carry", "__part")


def max_after(
    df: DataFrame, series: list[str], order: list[str], value: str, marker=0, parts: int | None = None
) -> DataFrame:
    """Per series, the greatest value directly preceded by ``marker``; NULL if none."""
    needed = df.select(*[quoted(c) for c in dict.fromkeys(series + order + [value])])
    paired = with_previous(needed, series, order, value, parts)
    after = F.when(F.col("__prev").getField("v") == F.lit(marker), quoted(value))
    return paired.groupBy(*[quoted(k) for k in series]).agg(F.max(after).alias("max_after"))


def run_length_encode(
    df: DataFrame, series: list[str], order: list[str], value: str, parts: int | None = None
) -> DataFrame:
    """Runs of equal values per series: ``series, run_no, value, length``.

    NULLs form runs of their own. ``run_no`` counts from 1 along ``order``.
    """
    needed = df.select(*[quoted(c) for c in dict.fromkeys(series + order + [value])])
    cut = cut_into_ranges(needed, series + order, parts)
    stitched = _stitch_runs(materialise(_local_runs(cut, series + ["__part"], order, value)), series, value)
    return stitched.select(*[quoted(k) for k in series], "run_no", quoted(value), "length")


def _local_runs(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    window = _windows(keys, order)
    before = _previous(value, window)
    starts = before.isNull() | ~before.getField("v").eqNullSafe(quoted(value))
    flagged = df.withColumn("__start", _checked(starts.cast("long"), order, window))
    numbered = flagged.withColumn(
        "__run", F.sum("__start").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    # A run has one value: as a grouping key it leaves a count to be hashed, no text to sort.
    return numbered.groupBy(*[quoted(k) for k in keys], "__run", quoted(value)).agg(
        F.count(F.lit(1)).alias("length")
    )


def _stitch_runs(runs: DataFrame, series: list[str], value: str) -> DataFrame:
    """Join runs that continue across range borders and number all of them."""
    keys = [quoted(k) for k in series]
    wrapped = F.struct(quoted(value).alias("v"))
    parts = runs.groupBy(*keys, "__part").agg(
        F.max("__run").alias("__runs"),
        F.min_by(wrapped, "__run").alias("__head"),
        F.max_by(wrapped, "__run").alias("__tail"),
    )
    by_part = Window.partitionBy(*keys).orderBy("__part")
    before = F.lag("__tail").over(by_part)
    joined = before.isNotNull() & before.getField("v").eqNullSafe(F.col("__head").getField("v"))
    offsets = (
        parts.withColumn("__joined", joined.cast("long"))
        .withColumn(
            "__base",
            F.coalesce(
                F.sum(F.col("__runs") - F.col("__joined")).over(by_part.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .select(*keys, "__part", (F.col("__base") - F.col("__joined")).alias("__shift"))
    )
    # Stored: one row per series and range, whose real size decides how it is joined.
    placed = null_safe_join(runs, materialise(offsets), series + ["__part"])
    return (
        placed.withColumn("run_no", F.col("__run") + F.col("__shift"))
        .groupBy(*keys, "run_no", quoted(value))
        .agg(F.sum("length").alias("length"))
    )
