"""Vector and matrix operators over columns, array columns and matrix entries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.operators.matching import peak_of, with_match
from millrace.session import discard, materialise

#: Patterns that a pass compares with each vector.
BATCH_PATTERNS = 32_768


def negate_between(value: Column, low, high) -> Column:
    """``-value`` strictly between the bounds, ``value`` elsewhere."""
    return F.when((value > F.lit(low)) & (value < F.lit(high)), -value).otherwise(value)


def negate_between_in(vector: Column, low, high) -> Column:
    """The same for every element of an array."""
    return F.transform(vector, lambda v: negate_between(v, low, high))


def zero_max(df: DataFrame, column: str) -> DataFrame:
    """``df`` with every occurrence of the maximum of ``column`` set to 0."""
    kind = df.schema[column].dataType
    return df.withColumn(
        column,
        F.when(quoted(column) == peak_of(df, column), F.lit(0).cast(kind)).otherwise(quoted(column)),
    )


def zero_max_in(vector: Column) -> Column:
    """The same within one array."""
    return F.transform(vector, lambda v: F.when(v == F.array_max(vector), F.lit(0)).otherwise(v))


def direct_product(df: DataFrame, lists: list[str], names: list[str] | None = None) -> DataFrame:
    """All combinations of one element from each of a row's list columns.

    Each row unfolds its own lists, so nothing is shuffled; a row yields the
    product of its list sizes. Duplicates are kept.
    """
    names = names or [f"x{i}" for i in range(len(lists))]
    unfolded = df
    for column, name in zip(lists, names):
        unfolded = unfolded.withColumn(name, F.explode(quoted(column)))
    return unfolded.drop(*lists)


def rows_hitting_all(
    a: DataFrame, vector: str, b: DataFrame, pattern: str, batch_patterns: int = BATCH_PATTERNS
) -> DataFrame:
    """Rows of ``a`` whose ``vector`` shares an element with the ``pattern`` of every row of ``b``.

    An empty ``b`` keeps every row. A NULL element matches nothing. No vector meets a pattern: the
    distinct patterns are numbered, the shortest first, and an index has per element the bitmap of
    the patterns that hold it. The bitmaps of a vector's elements, joined by OR, are full if it hits all
    patterns. A bitmap has ``batch_patterns`` bits (32,768 at most), so there is one round for so many
    patterns, over the distinct vectors that are left; a vector's bitmaps are joined where the vector is.
    """
    values = F.array_sort(F.array_distinct(F.array_compact(quoted(vector))))
    sets = b.select(F.array_sort(F.array_distinct(F.array_compact(quoted(pattern)))).alias("__b")).distinct()
    size = F.lit(batch_patterns).cast("long")
    # Numbers rise within a partition of the sort, so a round holds patterns of one partition.
    at = F.monotonically_increasing_id()
    numbered = materialise(
        sets.orderBy(F.size("__b"), "__b").select("__b", F.call_function("div", at, size).alias("__round"), (at % size).alias("__bit"))
    )
    empty = F.array().cast(sets.schema["__b"].dataType)
    left = materialise(a.select(F.coalesce(values, empty).alias("__a")).distinct())
    # One number per round.
    for row in numbered.select("__round").distinct().orderBy("__round").collect():
        own = numbered.where(F.col("__round") == row["__round"])
        full = own.agg(F.bitmap_construct_agg("__bit").alias("full")).scalar()
        index = own.select(F.explode("__b").alias("__e"), "__bit").groupBy("__e").agg(F.bitmap_construct_agg("__bit").alias("__bits"))
        elements = left.repartition("__a").select("__a", F.explode("__a").alias("__e"))
        hit = elements.join(materialise(index), "__e").groupBy("__a").agg(F.bitmap_or_agg("__bits").alias("__hit"))
        before, left = left, materialise(hit.where(F.col("__hit") == full).select("__a"))
        discard(before)
        if left.isEmpty():
            break
    keyed = a.withColumn("__a", F.coalesce(values, empty))
    return with_match(keyed, left, "__a").drop("__a")


def rows_not_constant(df: DataFrame, vector: str, floating: bool = True) -> DataFrame:
    """Rows whose elements are not all equal; a NaN equals nothing, itself included."""
    varied = F.size(F.array_distinct(quoted(vector))) > 1
    if floating:
        varied = varied | F.exists(quoted(vector), lambda v: F.isnan(v))
    return df.where(varied)


def unique_rows(df: DataFrame) -> DataFrame:
    """Distinct rows in lexicographic order."""
    return df.distinct().orderBy(*[quoted(c) for c in df.columns])


def diagonal_product(entries: DataFrame, keys: list[str] = (), i: str = "i", j: str = "j", value: str = "value") -> DataFrame:
    """Product of the nonzero diagonal entries per matrix; 1 when there are none."""
    on_diagonal = (quoted(i) == quoted(j)) & (quoted(value) != 0)
    return entries.groupBy(*[quoted(k) for k in keys]).agg(
        F.coalesce(F.product(F.when(on_diagonal, quoted(value))), F.lit(1.0)).alias("product")
    )


def same_multiset(x: DataFrame, y: DataFrame, column: str) -> DataFrame:
    """One row, ``same``: do both columns hold the same values equally often?"""
    signed = x.select(quoted(column).alias("v"), F.lit(1).alias("d")).unionByName(
        y.select(quoted(column).alias("v"), F.lit(-1).alias("d"))
    )
    balance = signed.groupBy("v").agg(F.sum("d").alias("d"))
    return balance.agg(F.coalesce(F.bool_and(F.col("d") == 0), F.lit(True)).alias("same"))


def euclidean(x: Column, y: Column) -> Column:
    """Distance of two vectors; NULL when their lengths differ."""
    squares = F.zip_with(x, y, lambda p, q: (p.cast("double") - q.cast("double")) ** 2)
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s))


def distance_matrix(x: Column, y: Column) -> Column:
    """Euclidean distances of the rows of two matrices held as arrays of arrays."""
    return F.transform(x, lambda p: F.transform(y, lambda q: euclidean(p, q)))


def pairwise_distance(df: DataFrame, x: str, y: str) -> DataFrame:
    """Long form of ``distance_matrix`` per row of ``df``: ``x_id, y_id, d`` from 0."""
    rest = [quoted(c) for c in df.columns if c not in (x, y)]
    by_row = df.select(*rest, F.posexplode(distance_matrix(quoted(x), quoted(y))).alias("x_id", "__ds"))
    return by_row.select(*rest, "x_id", F.posexplode("__ds").alias("y_id", "d"))


def as_matrix(vector: Column, rows: int, width: int, start: int = 0) -> Column:
    """Consecutive slices of a vector as the rows of a matrix."""
    return F.array(*[F.slice(vector, start + r * width + 1, width) for r in range(rows)])
