"""Exact percentiles with linear interpolation, for groups of any size.

A percentile needs the values at one or two ranks. A sketch brackets each of them, for all columns in the
scan that counts their values. A second scan counts exactly what lies below, within and above each
bracket, which tells whether it holds its ranks, and a third one takes the values of brackets
only (of all beyond one where it missed a rank), which are few. What is still too much for a task is cut at ``CELLS`` splitters of a further sketch, round by round: the
rows of every cell are counted and only cells that hold a wanted rank stay. Rows are scanned and counted by
partial aggregates, as wide as they come; nothing else of them is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.operators.matching import null_safe_join
from millrace.session import discard, materialise

#: Cells into which a round cuts a group, a power of two.
CELLS = 64
#: Distinct values of a cell that a task sorts.
TASK_VALUES = 1 << 20
#: Relative accuracy of the first sketch, and how far its brackets reach to either side of a fraction.
ACCURACY, REACH = 2000, 1 / 1000


def percentiles_by(
    df: DataFrame, keys: list[str], value: str, fractions: list[float], task_values: int = TASK_VALUES
) -> DataFrame:
    """Per group, ``percentiles``: the value at each of ``fractions``, in order.

    NULL values are left out, and a group of nothing else with them; NULL keys are a group. Without
    ``keys`` all rows are one group.
    """
    found = percentiles_of(df.where(quoted(value).isNotNull()), keys, [value], fractions, task_values=task_values)
    return found.select(*[quoted(k) for k in keys], F.col("percentiles")[0].alias("percentiles"))


def percentiles_of(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    fractions: list[float],
    besides: list[Column] = (),
    task_values: int = TASK_VALUES,
) -> DataFrame:
    """Per group the aggregates ``besides`` and ``percentiles``: for each of ``columns`` the values at ``fractions``.

    NULL values are left out; of a column with nothing else in a group the values are NULL. NULL keys are a
    group. Without ``keys`` all rows are one group, if there are any.
    """
    # Without keys all rows share one that is not among the columns.
    own = [f"__k{i}" for i in range(len(keys))] or ["__k"]
    given = [quoted(k).alias(a) for k, a in zip(keys, own)] or [F.lit(0).alias("__k")]
    rows = df.select(*given, *[quoted(c).cast("double").alias(f"__v{i}") for i, c in enumerate(columns)])
    marks = [min(1.0, max(0.0, f + side)) for f in fractions for side in (-REACH, REACH)]
    sketched = [
        F.struct(F.count(v).alias("total"), F.percentile_approx(v, marks, ACCURACY).alias("marks")).alias(f"__s{i}")
        for i, v in enumerate(quoted(c).cast("double") for c in columns)
    ]
    groups = materialise(df.select(*given, "*").groupBy(*own).agg(*besides, *sketched))
    brackets = groups.select(*own, *[f"__s{i}" for i in range(len(columns))])
    located = materialise(_located(rows, brackets, own, len(columns), fractions, not keys))
    ranks = located.select(*own, F.inline("__ranks"))
    known = ranks.where("__single").select(*own, "__c", "__j", "__p", "__value")
    group = [*own, "__c", "__j"]
    wanted = ranks.where("not __single").select(*group, "__p", "__rank").withColumn("__below", F.lit(0).cast("long"))
    survivors = materialise(_survivors(rows, located.drop("__ranks"), own, len(columns), len(fractions), not keys))
    values = known.unionByName(_at_ranks(survivors, group, wanted, task_values))
    # Two ranks per column and fraction.
    ends = [
        F.max(F.when((F.col("__c") == i) & (F.col("__j") == j) & (F.col("__p") == p), F.col("__value"))).alias(f"__e{i}_{j}_{p}")
        for i in range(len(columns))
        for j in range(len(fractions))
        for p in (0, 1)
    ]
    by_group = null_safe_join(groups, materialise(values.groupBy(*own).agg(*ends)), own, "left")
    percentiles = F.array(
        *[
            F.array(*[_between(F.col(f"__e{i}_{j}_0"), F.col(f"__e{i}_{j}_1"), _position(f, i)) for j, f in enumerate(fractions)])
            for i in range(len(columns))
        ]
    )
    kept = [c for c in groups.columns if c not in own and not c.startswith("__s")]
    return by_group.select(*[F.col(a).alias(k) for k, a in zip(keys, own)], *[quoted(c) for c in kept], percentiles.alias("percentiles"))


def _beside(rows: DataFrame, few: DataFrame, keys: list[str], alone: bool) -> DataFrame:
    """``rows`` with the columns of the row that ``few`` has for their keys; of its only row if ``alone``."""
    if not alone:
        return null_safe_join(rows, few, keys)
    names = [c for c in few.columns if c not in keys]
    return rows.withColumn("__only", few.select(F.struct(*names)).scalar()).select(*rows.columns, "__only.*")


def _located(rows: DataFrame, brackets: DataFrame, own: list[str], columns: int, fractions: list[float], alone: bool) -> DataFrame:
    """Per group the place of every wanted rank, ``__ranks``, and per column and fraction the bounds to look within.

    The bounds are those of the bracket, or none to the side where a rank lies beyond it. ``__rank`` counts from the
    lower one. A bracket of one value that holds both ranks has ``__value`` and no bounds.
    """
    counts = []
    pairs = [(i, j) for i in range(columns) for j in range(len(fractions))]
    for i, j in pairs:
        value, low, high = F.col(f"__v{i}"), F.col(f"__s{i}.marks")[2 * j], F.col(f"__s{i}.marks")[2 * j + 1]
        counts += [F.count_if(value < low).alias(f"__below{i}_{j}"), F.count_if(value <= high).alias(f"__upto{i}_{j}")]
    counted = _beside(rows, brackets, own, alone).groupBy(*own).agg(*counts)
    placed = _beside(materialise(counted), brackets, own, alone)
    ranks, bounds = [], []
    for i, j in pairs:
        low, high = (F.col(f"__s{i}.marks")[2 * j + side] for side in (0, 1))
        first, last = (pick(_position(fractions[j], i)) for pick in (F.floor, F.ceil))
        under, over = first < F.col(f"__below{i}_{j}"), last >= F.col(f"__upto{i}_{j}")
        single = (low == high) & ~under & ~over
        for p, rank in enumerate((first, last)):
            place = F.struct(
                F.lit(i).alias("__c"), F.lit(j).alias("__j"), F.lit(p).alias("__p"),
                (rank - F.when(under, 0).otherwise(F.col(f"__below{i}_{j}"))).alias("__rank"),
                F.when(single, low).alias("__value"), single.alias("__single"),
            )
            ranks.append(F.when(F.col(f"__s{i}.total") > 0, place))
        lower, upper = F.when(under, F.lit(float("-inf"))).otherwise(low), F.when(over, F.lit(float("nan"))).otherwise(high)
        bounds += [F.when(~single, lower).alias(f"__from{i}_{j}"), F.when(~single, upper).alias(f"__to{i}_{j}")]
    return placed.select(*own, F.array_compact(F.array(*ranks)).alias("__ranks"), *bounds)


def _survivors(rows: DataFrame, bounds: DataFrame, own: list[str], columns: int, fractions: int, alone: bool) -> DataFrame:
    """Values within bounds, with how often each occurs."""
    taken, looked = [], F.lit(False)
    for i in range(columns):
        for j in range(fractions):
            value = F.col(f"__v{i}")
            within = (value >= F.col(f"__from{i}_{j}")) & (value <= F.col(f"__to{i}_{j}"))  # NaN is the greatest value
            taken.append(F.when(within, F.struct(F.lit(i).alias("__c"), F.lit(j).alias("__j"), value.alias("__v"))))
            looked = looked | F.coalesce(within, F.lit(False))
    # Few rows pass, so only few are unfolded.
    each = _beside(rows, bounds, own, alone).where(looked).select(*own, F.inline(F.array_compact(F.array(*taken))))
    return each.groupBy(*own, "__c", "__j", "__v").agg(F.count(F.lit(1)).alias("__n"))


def _at_ranks(rows: DataFrame, group: list[str], wanted: DataFrame, task_values: int) -> DataFrame:
    """Values of the ``wanted`` ranks of groups of ``rows`` (``group, __v, __n``), by rounds until a cell fits a task."""
    result = [*group, "__p"]
    splitters, known = [i / CELLS for i in range(1, CELLS)], []
    while True:
        largest = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if largest is None or largest <= task_values:
            break
        weighed = F.percentile_approx("__v", splitters, 20 * CELLS)
        grids = materialise(rows.groupBy(*group).agg(F.array_distinct(weighed).alias("__grid")))
        cell = f"__c{len(group)}"
        celled = _with_cell(null_safe_join(rows, grids, group), cell).drop("__grid")
        cells = celled.groupBy(*group, cell).agg(
            F.sum("__n").alias("__rows"), F.min("__v").alias("__low"), F.max("__v").alias("__high")
        )
        upto = F.sum("__rows").over(Window.partitionBy(*group).orderBy(cell))
        located = materialise(_holding(wanted, materialise(cells.withColumn("__upto", upto)), group, "__rows"))
        single = F.col("__low").eqNullSafe(F.col("__high"))
        known.append(located.where(single).select(*result, F.col("__low").alias("__value")))
        wanted = located.where(~single).select(
            *group, cell, "__p", "__rank", (F.col("__below") + F.col("__upto") - F.col("__rows")).alias("__below")
        )
        inside = null_safe_join(celled, wanted.select(*group, cell).distinct(), group + [cell], "left_semi")
        group = [*group, cell]
        before, rows = rows, materialise(inside)
        discard(before)
    upto = F.sum("__n").over(Window.partitionBy(*group).orderBy("__v"))
    ends = _holding(wanted, rows.withColumn("__upto", upto), group, "__n")
    return reduce(DataFrame.unionByName, [*known, ends.select(*result, F.col("__v").alias("__value"))])


def _holding(wanted: DataFrame, summed: DataFrame, group: list[str], own: str) -> DataFrame:
    """``wanted`` beside the row of ``summed`` whose ``own`` places, which end at ``__upto``, hold the rank."""
    rank = F.col("__rank") - F.col("__below")
    return null_safe_join(wanted, summed, group).where((rank < F.col("__upto")) & (rank >= F.col("__upto") - F.col(own)))


def _with_cell(rows: DataFrame, cell: str) -> DataFrame:
    """``cell``: how many of the sorted splitters in ``__grid`` a row's value reaches, by binary search."""
    rows, step = rows.withColumn(cell, F.lit(0)), CELLS // 2
    while step:
        reached = F.get("__grid", F.col(cell) + F.lit(step - 1)) <= F.col("__v")
        rows = rows.withColumn(cell, F.col(cell) + F.when(reached, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return rows


def _position(fraction: float, column: int) -> Column:
    return F.lit(float(fraction)) * (F.col(f"__s{column}.total") - F.lit(1)).cast("double")


def _between(low: Column, high: Column, position: Column) -> Column:
    below, above = F.floor(position), F.ceil(position)
    return F.when((below == above) | (low == high), low).otherwise((above - position) * low + (position - below) * high)


def median(df: DataFrame, column: str, task_values: int = TASK_VALUES) -> DataFrame:
    found = percentiles_by(df, [], column, [0.5], task_values)
    return found.agg(F.first("percentiles").alias("p")).select(F.col("p")[0].alias("median"))


def lowest_percentile_above(
    df: DataFrame, column: str, threshold: float, task_values: int = TASK_VALUES
) -> DataFrame:
    """First whole percentile whose value exceeds ``threshold``, and that value; NULL if none.

    Which one it is follows from the rows up to the threshold and the two values
    next to it, one aggregate; only its own value is then looked for.
    """
    value, limit = quoted(column).cast("double"), F.lit(float(threshold))
    total, upto, under, over = df.agg(
        F.count(value), F.count_if(value <= limit), F.max(F.when(value <= limit, value)), F.min(F.when(value > limit, value))
    ).first()
    for n in range(1, 101):
        position = n / 100 * (total - 1)
        low, part = int(position // 1), position % 1
        exceeds = low >= upto or (low == upto - 1 and part > 0 and over is not None and (1 - part) * under + part * over > threshold)
        if total and exceeds:
            found = percentiles_by(df, [], column, [n / 100], task_values)
            return found.select(F.lit(n).alias("percentile"), F.col("percentiles")[0].alias("value"))
    return df.sparkSession.range(1).select(F.lit(None).cast("int").alias("percentile"), F.lit(None).cast("double").alias("value"))


def share_above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Percentage of the non-null values above ``threshold``."""
    return df.where(quoted(column).isNotNull()).agg(
        (F.lit(100.0) * F.avg((quoted(column) > F.lit(threshold)).cast("int"))).alias("share_above")
    )
