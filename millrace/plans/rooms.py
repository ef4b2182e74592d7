"""Reports over rooms and the students living in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.times import whole_years
from millrace.operators.ranking import top_k


def _housed(students: DataFrame) -> DataFrame:
    return students.where(F.col("room").isNotNull())


def students_per_room(rooms: DataFrame, students: DataFrame) -> DataFrame:
    """All rooms with their number of students, 0 for empty rooms."""
    counts = _housed(students).groupBy(F.col("room").alias("id")).agg(F.count("id").alias("student_count"))
    return rooms.join(counts, "id", "left").select(
        *[rooms[c] for c in rooms.columns], F.coalesce("student_count", F.lit(0)).alias("student_count")
    )


def lowest_avg_age_rooms(
    rooms: DataFrame, students: DataFrame, as_of: Column | None = None, n: int = 5
) -> DataFrame:
    """The ``n`` rooms of lowest mean age, in whole years per student on ``as_of``."""
    today = F.current_date() if as_of is None else as_of
    ages = _housed(students).groupBy(F.col("room").alias("id")).agg(
        F.avg(whole_years(F.col("birthday"), today)).cast(T.DecimalType(10, 2)).alias("avg_age_years")
    )
    order = [F.col("avg_age_years").asc_nulls_last(), F.col("id")]
    return top_k(rooms.select("id", "name").join(ages, "id"), order, n)


def largest_age_gap_rooms(rooms: DataFrame, students: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` rooms of largest age gap; a room of unknown birthdays comes first."""
    gaps = (
        _housed(students)
        .groupBy(F.col("room").alias("id"))
        .agg(F.min("birthday").alias("oldest"), F.max("birthday").alias("youngest"))
        .select("id", whole_years(F.col("oldest"), F.col("youngest")).cast("int").alias("age_diff_years"))
    )
    order = [F.col("age_diff_years").desc_nulls_first(), F.col("id")]
    return top_k(rooms.select("id", "name").join(gaps, "id"), order, n)


def mixed_sex_rooms(rooms: DataFrame, students: DataFrame) -> DataFrame:
    """Rooms housing more than one sex; min and max tell it without a distinct count."""
    mixed = (
        _housed(students)
        .groupBy(F.col("room").alias("id"))
        .agg(F.min("sex").alias("low"), F.max("sex").alias("high"))
        .where(F.col("low") < F.col("high"))
    )
    return rooms.join(mixed, "id", "left_semi")
