"""Profile of a census table: counts, shares and statistics by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted
from millrace.operators import bins
from millrace.operators.describe import describe_by
from millrace.operators.groups import describe_groups, keep_groups
from millrace.operators.ranking import argmax_with_ties
from millrace.operators.tally import all_true, is_true, share_where, value_counts

# The salary classes, and the degrees counted as higher education.
HIGH, LOW = ">50K", "<=50K"
DEGREES = ("Bachelors", "Prof-school", "Assoc-acdm", "Assoc-voc", "Masters", "Doctorate")

# The right-closed age groups.
AGE_EDGES = [16, 35, 70, 100]
AGE_LABELS = ["young", "adult", "retiree"]


def count_by_sex(df: DataFrame) -> DataFrame:
    return value_counts(df, "sex")


def mean_where(df: DataFrame, condition: Column, column: str, name: str) -> DataFrame:
    """Mean of ``column`` over the rows meeting ``condition``."""
    return df.where(condition).agg(F.avg(quoted(column)).alias(name))


def mean_age(df: DataFrame, sex: str = "Male") -> DataFrame:
    return mean_where(df, F.col("sex") == sex, "age", "mean_age")


def share_of(df: DataFrame, column: str, value, name: str = "share") -> DataFrame:
    """Share of rows holding ``value``; NULL counts in the denominator."""
    return df.agg(share_where(quoted(column) == F.lit(value)).alias(name))


def share_of_country(df: DataFrame, country: str = "United-States") -> DataFrame:
    return share_of(df, "native-country", country)


def mean_and_std(df: DataFrame, key: str, column: str) -> DataFrame:
    """Mean and sample standard deviation of ``column`` per group, in one aggregate."""
    return df.where(quoted(key).isNotNull()).groupBy(quoted(key).alias(key)).agg(
        F.avg(quoted(column)).alias("mean"), F.stddev_samp(quoted(column)).alias("std")
    )


def age_by_salary(df: DataFrame) -> DataFrame:
    return mean_and_std(df, "salary", "age")


def all_in(df: DataFrame, condition: Column, column: str, allowed: tuple) -> DataFrame:
    """One row, ``all_in``: do all rows meeting ``condition`` hold an allowed value?"""
    return df.where(condition).agg(all_true(quoted(column).isin(*allowed)).alias("all_in"))


def exceptions(df: DataFrame, condition: Column, column: str, allowed: tuple) -> DataFrame:
    """The rows meeting ``condition`` without an allowed value."""
    return df.where(condition & ~is_true(quoted(column).isin(*allowed)))


def high_earners_have_degree(df: DataFrame) -> DataFrame:
    return all_in(df, F.col("salary") == HIGH, "education", DEGREES)


def high_earners_without_degree(df: DataFrame) -> DataFrame:
    return exceptions(df, F.col("salary") == HIGH, "education", DEGREES)


def describe_by_race_and_sex(df: DataFrame) -> DataFrame:
    return describe_by(df, ["race", "sex"])


def max_age(df: DataFrame, race: str = "Asian-Pac-Islander", sex: str = "Male") -> DataFrame:
    return df.where((F.col("race") == race) & (F.col("sex") == sex)).agg(F.max("age").alias("max_age"))


def share_by_prefix(df: DataFrame, column: str, prefix: str, condition: Column) -> DataFrame:
    """Share meeting ``condition`` among values that start with ``prefix`` and the others."""
    return (
        df.where(quoted(column).isNotNull())
        .groupBy(quoted(column).startswith(prefix).alias("has_prefix"))
        .agg(share_where(condition).alias("share"))
    )


def high_share_by_marriage(df: DataFrame, sex: str = "Male") -> DataFrame:
    men = df.where(F.col("sex") == sex)
    return share_by_prefix(men, "marital-status", "Married", F.col("salary") == HIGH).withColumnRenamed(
        "has_prefix", "married"
    )


def share_at_maximum(df: DataFrame, column: str, condition: Column) -> DataFrame:
    """Maximum of ``column``, rows holding it, and the percentage of them meeting ``condition``."""
    return argmax_with_ties(df, column).agg(
        F.max(quoted(column)).alias("maximum"),
        F.count(F.lit(1)).alias("rows"),
        (F.lit(100.0) * F.count_if(is_true(condition)) / F.count(F.lit(1))).alias("percent"),
    )


def longest_hours(df: DataFrame) -> DataFrame:
    return share_at_maximum(df, "hours-per-week", F.col("salary") == HIGH)


def mean_pivot(df: DataFrame, key: str, pivot: str, values: list, column: str) -> DataFrame:
    """Mean of ``column`` per group, one column per pivot value; the values are given, not searched."""
    return (
        df.where(quoted(key).isNotNull())
        .groupBy(quoted(key).alias(key))
        .pivot(pivot, values)
        .agg(F.avg(quoted(column)))
    )


def hours_by_country(df: DataFrame) -> DataFrame:
    known = df.where(F.col("salary").isin(LOW, HIGH))
    return mean_pivot(known, "native-country", "salary", [LOW, HIGH], "hours-per-week")


def with_age_group(df: DataFrame, name: str = "AgeGroup") -> DataFrame:
    return df.withColumn(name, bins.label_bins(F.col("age"), AGE_EDGES, AGE_LABELS))


def high_earners_per_age_group(df: DataFrame) -> DataFrame:
    rich = with_age_group(df.where(F.col("salary") == HIGH))
    return bins.bin_counts(rich, "AgeGroup", AGE_LABELS)


def top_age_group(df: DataFrame) -> DataFrame:
    return bins.top_bin(high_earners_per_age_group(df)).select("AgeGroup")


def describe_occupations(df: DataFrame) -> DataFrame:
    return describe_groups(df, "occupation")


def young_busy_occupations(df: DataFrame, max_mean_age: float = 40, min_hours: float = 5) -> DataFrame:
    """Rows of occupations of mean age at most 40 in which everybody works over 5 hours."""
    return keep_groups(
        df,
        "occupation",
        {
            "young": F.avg("age") <= max_mean_age,
            "busy": F.bool_and(is_true(quoted("hours-per-week") > min_hours)),
        },
    )
