"""Row counts by period, profiles and value counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliogrid.operators.order import quantiles


def count_by(df: DataFrame, period: Column, name: str, count: str = "total_registros") -> DataFrame:
    return df.groupBy(period.alias(name)).agg(F.count(F.lit(1)).alias(count))


def union_year_month(df: DataFrame, date: str) -> DataFrame:
    """Counts per year and counts per month in one table; the year is text, as the month is.

    The days are counted once and both levels are taken from that small table's grouping sets.
    """
    return (
        rollup_year_month(df, date)
        .filter(F.col("ano").isNotNull())
        .select(F.coalesce("mes", F.col("ano").cast("string")).alias("periodo"), "total_registros")
    )


def rollup_year_month(df: DataFrame, date: str) -> DataFrame:
    """Counts per month, per year and in all, from one pass."""
    dated = df.select(F.year(date).alias("ano"), F.date_format(date, "yyyy/MM").alias("mes"))
    return dated.rollup("ano", "mes").agg(F.count(F.lit(1)).alias("total_registros"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Values by falling frequency, then by value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("total"))
    return counts.orderBy(F.desc("total"), F.asc(col))


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, deviation, extremes and interpolated quartiles of a column."""
    q25, q50, q75 = quantiles(df, {col: [0.25, 0.5, 0.75]})[col]
    x = F.col(col)
    return df.agg(
        F.count(x).alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.lit(q25).cast("double").alias("q25"),
        F.lit(q50).cast("double").alias("q50"),
        F.lit(q75).cast("double").alias("q75"),
        F.max(x).alias("max"),
    )
