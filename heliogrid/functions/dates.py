"""Column functions for dates, times and years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Accepted date layouts, in order of preference.
DATE_PATTERNS = ("yyyy/MM/dd", "yyyy-MM-dd")

# Hours and minutes, with or without colons and seconds.
TIME_PATTERN = r"^([01]\d|2[0-3]):?[0-5]\d(:?[0-5]\d)?$"


def try_date(col: Column, patterns: tuple[str, ...] = DATE_PATTERNS) -> Column:
    """Text to date, trying each layout; null when none fits."""
    return F.coalesce(*[F.try_to_date(col, p) for p in patterns])


def strict_date(col: Column, pattern: str = "yyyy/MM/dd") -> Column:
    """Text to date; a bad value stops the query."""
    return F.to_date(col, pattern)


def try_time(col: Column) -> Column:
    """``1300 UTC`` or ``13:00`` to ``13:00:00``; null when it is not a time of day."""
    clean = F.trim(F.replace(col, F.lit("UTC"), F.lit("")))
    digits = F.rpad(F.replace(clean, F.lit(":"), F.lit("")), 6, "0")
    parts = [F.substring(digits, i, 2) for i in (1, 3, 5)]
    return F.when(clean.rlike(TIME_PATTERN), F.concat_ws(":", *parts))


def observation_timestamp(date: Column, time: Column) -> Column:
    """Timestamp without zone from a date column and a time text of the files."""
    return F.concat(date.cast("string"), F.lit(" "), try_time(time)).try_cast("timestamp_ntz")


def month_label(col: Column, pattern: str = "yyyy-MM") -> Column:
    return F.date_format(col, pattern)


def two_digit_month(col: Column) -> Column:
    return F.lpad(F.month(col).cast("string"), 2, "0")


def year_series(df: DataFrame, start: Column, end: Column, name: str = "year") -> DataFrame:
    """One row per year between the one-row aggregates ``start`` and ``end``, both included."""
    return df.agg(F.sequence(start, end).alias("years")).select(F.explode("years").alias(name))


def years_since(spark: SparkSession, first: int, name: str = "year") -> DataFrame:
    """One row per year from ``first`` to the current one."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.year(F.current_date()))).alias(name))
