"""Column tests: each returns the failures, so an empty result means the test passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_unique(df: DataFrame, col: str) -> DataFrame:
    """Non-null values that occur more than once, with their counts."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter("n_records > 1")


def null_rows(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def test_report(df: DataFrame, tests: dict[str, list[str]]) -> DataFrame:
    """One row per test (``unique`` or ``not_null``) and column: failures and whether it passed."""
    parts = []
    for col, names in tests.items():
        for name in names:
            failures = not_unique(df, col) if name == "unique" else null_rows(df, col)
            parts.append(
                failures.agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(col).alias("column"), F.lit(name).alias("test"), "failures", (F.col("failures") == 0).alias("passed")
                )
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def dedup_observations(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order``; combined on the map side, so a hot key is cheap."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
