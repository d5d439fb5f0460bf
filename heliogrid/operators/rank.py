"""Rankings and high-high zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliogrid.operators.order import quantiles


def top_k(df: DataFrame, score: str, tie: str, k: int = 5) -> DataFrame:
    """The k best rows; each task keeps k rows, so nothing is sorted as a whole."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(tie).asc()).limit(k)


def ranking(df: DataFrame, score: str, tie: str, n: int = 10) -> DataFrame:
    """The n best rows with their place; the window sees only those n rows."""
    order = [F.col(score).desc_nulls_last(), F.col(tie).asc()]
    return top_k(df, score, tie, n).withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def synergy_zones(df: DataFrame, measures: list[str], share: float = 0.75) -> DataFrame:
    """Rows at or above the given quantile in every measure."""
    limits = quantiles(df, {m: [share] for m in measures})
    for m in measures:
        df = df.filter(F.col(m) >= F.lit(limits[m][0]).cast("double"))
    return df
