"""Named sources and models, and reads of catalog tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Models:
    """Names for sources and for the models built on them; a model is built when asked for."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._builders: dict[str, Callable[[Models], DataFrame]] = {}

    def source(self, name: str, df: DataFrame) -> None:
        self._builders[name] = lambda _: df

    def model(self, name: str):
        def register(builder: Callable[[Models], DataFrame]):
            self._builders[name] = builder
            return builder

        return register

    def ref(self, name: str) -> DataFrame:
        """A registered source or model, else a table of the session catalog."""
        if name in self._builders:
            return self._builders[name](self)
        return self.spark.table(name)


def read_table(df: DataFrame, where: Column | None = None, order: list[Column] | None = None, limit: int | None = None) -> DataFrame:
    """Rows of a table that satisfy ``where``; a limit with an order gives a fixed answer."""
    if where is not None:
        df = df.filter(where)
    if order:
        df = df.orderBy(*order)
    return df.limit(limit) if limit is not None else df


def jdbc_table(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A warehouse table read in parallel ranges of a numeric column."""
    return spark.read.options(**options).jdbc(url, table, column=column, lowerBound=low, upperBound=high, numPartitions=parts)


def table_listing(spark: SparkSession, pattern: str = "*") -> DataFrame:
    return spark.sql(f"SHOW TABLES LIKE '{pattern}'").select("tableName", F.col("isTemporary").alias("temporary"))
