"""Projections, fills and schema conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliogrid.functions import text

_NUMBERS = (T.NumericType,)


def rename_keep(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the mapped columns, under their new names."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[text.normalize_header(c) for c in df.columns])


def fill_zero(df: DataFrame) -> DataFrame:
    """Null to 0 in every numeric column."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMBERS)]
    return df.fillna(0, subset=numeric)


def ensure_column(df: DataFrame, name: str, default: float = 0.0) -> DataFrame:
    """Add the column as a constant if it is missing, else replace its nulls."""
    if name not in df.columns:
        return df.withColumn(name, F.lit(default))
    return df.withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; missing ones are null, others left out."""
    have = {c.upper(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        source = have.get(f.name.upper())
        value = F.col(f"`{source}`") if source else F.lit(None)
        cols.append(value.try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def sample_values(df: DataFrame, col: str, n: int = 5, seed: int = 42, key: str | None = None) -> DataFrame:
    """Up to ``n`` non-null values, chosen by a hash of the key so that the choice is fixed."""
    by = F.col(key or col).cast("string")
    picked = df.filter(F.col(col).isNotNull()).withColumn("_h", F.md5(F.concat(by, F.lit(str(seed)))))
    return picked.orderBy("_h", by).limit(n).drop("_h")
