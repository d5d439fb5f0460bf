"""Scaling, bins and the potential score as column arithmetic.

Fitting a scale is one aggregate that brings a single row back; applying it is a projection.
Give these functions a stored table when the rows behind it are costly to compute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weights of the potential score.
RADIATION_WEIGHT = 0.7
EXPLOITATION_WEIGHT = 0.3


def bounds(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[Column, Column]]:
    """Minimum and maximum of each column as constants, all from one aggregate."""
    row = df.agg(*[f(c) for c in cols for f in (F.min, F.max)]).first()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return {c: tuple(F.lit(v).cast(kinds[c]) for v in row[2 * i : 2 * i + 2]) for i, c in enumerate(cols)}


def minmax(col: Column, low: Column, high: Column) -> Column:
    """Position between the bounds; a constant column gives 0."""
    return F.when(high == low, F.lit(0.0) * col).otherwise((col - low) / (high - low))


def with_minmax(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Add the min-max normalised form of each key of ``names`` under its value."""
    b = bounds(df, list(names))
    return df.withColumns({out: minmax(F.col(c), *b[c]) for c, out in names.items()})


def with_zscore(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Centre and divide by the population deviation; a zero deviation divides by 1."""
    row = df.agg(*[f(c) for c in names for f in (F.avg, F.stddev_pop)]).first()
    out = {}
    for i, (c, name) in enumerate(names.items()):
        mean, deviation = row[2 * i], row[2 * i + 1]
        out[name] = (F.col(c) - F.lit(mean)) / F.lit(deviation or 1.0)
    return df.withColumns(out)


def with_potential_score(
    df: DataFrame,
    radiation: str = "radiacao_media_anual",
    solar: str = "num_usinas_solares",
    score: str = "potencial_score",
) -> DataFrame:
    """Normalised radiation minus normalised exploitation, rescaled to 0..1."""
    df = with_minmax(df, {radiation: "radiacao_norm", solar: "usinas_solares_norm"})
    raw = F.col("radiacao_norm") * RADIATION_WEIGHT - F.col("usinas_solares_norm") * EXPLOITATION_WEIGHT
    return with_minmax(df.withColumn("_raw", raw), {"_raw": score}).drop("_raw")


def with_equal_width_bin(df: DataFrame, col: str, out: str, bins: int = 3, label: str = "Categoria ") -> DataFrame:
    """Right-closed equal-width bins 1..n with labels; a constant column falls in the middle."""
    low, high = bounds(df, [col])[col]
    x = F.col(col)
    width = (high - low) / bins
    index = F.when(x.isNull(), None).when(high == low, F.lit((bins + 1) // 2))
    for i in range(1, bins):
        index = index.when(x <= low + width * i, F.lit(i))
    index = index.otherwise(F.lit(bins))
    return df.withColumn(f"{out}_bin", index).withColumn(out, F.concat(F.lit(label), F.col(f"{out}_bin").cast("string")))
