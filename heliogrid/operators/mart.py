"""Municipality mart: geometry, plant aggregates, station climate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliogrid.columns import HYDRO, SOLAR, WIND
from heliogrid.functions import geo
from heliogrid.operators.project import fill_zero

PLANT_MEASURES = ["num_total_usinas", "num_usinas_solares", "num_usinas_eolica", "potencia_total_mw", "potencia_hidro_mw"]


def with_geometry(layer: DataFrame, shape: str = "geometry") -> DataFrame:
    """Area in km² and centroid in degrees, both measured on the projected shape."""
    plane = layer.withColumn("_utm", geo.shape_to_utm(shape)).withColumn("_m", geo.moments("_utm"))
    plane = plane.withColumn("_c", geo.centroid_of("_m")).withColumn("_ll", geo.lonlat("_c.x", "_c.y"))
    measures = {"area_km2": F.col("_m.a") / 1e6, "centroid_lon": F.col("_ll.x"), "centroid_lat": F.col("_ll.y")}
    return plane.withColumns(measures).drop("_utm", "_m", "_c", "_ll")


def plant_measures(kind: Column, power_kw: Column) -> list[Column]:
    """All plant counts and powers of a group, as one set of conditional aggregates."""
    return [
        F.count(F.lit(1)).alias("num_total_usinas"),
        F.count_if(kind == SOLAR).alias("num_usinas_solares"),
        F.count_if(kind == WIND).alias("num_usinas_eolica"),
        (F.sum(power_kw) / 1000).alias("potencia_total_mw"),
        (F.sum(F.when(kind.isin(*HYDRO), power_kw)) / 1000).alias("potencia_hidro_mw"),
    ]


def plant_mart(
    municipalities: DataFrame, plants: DataFrame, key: str = "cd_mun", kind: str = "SigTipoGeracao", power: str = "potencia_kw"
) -> DataFrame:
    """Every municipality with its plant measures, 0 where it has none: one aggregate, one join."""
    measures = plants.groupBy(key).agg(*plant_measures(F.col(kind), F.col(power)))
    joined = municipalities.join(measures, key, "left")
    return joined.fillna(0, subset=PLANT_MEASURES)


def left_join_chain(base: DataFrame, aggregates: list[DataFrame], key: str) -> DataFrame:
    """Several aggregates joined to the base one after the other on one key, nulls set to 0."""
    for side in aggregates:
        base = base.join(side, key, "left")
    return fill_zero(base)


def station_mean(readings: DataFrame, station: str, value: str, out: str = "radiacao_media_anual") -> DataFrame:
    """Mean per station; missing values are left out."""
    return readings.groupBy(station).agg(F.avg(value).alias(out))


def station_mean_join(stations: DataFrame, means: DataFrame, left: str, right: str) -> DataFrame:
    """Left join of station rows and means whose key columns differ in name."""
    return stations.join(means, stations[left] == means[right], "left")


def monthly_season(readings: DataFrame, time: str, radiation: str, rain: str) -> DataFrame:
    """Mean radiation and total rain per calendar month."""
    return readings.groupBy(F.month(time).alias("mes")).agg(
        F.avg(radiation).alias("radiacao_media"), F.sum(rain).alias("chuva_total")
    )
