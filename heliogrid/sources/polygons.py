"""Municipality layers as GeoJSON lines or as a table of shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliogrid.functions import geo

FEATURE_SCHEMA = "struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"


def shape_from_geojson(kind: Column, coordinates: Column) -> Column:
    """Shape of a Polygon or a MultiPolygon from the coordinate text."""
    polygon = F.array(F.from_json(coordinates, "array<array<array<double>>>"))
    multi = F.from_json(coordinates, "array<array<array<array<double>>>>")
    shape = F.when(kind == "MultiPolygon", multi).when(kind == "Polygon", polygon)
    return F.transform(shape, lambda g: F.transform(g, lambda r: F.transform(r, lambda p: geo.point(p[0], p[1]))))


def scan_polygons(spark: SparkSession, paths: str | list[str], properties: dict[str, str]) -> DataFrame:
    """One row per feature line: the named properties and ``geometry``."""
    lines = spark.read.text(paths)
    feature = F.from_json("value", FEATURE_SCHEMA)
    df = lines.select(feature.alias("f")).filter(F.col("f.geometry").isNotNull())
    props = [F.col("f.properties")[source].alias(name) for source, name in properties.items()]
    return df.select(*props, shape_from_geojson(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("geometry"))


def to_geojson(properties: dict[str, Column], shape: str) -> Column:
    """A feature line, the inverse of ``scan_polygons``."""
    coordinates = F.expr(f"transform({shape}, g -> transform(g, r -> transform(r, p -> array(p.x, p.y))))")
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(*[c.alias(k) for k, c in properties.items()]).alias("properties"),
            F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates")).alias("geometry"),
        )
    )
