"""The analyses from end to end, as compositions of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliogrid.columns import FEATURES
from heliogrid.functions import dates, scale
from heliogrid.operators import mart, model, rank, spatial, split
from heliogrid.session import stage_table
from heliogrid.sources import station


def station_readings(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Typed readings of station files with their date and station name."""
    rows = station.typed(station.scan_with_station(spark, paths), "double")
    return rows.withColumn("data", dates.try_date(F.col("data")))


def station_climate(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Stations with position and mean radiation; a station without readings keeps a null mean."""
    preamble = station.preamble_by_position(spark, paths)
    means = mart.station_mean(station_readings(spark, paths), "estacao", "radiacao_global_kj_m2")
    places = preamble.select("nome", *[F.col(c).try_cast("double").alias(c) for c in ("latitude", "longitude")]).dropDuplicates()
    return mart.station_mean_join(places, means, "nome", "estacao").drop("estacao")


def energy_mart(layer: DataFrame, plants: DataFrame, stations: DataFrame, station_id: str, station_xy: tuple[str, str]) -> DataFrame:
    """Per municipality: area, centroid, plants inside, and the radiation of the nearest station.

    ``layer`` has cd_mun, nm_mun and geometry; ``stations`` has radiacao_media_anual. The result
    is stored, as every later step reads this small table several times.
    """
    base = mart.with_geometry(layer).drop("geometry")
    inside = spatial.join_within(plants, layer.select("cd_mun", "geometry"))
    full = stage_table(mart.plant_mart(base, inside), "plants")
    stations = stage_table(stations, "stations")
    centroids = full.select("cd_mun", "centroid_lon", "centroid_lat")
    near = spatial.nearest_join(centroids, stations, "cd_mun", station_id, ("centroid_lon", "centroid_lat"), station_xy)
    # The hint keeps Spark from broadcasting stations, which may be small only as a compressed file.
    climate = near.join(stations.select(station_id, "radiacao_media_anual").hint("merge"), station_id).select("cd_mun", "radiacao_media_anual")
    return stage_table(full.join(climate, "cd_mun", "left"), "energy")


def potential_ranking(energy: DataFrame, n: int = 15) -> DataFrame:
    """The n municipalities with the highest potential score."""
    return rank.ranking(scale.with_potential_score(energy), "potencial_score", "nm_mun", n)


def train_and_rank(energy: DataFrame, families: dict[str, dict[str, list]] = model.GRIDS, folds: int = 5, n: int = 10) -> DataFrame:
    """Score, split, grid search, best model by test score, and its ranking of all municipalities."""
    target = "potencial_score"
    scored = stage_table(split.split_exact(scale.with_potential_score(energy), "cd_mun"), "scored")
    train, test = scored.filter("NOT is_test"), scored.filter("is_test")
    folded = stage_table(split.kfold_contiguous(train, "cd_mun", folds), "folds")
    results = model.cv_grid(folded, FEATURES, target, families, folds=folds)
    fitted = model.refit(train, FEATURES, target, model.best_params(results))
    _, best = model.best_model(fitted, model.evaluate_models(fitted, test, target))
    return rank.ranking(model.batch_predict(best, scored), "predicted_potential", "nm_mun", n)
