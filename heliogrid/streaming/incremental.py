"""Incremental loads: every file enters the table exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from heliogrid.columns import RAW_SCHEMA
from heliogrid.functions import dates
from heliogrid.session import broadcast_if_small
from heliogrid.sources.station import STATION_FORMAT, only_readings, typed


def station_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New station files as text rows with their file path."""
    reader = spark.readStream.schema(RAW_SCHEMA).options(**STATION_FORMAT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(path).withColumn("file", F.col("_metadata.file_path"))
    return only_readings(rows)


def clean_readings(raw: DataFrame) -> DataFrame:
    """Typed readings with their observation time and year."""
    df = typed(raw, "double")
    date = dates.try_date(F.col("data"))
    return df.withColumns({"observed_at": dates.observation_timestamp(date, F.col("hora_utc")), "year": F.year(date), "data": date})


def run_once(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Load all files not loaded before, then stop; the checkpoint remembers which they were."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start(path)
    query.awaitTermination()
    return query


def dedup_stream(stream: DataFrame, keys: list[str], time: str, delay: str = "2 days") -> DataFrame:
    """Drop repeats of a key that arrive within the delay; older state is released."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def load_new_files(rows: DataFrame, ledger: DataFrame, file: str = "file") -> DataFrame:
    """Batch form: the rows of a scan whose file the ledger of loaded files lacks.

    Both name files in ``file``. Any number of files is read in one call; names stay in the tables.
    """
    loaded, _ = broadcast_if_small(ledger.select(file).distinct())
    return rows.join(loaded, file, "left_anti")
