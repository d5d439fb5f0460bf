"""Micro-batches that enter a table exactly once, and the report of their loads.

Every batch is written to a folder of its own, named after the query and the batch, and only then published by a ledger
entry of the same name. Both replace what an earlier attempt left, so a batch that fails half-way and is run again adds
nothing; readers see the batches in the ledger and no others.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from heliogrid.session import broadcast_if_small
from heliogrid.sinks.tables import with_year

LEDGER = "file string, n_rows long, bytes long, year int, status string, seconds double, loaded_at timestamp, load string, batch long"


def _folder(path: str, load: str, batch: int) -> str:
    return os.path.join(path, f"load={load}", f"batch={batch}")


def _entry(rows: DataFrame, file: str, size: str | None) -> DataFrame:
    """Files of a stored batch with their rows, bytes and year."""
    bytes_ = F.max(size) if size else F.lit(None).cast("long")
    return with_year(rows.groupBy(F.col(file).alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), bytes_.cast("long").alias("bytes")))


def load_exactly_once(
    stream: DataFrame, path: str, ledger: str, checkpoint: str, file: str = "file", size: str | None = None, before_publish: Callable[[int], None] | None = None
) -> StreamingQuery:
    """Load all rows not loaded before, then stop.

    ``file`` names the column with a row's file and ``size`` one with the bytes of that file. The seconds in the ledger are
    those of the batch; with one file a batch they are those of the file. ``before_publish`` is called with the number
    of a batch that is written but not yet published.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark, began = batch.sparkSession, time.monotonic()
        load = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.write.mode("overwrite").parquet(_folder(path, load, number))
        if before_publish:
            before_publish(number)
        rows = spark.read.schema(batch.schema).parquet(_folder(path, load, number))
        entry = _entry(rows, file, size).withColumns(
            {"status": F.lit("success"), "seconds": F.lit(time.monotonic() - began), "loaded_at": F.current_timestamp()}
        )
        entry.write.mode("overwrite").parquet(_folder(ledger, load, number))

    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def load_report(spark: SparkSession, ledger: str, expected: DataFrame | None = None, file: str = "file") -> DataFrame:
    """Published files: rows, bytes, year, status, seconds and time of the load; an expected file without rows is ``empty``."""
    done = spark.read.schema(LEDGER).parquet(ledger)
    if expected is None:
        return done
    missing = expected.select(F.col(file).alias("file")).distinct().join(done.select("file"), "file", "left_anti")
    empty = with_year(missing).withColumns({"n_rows": F.lit(0).cast("long"), "status": F.lit("empty")})
    return done.unionByName(empty, allowMissingColumns=True)


def published(spark: SparkSession, path: str, ledger: str, schema: str) -> DataFrame:
    """The rows of published batches; folders that an unfinished batch left are not read."""
    done, _ = broadcast_if_small(spark.read.schema(LEDGER).parquet(ledger).select("load", "batch").distinct())
    rows = spark.read.schema(f"{schema}, load string, batch long").parquet(path)
    return rows.join(done, ["load", "batch"], "left_semi").drop("load", "batch")
