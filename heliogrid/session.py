"""Session settings, shared scratch storage and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest serialised size a side may have to be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024

_local_scratch: dict[str, str] = {}


def build_session(app: str = "heliogrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE (coalescing and skew splitting) and no web page."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_scratch:
        _local_scratch[sc.applicationId] = tempfile.mkdtemp(prefix="heliogrid-")
    return _local_scratch[sc.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path (not yet created) below the scratch folder."""
    return os.path.join(scratch_dir(spark), "heliogrid", f"{label}-{uuid.uuid4().hex}")


def stage_table(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Used where several later steps need the same small result of a large scan: the scan
    runs once, and a lost executor costs only a re-read.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def serialised_bytes() -> Column:
    """Aggregate: total serialised size of the rows, all columns included."""
    return F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long")), F.lit(0).cast("long"))


def may_broadcast(size: int) -> bool:
    return size <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> tuple[DataFrame, bool]:
    """Hint a broadcast only after measuring ``df``; otherwise leave the join to AQE.

    ``df`` is read twice, so it should be a stored table.
    """
    small = may_broadcast(df.agg(serialised_bytes()).first()[0])
    return (F.broadcast(df) if small else df), small
