"""Writes: tables, views, appends, partitioned layouts, metrics and landing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliogrid.functions import text

CHUNK_ROWS = 16_000


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Full replacement of a stored table; returns the stored rows."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return read_back(df, path)


def read_back(df: DataFrame, path: str) -> DataFrame:
    """The stored rows; the types of partition columns come from ``df``, not from their text."""
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_as_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create table as select, in the session catalog; with ``path`` the data lies there."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def append_by_year(df: DataFrame, path: str, date: str, year: str = "year") -> None:
    """Append into one folder per year; a row that fails to read or cast fails the load.

    Rows are rebalanced by year: AQE splits a year that holds most of the rows over many tasks,
    and no task opens a file in every year.
    """
    df.withColumn(year, F.year(date)).hint("rebalance", year).write.mode("append").partitionBy(year).parquet(path)


def append_chunked(df: DataFrame, path: str, rows: int = CHUNK_ROWS) -> None:
    """Append in files of at most ``rows`` rows."""
    df.write.mode("append").option("maxRecordsPerFile", rows).parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metrics as JSON lines."""
    metrics.write.mode("append").json(path)


def write_metric_objects(metrics: DataFrame, path: str, name: str = "path") -> None:
    """One JSON object per record, in a folder named after it (``object=<name>``), with the time of the upload.

    The name is the last part of ``name`` without its suffix, made safe for keys; records of the same name share a folder.
    Rows are dealt out by name first, so each folder is written by one task, one after the other. The number of tasks is
    set: by their bytes, all rows would go to a few tasks, but each row costs the opening of a file.
    """
    spark = metrics.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    base = F.regexp_replace(text.basename(text.safe_key(F.col(name))), r"\.[^.]*$", "")
    named = metrics.withColumns({"object": base, "uploaded_at": F.current_timestamp()}).repartition(tasks, "object")
    named.write.mode("append").option("maxRecordsPerFile", 1).partitionBy("object").json(path)


def load_report(rows: DataFrame, file: str = "file", expected: DataFrame | None = None) -> DataFrame:
    """Rows per loaded file with its status; a catalogued file without rows is ``empty``."""
    counts = rows.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows"))
    if expected is not None:
        counts = expected.select(file).join(counts, file, "left")
    n = F.coalesce("n_rows", F.lit(0))
    return counts.select(file, n.alias("n_rows"), F.when(n > 0, F.lit("success")).otherwise(F.lit("empty")).alias("status"))


def require_loaded(report: DataFrame) -> None:
    """Stop when a catalogued file gave no rows, for loads that must not skip files."""
    n = report.filter("status <> 'success'").count()
    if n:
        raise ValueError(f"{n} files gave no rows")


def to_variant(df: DataFrame, column: str, out: str = "RAW_DATA") -> DataFrame:
    """Semi-structured landing column; text that is not JSON becomes null."""
    return df.withColumn(out, F.try_parse_json(column))


def extract_variant(df: DataFrame, variant: str, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """Typed columns from a variant: output name to (path, type); a wrong type becomes null."""
    return df.withColumns({name: F.try_variant_get(F.col(variant), path, kind) for name, (path, kind) in paths.items()})


def with_year(df: DataFrame, path: str = "file", out: str = "year") -> DataFrame:
    """Year taken from the ``/yyyy/`` or ``/year=yyyy/`` part of a file path."""
    return df.withColumn(out, F.regexp_extract(path, r"/(?:year=)?(\d{4})/", 1).try_cast(T.IntegerType()))
