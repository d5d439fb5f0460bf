"""File catalogs, listings and archives."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliogrid.functions import text


def file_catalog(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """Path, size and change time of every file below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select("path", "length", "modificationTime")


def filter_files(catalog: DataFrame, token: str | None = None, suffix: str | None = None, path: str = "path", **how: bool) -> DataFrame:
    """Keep files by name token and suffix; ``substring`` and ``ignore_case`` loosen or tighten."""
    if token:
        catalog = catalog.filter(text.has_token(F.col(path), token, how.get("substring", False)))
    if suffix:
        catalog = catalog.filter(text.has_suffix(F.col(path), suffix, how.get("ignore_case", True)))
    return catalog


def catalog_totals(catalog: DataFrame, *group: str | Column, length: str = "length") -> DataFrame:
    """Number of objects and their bytes, in all or by group."""
    totals = [F.count(F.lit(1)).alias("objects"), F.coalesce(F.sum(length), F.lit(0)).alias("bytes")]
    return catalog.groupBy(*group).agg(*totals) if group else catalog.agg(*totals)


def file_metrics(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Size and number of lines of every text file; files are split freely."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    keyed = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size_bytes"))
    return keyed.groupBy("path", "size_bytes").agg(F.count(F.lit(1)).alias("n_lines"))


def tree_files(lines: DataFrame, col: str = "value") -> DataFrame:
    """File names of a tree listing, one per row."""
    return lines.select(text.tree_entry(F.col(col)).alias("name")).filter(F.col("name").isNotNull())


def match_listing(listing: DataFrame, files: DataFrame, name: str = "name", path: str = "path") -> DataFrame:
    """Files whose last path part is listed; every match is kept, ``n_matches`` shows repeats."""
    files = files.withColumn("_base", text.basename(F.col(path)))
    counts = files.groupBy("_base").agg(F.count(F.lit(1)).alias("n_matches"))
    listed = listing.select(F.col(name).alias("_base")).join(counts, "_base")
    return listed.join(files, "_base").withColumnRenamed("_base", name)


def missing_from(listing: DataFrame, files: DataFrame, name: str = "name", path: str = "path") -> DataFrame:
    """Listed names without a file."""
    found = files.select(text.basename(F.col(path)).alias(name))
    return listing.join(found, name, "left_anti")


def key_changes(files: DataFrame, path: str = "path") -> DataFrame:
    """Old key, safe key, and a status: renamed, skipped, or collision of two old keys."""
    old = F.col(path)
    keyed = files.select("*", text.safe_key(old).alias("new_key"))
    taken = keyed.select("new_key", path).distinct().groupBy("new_key").agg(F.count(F.lit(1)).alias("n_old"))
    status = (
        F.when(~text.has_special_chars(old), F.lit("skipped")).when(F.col("n_old") > 1, F.lit("collision")).otherwise(F.lit("renamed"))
    )
    return keyed.join(taken, "new_key").withColumn("status", status).drop("n_old")


def outcome_counters(changes: DataFrame, *group: str) -> DataFrame:
    """Rows per outcome and group, in one aggregate."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("renamed", "skipped", "collision")]
    return changes.groupBy(*group).agg(*counts)


def _zip_table_function():
    # Defined here so that it travels to the executors by value.
    class ZipEntries:
        def eval(self, content: bytes, suffix: str):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for info in archive.infolist():
                    if not info.is_dir() and info.filename.lower().endswith(suffix.lower()):
                        yield info.filename, info.file_size, archive.read(info)

    return F.udtf(ZipEntries, returnType="entry string, size long, body binary")


def zip_entries(archives: DataFrame, content: str = "content", suffix: str = "") -> DataFrame:
    """Name, size and bytes of every file in an archive, one archive per input row; folders are skipped."""
    rows = archives.lateralJoin(_zip_table_function()(F.col(content).outer(), F.lit(suffix)))
    return rows.drop(content)
