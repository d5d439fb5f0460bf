"""Writes to scratch storage, read back and compared with the source."""

import uuid

from pyspark.sql import functions as F

from heliogrid.queries.base import query, rounded, table
from heliogrid.session import new_folder
from heliogrid.sinks import tables as sink
from heliogrid.sources.tables import table_listing as list_tables

BY_YEAR_SQL = "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, round(sum(o_totalprice), 4) AS total FROM orders GROUP BY 1"


def by_year(df):
    return rounded(df.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")))


def unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


@query("materialize_table", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def materialize_table(spark, sf_dir):
    """A stored table that is replaced as a whole by the second write."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = new_folder(spark, "table")
    sink.replace_table(orders.filter(F.col("o_orderstatus") == "F"), path)
    return sink.replace_table(orders, path)


@query("materialize_view", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def materialize_view(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return sink.as_view(orders.select("o_orderkey", "o_totalprice"), unique("orders_view"))


@query("ctas", "SELECT o_orderkey AS pedido, o_totalprice AS valor FROM orders")
def ctas(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pedido"), F.col("o_totalprice").alias("valor"))
    return sink.save_as_table(df, unique("orders_ctas"), new_folder(spark, "ctas"))


@query("truncate_reload", "SELECT o_orderkey, o_totalprice FROM orders")
def truncate_reload(spark, sf_dir):
    """A table filled, emptied and filled again; another is dropped."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    name, other, path = unique("orders_reload"), unique("orders_drop"), new_folder(spark, "dropped")
    spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT, o_totalprice DOUBLE) USING parquet")
    orders.write.mode("append").insertInto(name)
    sink.truncate(spark, name)
    orders.write.mode("append").insertInto(name)
    sink.save_as_table(orders, other, path)
    sink.drop(spark, other)
    return spark.table(name)


@query("append_load", BY_YEAR_SQL)
def append_load(spark, sf_dir):
    """Two appends into year folders."""
    orders = table(spark, sf_dir, "orders")
    path = new_folder(spark, "append")
    for status in (F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"):
        sink.append_by_year(orders.filter(status), path, "o_orderdate")
    return by_year(spark.read.parquet(path))


@query("chunked_append", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def chunked_append(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = new_folder(spark, "chunks")
    sink.append_chunked(orders, path)
    return sink.read_back(orders, path)


@query("partition_by_year", BY_YEAR_SQL)
def partition_by_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")).hint("rebalance", "year")
    return by_year(sink.replace_table(orders, new_folder(spark, "years"), ["year"]))


@query("metrics_json", "SELECT doc_id, 'drive/' || source || '/doc_' || doc_id || '.txt' AS path, CAST(strlen(text) AS BIGINT) AS size_bytes, CAST(1 + length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS n_lines FROM documents")
def metrics_json(spark, sf_dir):
    """One metrics record per document, stored as JSON and read back."""
    docs = table(spark, sf_dir, "documents")
    metrics = docs.select(
        "doc_id",
        F.concat(F.lit("drive/"), "source", F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.octet_length("text").cast("long").alias("size_bytes"),
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
    )
    path = new_folder(spark, "metrics")
    sink.write_metrics(metrics, path)
    return spark.read.schema(metrics.schema).json(path)


@query(
    "metric_objects",
    "SELECT 'station_' || s_suppkey AS object, strlen(s_name) AS size_bytes, true AS uploaded, 1::BIGINT AS objects FROM supplier",
)
def metric_objects(spark, sf_dir):
    """One JSON object per file, with the time of its upload, read back by the names of the objects."""
    files = table(spark, sf_dir, "supplier")
    name = F.concat(F.lit("drive/station ("), F.col("s_suppkey").cast("string"), F.lit(").csv"))
    metrics = files.select(name.alias("path"), F.octet_length("s_name").cast("long").alias("size_bytes"))
    path = new_folder(spark, "objects")
    sink.write_metric_objects(metrics, path)
    stored = spark.read.schema("path string, size_bytes long, uploaded_at timestamp, object string").json(path)
    uploaded = F.max(F.col("uploaded_at").isNotNull() & (F.col("uploaded_at") <= F.current_timestamp())).alias("uploaded")
    return stored.groupBy("object").agg(F.max("size_bytes").alias("size_bytes"), uploaded, F.count_distinct(F.col("_metadata.file_path")).alias("objects"))


@query("table_listing", "SELECT DISTINCT 'mart_' || lower(c_mktsegment) AS name, true AS temporary FROM customer")
def table_listing(spark, sf_dir):
    """A view per market segment, found again by pattern."""
    tag = uuid.uuid4().hex
    customers = table(spark, sf_dir, "customer")
    for (segment,) in customers.select("c_mktsegment").distinct().collect():
        sink.as_view(customers.filter(F.col("c_mktsegment") == segment), f"mart_{segment.lower()}_{tag}")
    found = list_tables(spark, f"mart_*_{tag}")
    return found.select(F.replace("tableName", F.lit(f"_{tag}"), F.lit("")).alias("name"), "temporary")
