"""Filters, fills, names and keys over plain tables."""

from pyspark.sql import functions as F

from heliogrid.functions import text
from heliogrid.operators import counts, project, quality
from heliogrid.queries.base import query, table
from heliogrid.sinks.tables import extract_variant, to_variant


@query("filter_eq_and", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def filter_eq_and(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey", "o_totalprice")


@query("filter_isin", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')")
def filter_isin(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.filter(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")).select("o_orderkey", "o_orderpriority")


@query(
    "drop_null_rows",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'",
)
def drop_null_rows(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("seg"),
    )
    return df.dropna(how="any", subset=["c_acctbal", "seg"]).select("c_custkey", "c_acctbal")


@query(
    "fill_zero",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE 0 END AS c_acctbal,
              CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS seg FROM customer""",
)
def fill_zero(spark, sf_dir):
    """Numbers are filled with 0; missing text stays missing."""
    df = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("seg"),
    )
    return project.fill_zero(df)


@query(
    "ensure_column",
    "SELECT c_custkey, 0.0::DOUBLE AS radiacao_media_anual, CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE 0 END AS c_acctbal FROM customer",
)
def ensure_column(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"))
    return project.ensure_column(project.ensure_column(df, "radiacao_media_anual"), "c_acctbal")


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").dropDuplicates()


@query("project_rename", "SELECT c_custkey AS cd_mun, c_name AS nm_mun FROM customer")
def project_rename(spark, sf_dir):
    return project.rename_keep(table(spark, sf_dir, "customer"), {"c_custkey": "cd_mun", "c_name": "nm_mun"})


@query("normalize_headers", 'SELECT p_partkey AS "PART_KEY", p_name AS "PART_NAME", p_retailprice AS "RETAIL_PRICE" FROM part')
def normalize_headers(spark, sf_dir):
    df = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(" Part Key "), F.col("p_name").alias("part name"), F.col("p_retailprice").alias("Retail Price ")
    )
    return project.normalize_headers(df)


@query("normalize_text", "SELECT p_partkey, upper(replace(trim(p_name), ' ', '_')) AS name FROM part")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.normalize_text(F.concat(F.lit(" "), "p_name", F.lit("  "))).alias("name"))


@query(
    "name_predicates",
    """SELECT p_partkey, contains(upper(p_name), 'RING') AS has_ring, starts_with(p_name, 'red') AS starts_red,
              ends_with(p_name, 'widget') AS ends_widget FROM part""",
)
def name_predicates(spark, sf_dir):
    n = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.upper(n).contains("RING").alias("has_ring"),
        n.startswith("red").alias("starts_red"),
        n.endswith("widget").alias("ends_widget"),
    )


@query("basename", "SELECT page_id, split_part(url, '/', -1) AS base, substr(url, 7) AS rest FROM pages")
def basename(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", text.basename(url).alias("base"), text.strip_prefix(url, 6).alias("rest"))


@query(
    "key_join",
    """SELECT page_id, 'drive/in/' || ltrim(url, '/') AS full_key, 'drive/' || split_part(url, '/', -1) AS flat_key, ltrim(url, '/') AS bare_key FROM pages""",
)
def key_join(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", text.join_key("/drive/in/", url).alias("full_key"), text.join_key("drive", url, flatten=True).alias("flat_key"), text.join_key("", url).alias("bare_key")
    )


@query(
    "parse_station_filename",
    """SELECT s_suppkey, 'CO' AS region, 'GO' AS state, 'A' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS code,
              replace(upper(s_name), '#', '_') AS name, make_date(2000 + s_nationkey, 1, 1) AS "start", make_date(2000 + s_nationkey, 12, 31) AS "end" FROM supplier""",
)
def parse_station_filename(spark, sf_dir):
    """File names built from the template, then parsed back."""
    s = table(spark, sf_dir, "supplier")
    code = F.concat(F.lit("A"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0"))
    name = F.replace(F.upper("s_name"), F.lit("#"), F.lit("_"))
    path = F.concat(F.lit("files/2021/"), text.station_file_name(F.lit("CO"), F.lit("GO"), code, name, F.col("s_nationkey") + 2000))
    return s.select("s_suppkey", text.parse_station_file_name(path).alias("p")).select("s_suppkey", "p.*")


@query("quality_unique", "SELECT l_partkey AS id, count(*) AS n_records FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def quality_unique(spark, sf_dir):
    return quality.not_unique(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id")), "id")


@query(
    "quality_not_null",
    """SELECT 'id' AS "column", 'unique' AS test, 0::BIGINT AS failures, true AS passed UNION ALL
       SELECT 'id', 'not_null', (SELECT count(*) FROM orders WHERE o_orderstatus = 'P'), (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') = 0""",
)
def quality_not_null(spark, sf_dir):
    """Column tests on a model whose ids are missing for some rows: unique passes, not_null fails."""
    df = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("id"))
    return quality.test_report(df, {"id": ["unique", "not_null"]})


@query("literal_union", "SELECT o_orderkey AS id FROM orders UNION ALL SELECT NULL")
def literal_union(spark, sf_dir):
    """All ids and one row without an id."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return ids.unionAll(spark.sql("SELECT CAST(NULL AS BIGINT) AS id"))


@query("value_counts", "SELECT o_orderpriority, count(*) AS total FROM orders GROUP BY 1 ORDER BY 2 DESC, 1")
def value_counts(spark, sf_dir):
    return counts.value_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


@query(
    "sample_values",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL ORDER BY md5(CAST(c_custkey AS VARCHAR) || '42'), CAST(c_custkey AS VARCHAR) LIMIT 5",
)
def sample_values(spark, sf_dir):
    return project.sample_values(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", 5, 42, "c_custkey")


@query("variant_extract", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def variant_extract(spark, sf_dir):
    landed = to_variant(table(spark, sf_dir, "events").select("event_id", "props"), "props")
    return extract_variant(landed, "RAW_DATA", {"k": ("$.k", "int")}).select("event_id", "k")
