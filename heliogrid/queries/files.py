"""Catalogs, listings, keys and archives, with names and bodies taken from the tables."""

import io
import zipfile

from pyspark.sql import functions as F

from heliogrid.functions import text
from heliogrid.queries.base import once, query, rounded, table
from heliogrid.sources import catalog, registry
from heliogrid.sources.station import year_paths

PART_PATH_SQL = """'files/' || p_brand || '/' || CASE p_type WHEN 'ECONOMY' THEN p_partkey || '.CSV'
    WHEN 'SMALL' THEN p_name || '_(' || p_size || ').csv' ELSE p_name || ' (' || p_size || ').csv' END"""
KEY_SQL = "regexp_replace(path, '[^/]*$', '') || replace(replace(replace(split_part(path, '/', -1), ' ', '_'), '(', ''), ')', '')"
FILES_SQL = """(SELECT 'drive/q' || quality || '/doc ' || doc_id || '.txt' AS path FROM labels
    UNION ALL SELECT 'drive/t' || toxic || '/doc ' || doc_id || '.txt' FROM labels)"""


def part_paths(spark, sf_dir):
    size = F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit(").csv"))
    base = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.col("p_partkey").cast("string"), F.lit(".CSV")))
        .when(F.col("p_type") == "SMALL", F.concat_ws("_", "p_name", size))
        .otherwise(F.concat_ws(" ", "p_name", size))
    )
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.concat_ws("/", F.lit("files"), "p_brand", base).alias("path"))


def label_files(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    name = F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(".txt"))
    folders = F.explode(F.array(F.concat(F.lit("q"), F.col("quality")), F.concat(F.lit("t"), F.col("toxic"))))
    return labels.select(folders.alias("folder"), name.alias("name")).select(F.concat_ws("/", F.lit("drive"), "folder", "name").alias("path"))


def tree_lines(spark, sf_dir):
    """A tree listing: a folder line and a file line (with a no-break space) per document."""
    docs = table(spark, sf_dir, "documents")
    lines = F.array(
        F.concat(F.lit("├── "), "lang"), F.concat(F.lit("│   ├── doc "), F.col("doc_id").cast("string"), F.lit(".txt")), F.lit("")
    )
    return docs.select(F.explode(lines).alias("value"))


@query("tree_listing", "SELECT 'doc ' || doc_id || '.txt' AS name FROM documents")
def tree_listing(spark, sf_dir):
    return catalog.tree_files(tree_lines(spark, sf_dir))


@query(
    "listing_match",
    f"SELECT name, CAST(n AS BIGINT) AS n_matches, path FROM (SELECT split_part(path, '/', -1) AS name, path, count(*) OVER (PARTITION BY split_part(path, '/', -1)) AS n FROM {FILES_SQL}) WHERE name IN (SELECT 'doc ' || doc_id || '.txt' FROM documents)",
)
def listing_match(spark, sf_dir):
    return catalog.match_listing(catalog.tree_files(tree_lines(spark, sf_dir)), label_files(spark, sf_dir))


@query("listing_missing", "SELECT 'doc ' || doc_id || '.txt' AS name FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def listing_missing(spark, sf_dir):
    return catalog.missing_from(catalog.tree_files(tree_lines(spark, sf_dir)), label_files(spark, sf_dir))


@query(
    "key_normalize",
    f"""SELECT p_partkey, path, new_key, CASE WHEN NOT regexp_matches(split_part(path, '/', -1), '[ ()]') THEN 'skipped'
               WHEN n > 1 THEN 'collision' ELSE 'renamed' END AS status
        FROM (SELECT p_partkey, path, {KEY_SQL} AS new_key FROM (SELECT p_partkey, {PART_PATH_SQL} AS path FROM part))
        JOIN (SELECT k, count(DISTINCT path) AS n FROM (SELECT path, {KEY_SQL} AS k FROM (SELECT {PART_PATH_SQL} AS path FROM part)) GROUP BY k) ON k = new_key""",
)
def key_normalize(spark, sf_dir):
    return catalog.key_changes(part_paths(spark, sf_dir)).select("p_partkey", "path", "new_key", "status")


@query(
    "outcome_counters",
    f"""WITH t AS (SELECT p_brand, path, {KEY_SQL} AS k FROM (SELECT p_brand, {PART_PATH_SQL} AS path FROM part)),
        n AS (SELECT k, count(DISTINCT path) AS n FROM t GROUP BY k),
        s AS (SELECT p_brand, CASE WHEN NOT regexp_matches(split_part(path, '/', -1), '[ ()]') THEN 'skipped' WHEN n > 1 THEN 'collision' ELSE 'renamed' END AS status FROM t JOIN n USING (k))
        SELECT p_brand, count(*) FILTER (WHERE status = 'renamed') AS renamed, count(*) FILTER (WHERE status = 'skipped') AS skipped,
               count(*) FILTER (WHERE status = 'collision') AS collision FROM s GROUP BY 1""",
)
def outcome_counters(spark, sf_dir):
    return catalog.outcome_counters(catalog.key_changes(part_paths(spark, sf_dir)), "p_brand")


@query(
    "filter_filename",
    f"SELECT p_partkey, path FROM (SELECT p_partkey, {PART_PATH_SQL} AS path FROM part) WHERE contains(split_part(path, '/', -1), '_(1') AND lower(path) LIKE '%.csv'",
)
def filter_filename(spark, sf_dir):
    kept = catalog.filter_files(part_paths(spark, sf_dir), "_(1", ".csv", substring=True)
    return kept.select("p_partkey", "path")


@query("catalog_totals", "SELECT source AS folder, count(*) AS objects, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents GROUP BY 1")
def catalog_totals(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("folder"), F.col("n_chars").alias("length"))
    return catalog.catalog_totals(docs, "folder")


def conversation_files(spark, sf_dir):
    """Conversation turns as text files in one folder per role."""

    def write(path):
        turns = table(spark, sf_dir, "conversations").select("text", "role")
        turns.write.partitionBy("role").text(path)

    return once(spark, sf_dir, "conversation-files", write)


@query("file_catalog", "SELECT 'role=' || role AS folder, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM conversations GROUP BY 1")
def file_catalog(spark, sf_dir):
    files = catalog.file_catalog(spark, conversation_files(spark, sf_dir), "*.txt")
    return catalog.catalog_totals(files, F.regexp_extract("path", r"/(role=[^/]+)/", 1).alias("folder")).drop("objects")


@query(
    "file_metrics",
    """SELECT 'role=' || role AS folder, CAST(sum(strlen(text) + 1) AS BIGINT) AS size_bytes,
              CAST(sum(1 + length(text) - length(replace(text, chr(10), ''))) AS BIGINT) AS n_lines FROM conversations GROUP BY 1""",
)
def file_metrics(spark, sf_dir):
    files = catalog.file_metrics(spark, conversation_files(spark, sf_dir))
    folder = F.regexp_extract("path", r"/(role=[^/]+)/", 1).alias("folder")
    return files.groupBy(folder).agg(F.sum("size_bytes").alias("size_bytes"), F.sum("n_lines").alias("n_lines"))


@query(
    "path_template",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, round(sum(o_totalprice), 4) AS total FROM orders GROUP BY 1",
)
def path_template(spark, sf_dir):
    """Year folders written once, then all years read in a single scan of templated paths."""

    def write(path):
        orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
        orders.hint("rebalance", "year").write.partitionBy("year").parquet(path)

    base = once(spark, sf_dir, "orders-by-year", write)
    low, high = table(spark, sf_dir, "orders").agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
    years = year_paths(base + "/year={year}", range(low, high + 1))
    rows = spark.read.option("basePath", base).parquet(*years)
    return rounded(rows.groupBy(F.col("year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")))


def archives(spark, sf_dir):
    """One archive per document: a folder entry, the text, and a CSV of its length."""

    # Row by row: Spark hands over a hundred rows at a time then, whatever the size of the texts; Arrow, ten thousand.
    @F.udf(returnType="binary", useArrow=False)
    def pack(doc_id, body):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("2024/", b"")
            archive.writestr(f"2024/doc_{doc_id}.txt", body.encode("utf-8"))
            archive.writestr(f"2024/doc_{doc_id}.CSV", f"n;{len(body)}".encode("latin-1"))
        return buffer.getvalue()

    # Spread first: packing is slow, and archives in a folder would be read by many tasks as well.
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")
    return docs.select("doc_id", pack("doc_id", "text").alias("content"))


@query(
    "zip_entries",
    """SELECT doc_id, '2024/doc_' || doc_id || '.txt' AS entry, CAST(strlen(text) AS BIGINT) AS size, text AS body FROM documents
       UNION ALL SELECT doc_id, '2024/doc_' || doc_id || '.CSV', CAST(length('n;' || length(text)) AS BIGINT), 'n;' || length(text) FROM documents""",
)
def zip_entries(spark, sf_dir):
    rows = catalog.zip_entries(archives(spark, sf_dir))
    return rows.select("doc_id", "entry", "size", F.decode("body", "UTF-8").alias("body"))


@query("zip_entries_csv", "SELECT doc_id, '2024/doc_' || doc_id || '.CSV' AS entry, 'n;' || length(text) AS body FROM documents")
def zip_entries_csv(spark, sf_dir):
    rows = catalog.zip_entries(archives(spark, sf_dir), suffix=".csv")
    return rows.select("doc_id", "entry", text.latin1(F.col("body")).alias("body"))


@query(
    "scan_plants",
    """SELECT c_custkey AS id, -(c_custkey % 40) - 0.5::DOUBLE AS latitude, c_custkey % 50 + 0.25::DOUBLE AS longitude, CAST(c_acctbal AS DECIMAL(18,2))::DOUBLE AS potencia_kw
       FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_acctbal > 0 AND c_nationkey <> 7""",
)
def scan_plants(spark, sf_dir):
    """A registry file with other states, phases and unusable coordinates; operating plants are kept."""

    def write(path):
        c = table(spark, sf_dir, "customer")
        key = F.col("c_custkey")
        lat = F.when(F.col("c_nationkey") == 7, F.lit("sem dado")).otherwise(F.concat(F.lit("-"), (key % 40).cast("string"), F.lit(",5")))
        c.select(
            key.alias("IdeNucleoCEG"),
            F.when(F.col("c_mktsegment") == "BUILDING", "MT").otherwise("GO").alias("SigUFPrincipal"),
            F.when(F.col("c_acctbal") > 0, "Operação").otherwise("Construção").alias("DscFaseUsina"),
            F.lit("UFV").alias("SigTipoGeracao"),
            lat.alias("NumCoordNEmpreendimento"),
            F.concat((key % 50).cast("string"), F.lit(",25")).alias("NumCoordEEmpreendimento"),
            F.replace(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")).alias("MdaPotenciaFiscalizadaKw"),
        ).write.options(header="true", sep=";", encoding="ISO-8859-1").csv(path)

    rows = registry.operating_plants(registry.scan_plants(spark, once(spark, sf_dir, "plants", write)))
    return rows.select(F.col("IdeNucleoCEG").cast("long").alias("id"), "latitude", "longitude", "potencia_kw")
