"""Scaling, score, bins, quantiles, rankings, splits and measures of error."""

from pyspark.sql import functions as F

from heliogrid.functions import scale
from heliogrid.operators import counts, metrics, order, rank, split
from heliogrid.queries.base import MART_SQL, SCORE_SQL, query, rounded, table
from heliogrid.queries.mart import build
from heliogrid.session import stage_table


def mart_table(spark, sf_dir):
    """The mart, written once: later steps read a row per municipality, not the plants."""
    return stage_table(build(spark, sf_dir), "mart")


def scored(spark, sf_dir):
    return scale.with_potential_score(mart_table(spark, sf_dir))


@query(
    "minmax_score",
    f"""WITH {SCORE_SQL} SELECT cd_mun, round(radiacao_norm, 6) AS radiacao_norm, round(usinas_solares_norm, 6) AS usinas_solares_norm,
        round(potencial_score, 6) AS potencial_score FROM score""",
)
def minmax_score(spark, sf_dir):
    return rounded(scored(spark, sf_dir).select("cd_mun", "radiacao_norm", "usinas_solares_norm", "potencial_score"), 6)


@query(
    "zscore",
    f"""WITH {MART_SQL}, s AS (SELECT avg(radiacao_media_anual) AS m1, stddev_pop(radiacao_media_anual) AS d1, avg(num_total_usinas) AS m2, stddev_pop(num_total_usinas) AS d2 FROM mart)
        SELECT cd_mun, round((radiacao_media_anual - m1) / d1, 6) AS radiacao_z, round((num_total_usinas - m2) / d2, 6) AS usinas_z FROM mart, s""",
)
def zscore(spark, sf_dir):
    df = scale.with_zscore(mart_table(spark, sf_dir), {"radiacao_media_anual": "radiacao_z", "num_total_usinas": "usinas_z"})
    return rounded(df.select("cd_mun", "radiacao_z", "usinas_z"), 6)


@query(
    "equal_width_bins",
    f"""WITH {SCORE_SQL}, e AS (SELECT min(potencial_score) AS lo, (max(potencial_score) - min(potencial_score)) / 3 AS w FROM score)
        SELECT cd_mun, 'Categoria ' || CASE WHEN potencial_score <= lo + w * 1 THEN 1 WHEN potencial_score <= lo + w * 2 THEN 2 ELSE 3 END AS potencial_category FROM score, e""",
)
def equal_width_bins(spark, sf_dir):
    df = scored(spark, sf_dir).select("cd_mun", "potencial_score")
    return scale.with_equal_width_bin(df, "potencial_score", "potencial_category").select("cd_mun", "potencial_category")


@query("quantile_p75", "SELECT round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, round(quantile_cont(l_quantity, 0.75), 4) AS q75 FROM lineitem")
def quantile_p75(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    found = order.quantiles(li, {"l_extendedprice": [0.75], "l_quantity": [0.75]})
    (p,), (q,) = found["l_extendedprice"], found["l_quantity"]
    return rounded(spark.createDataFrame([(p, q)], "p75 double, q75 double"))


@query(
    "describe_profile",
    """SELECT count(o_totalprice) AS "count", round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std, round(min(o_totalprice), 4) AS "min",
              round(quantile_cont(o_totalprice, 0.25), 4) AS q25, round(quantile_cont(o_totalprice, 0.5), 4) AS q50,
              round(quantile_cont(o_totalprice, 0.75), 4) AS q75, round(max(o_totalprice), 4) AS "max" FROM orders""",
)
def describe_profile(spark, sf_dir):
    return rounded(counts.describe(table(spark, sf_dir, "orders"), "o_totalprice"))


@query(
    "topk_score",
    f"WITH {SCORE_SQL} SELECT radiacao_media_anual, num_usinas_solares, round(potencial_score, 6) AS potencial_score FROM score ORDER BY score.potencial_score DESC, nm_mun LIMIT 5",
)
def topk_score(spark, sf_dir):
    top = rank.top_k(scored(spark, sf_dir), "potencial_score", "nm_mun", 5)
    return rounded(top.select("radiacao_media_anual", "num_usinas_solares", "potencial_score"), 6, "potencial_score")


@query(
    "ranking_topn",
    f"""WITH {SCORE_SQL} SELECT nm_mun, round(potencial_score, 6) AS potencial_score, CAST(row_number() OVER (ORDER BY score.potencial_score DESC, nm_mun) AS INTEGER) AS rank
        FROM score ORDER BY 3 LIMIT 15""",
)
def ranking_topn(spark, sf_dir):
    best = rank.ranking(scored(spark, sf_dir).select("nm_mun", "potencial_score"), "potencial_score", "nm_mun", 15)
    return rounded(best, 6)


@query(
    "synergy_zones",
    f"""WITH {SCORE_SQL}, q AS (SELECT quantile_cont(potencial_score, 0.75) AS a, quantile_cont(potencia_hidro_mw, 0.75) AS b FROM score)
        SELECT nm_mun, round(potencial_score, 6) AS potencial_score, round(potencia_hidro_mw, 6) AS potencia_hidro_mw FROM score, q
        WHERE score.potencial_score >= a AND score.potencia_hidro_mw >= b""",
)
def synergy_zones(spark, sf_dir):
    df = stage_table(scored(spark, sf_dir).select("nm_mun", "potencial_score", "potencia_hidro_mw"), "scored")
    return rounded(rank.synergy_zones(df, ["potencial_score", "potencia_hidro_mw"]), 6)


@query(
    "split_exact",
    """SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey || '-42')) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM orders""",
)
def split_exact(spark, sf_dir):
    return split.split_exact(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "split_stratified",
    """WITH c AS (SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1),
       t AS (SELECT sum(n) AS total, ceil(sum(n) * 0.2) AS test FROM c),
       f AS (SELECT p, n, floor(n * test / total) AS base, n * test - floor(n * test / total) * total AS rest, test FROM c, t),
       g AS (SELECT p, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, p) <= test - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM f)
       SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey || '-42')) <= quota AS is_test
       FROM orders JOIN g ON p = o_orderpriority""",
)
def split_stratified(spark, sf_dir):
    return split.split_stratified(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey", "o_orderpriority")


@query("kfold_assign", "SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders")
def kfold_assign(spark, sf_dir):
    return split.kfold_contiguous(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "kfold_stratified",
    "SELECT doc_id, quality, CAST(ntile(5) OVER (PARTITION BY quality ORDER BY md5(doc_id || '-42')) - 1 AS INTEGER) AS fold FROM labels",
)
def kfold_stratified(spark, sf_dir):
    return split.kfold_stratified(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "quality")


@query(
    "confusion_matrix",
    """SELECT CAST(a AS INTEGER) AS actual, CAST(p AS INTEGER) AS predicted, coalesce(n, 0) AS n FROM (SELECT unnest([0, 1, 2]) AS a), (SELECT unnest([0, 1, 2]) AS p)
       LEFT JOIN (SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2) ON quality = a AND toxic = p""",
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(table(spark, sf_dir, "labels"), "quality", "toxic", [0, 1, 2])


@query(
    "classification_report",
    """WITH l AS (SELECT unnest([0, 1, 2]) AS k),
       c AS (SELECT k, (SELECT count(*) FROM labels WHERE quality = k) AS support, (SELECT count(*) FROM labels WHERE toxic = k) AS chosen,
                    (SELECT count(*) FROM labels WHERE quality = k AND toxic = k) AS tp FROM l),
       m AS (SELECT k, support, tp, CASE WHEN chosen = 0 THEN 0 ELSE tp / chosen END AS p, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS r FROM c),
       f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM m)
       SELECT CAST(k AS VARCHAR) AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
       UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
       UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM f
       UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""",
)
def classification_report(spark, sf_dir):
    return rounded(metrics.classification_report(table(spark, sf_dir, "labels"), "quality", "toxic", [0, 1, 2]), 6)


@query(
    "regression_metrics",
    """SELECT l_returnflag, count(*) AS n, round(avg(abs(e)), 4) AS mae, round(avg(e * e), 2) AS mse, round(1 - avg(e * e) / var_pop(y), 6) AS r2
       FROM (SELECT l_returnflag, l_extendedprice AS y, l_extendedprice - l_quantity * 1000 AS e FROM lineitem) GROUP BY 1""",
)
def regression_metrics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", (F.col("l_quantity") * 1000).alias("guess"))
    df = metrics.regression_metrics(li, "l_extendedprice", "guess", "l_returnflag")
    return rounded(rounded(rounded(df, 4, "mae"), 2, "mse"), 6, "r2")
