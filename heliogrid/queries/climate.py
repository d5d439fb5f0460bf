"""Counts, means and dates over the observation tables."""

from pyspark.sql import functions as F

from heliogrid.functions import dates
from heliogrid.operators import counts, mart
from heliogrid.queries.base import query, rounded, table
from heliogrid.sources.tables import Models, read_table


@query(
    "monthly_season",
    """SELECT CAST(month(l_shipdate) AS INTEGER) AS mes, round(avg(l_extendedprice), 4) AS radiacao_media,
              round(sum(l_quantity), 4) AS chuva_total FROM lineitem GROUP BY 1""",
)
def monthly_season(spark, sf_dir):
    return rounded(mart.monthly_season(table(spark, sf_dir, "lineitem"), "l_shipdate", "l_extendedprice", "l_quantity"))


@query("station_mean", "SELECT l_suppkey, round(avg(l_extendedprice), 4) AS radiacao_media_anual FROM lineitem GROUP BY 1")
def station_mean(spark, sf_dir):
    return rounded(mart.station_mean(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice"))


@query(
    "station_mean_join",
    """SELECT s_suppkey, s_name, l_suppkey, round(m, 4) AS radiacao_media_anual FROM supplier
       LEFT JOIN (SELECT l_suppkey, avg(l_extendedprice) AS m FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey""",
)
def station_mean_join(spark, sf_dir):
    means = mart.station_mean(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice")
    stations = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return rounded(mart.station_mean_join(stations, means, "s_suppkey", "l_suppkey"))


@query("count_by_day", "SELECT CAST(o_orderdate AS DATE) AS dia, count(*) AS total_registros FROM orders GROUP BY 1")
def count_by_day(spark, sf_dir):
    return counts.count_by(table(spark, sf_dir, "orders"), F.col("o_orderdate").cast("date"), "dia")


@query("count_by_year", "SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS total_registros FROM orders GROUP BY 1 ORDER BY 1")
def count_by_year(spark, sf_dir):
    """The date arrives as text and is parsed strictly."""
    orders = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy/MM/dd").alias("Data"))
    return counts.count_by(orders, F.year(dates.strict_date(F.col("Data"))), "ano").orderBy("ano")


@query("count_by_month", "SELECT strftime(o_orderdate, '%Y-%m') AS mes, count(*) AS total FROM orders GROUP BY 1 ORDER BY 1")
def count_by_month(spark, sf_dir):
    return counts.count_by(table(spark, sf_dir, "orders"), dates.month_label(F.col("o_orderdate")), "mes", "total").orderBy("mes")


@query(
    "rollup_year_month",
    """SELECT ano, mes, count(*) AS total_registros FROM
       (SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, strftime(o_orderdate, '%Y/%m') AS mes FROM orders) GROUP BY ROLLUP (ano, mes)""",
)
def rollup_year_month(spark, sf_dir):
    return counts.rollup_year_month(table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "union_year_month",
    """SELECT CAST(year(o_orderdate) AS VARCHAR) AS periodo, count(*) AS total_registros FROM orders GROUP BY 1
       UNION ALL SELECT strftime(o_orderdate, '%Y/%m'), count(*) FROM orders GROUP BY 1 ORDER BY 1""",
)
def union_year_month(spark, sf_dir):
    return counts.union_year_month(table(spark, sf_dir, "orders"), "o_orderdate").orderBy("periodo")


@query(
    "month_extract",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes FROM orders",
)
def month_extract(spark, sf_dir):
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.year(d).alias("ano"), F.month(d).alias("mes"))


@query(
    "date_to_text",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y/%m') AS year_slash_month, strftime(o_orderdate, '%Y') AS year_text,
              strftime(o_orderdate, '%Y-%m') AS year_dash_month, strftime(o_orderdate, '%Y-%m-%d') AS day_text,
              strftime(o_orderdate, '%m') AS month_two FROM orders""",
)
def date_to_text(spark, sf_dir):
    d = F.col("o_orderdate")
    layouts = {"year_slash_month": "yyyy/MM", "year_text": "yyyy", "year_dash_month": "yyyy-MM", "day_text": "yyyy-MM-dd"}
    cols = [dates.month_label(d, p).alias(n) for n, p in layouts.items()]
    return table(spark, sf_dir, "orders").select("o_orderkey", *cols, dates.two_digit_month(d).alias("month_two"))


@query(
    "year_series",
    """SELECT ano, coalesce(n, 0) AS total_registros FROM
       (SELECT CAST(unnest(range(lo - 1, hi + 2)) AS INTEGER) AS ano
        FROM (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders))
       LEFT JOIN (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1) ON y = ano""",
)
def year_series(spark, sf_dir):
    """All years from one before the first to one after the last, with their counts."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"))
    series = dates.year_series(years, F.min("y") - 1, F.max("y") + 1, "ano")
    found = counts.count_by(years, F.col("y"), "ano")
    return series.join(found, "ano", "left").select("ano", F.coalesce("total_registros", F.lit(0)).alias("total_registros"))


@query("table_count", "SELECT count(*) AS total FROM lineitem")
def table_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("total"))


@query("filter_date_range", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01'")
def filter_date_range(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return read_table(orders, F.col("o_orderdate") > F.lit("1997-01-01").cast("timestamp_ntz")).select("o_orderkey", "o_totalprice")


@query(
    "table_scan_limit",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders
       WHERE o_orderdate > TIMESTAMP '1997-01-01' ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
)
def table_scan_limit(spark, sf_dir):
    """The preview read: a filter, an order and 100 rows."""
    rows = read_table(
        table(spark, sf_dir, "orders"),
        F.col("o_orderdate") > F.lit("1997-01-01").cast("timestamp_ntz"),
        [F.desc("o_totalprice"), F.asc("o_orderkey")],
        100,
    )
    return rows.select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice")


@query("model_ref", "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F'")
def model_ref(spark, sf_dir):
    """A model that reads another model by name and keeps one value."""
    models = Models(spark)
    models.source("raw_orders", table(spark, sf_dir, "orders"))

    @models.model("first")
    def first(m):
        return m.ref("raw_orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))

    @models.model("second")
    def second(m):
        return m.ref("first").filter(F.col("status") == "F")

    return models.ref("second")
