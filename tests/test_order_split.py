import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliogrid.operators import order, split


@pytest.mark.parametrize("sort_rows", [100_000, 50])
def test_quantiles_match_numpy(spark, sort_rows):
    values = np.random.default_rng(3).lognormal(size=5000)
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(values)], "v double, i long")
    qs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = order.quantiles(df, {"v": qs, "i": [0.5]}, sort_rows)
    assert got["v"] == pytest.approx(np.quantile(values, qs).tolist(), rel=1e-12)
    assert got["i"] == [2499.5]


def test_quantiles_with_a_hot_value(spark):
    values = [1.0] * 40 + [7.0] * 2000 + [float(i) for i in range(100, 200)] + [None] * 30
    df = spark.createDataFrame([(v,) for v in values], "v double")
    kept = [v for v in values if v is not None]
    qs = [0.01, 0.25, 0.5, 0.75, 0.97]
    assert order.quantiles(df, {"v": qs}, 50)["v"] == pytest.approx(np.quantile(kept, qs).tolist())
    assert order.quantiles(df.filter("v < 0"), {"v": [0.5]})["v"] == [None]
    assert order.quantiles(spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 10.0)], "v double"), {"v": [0.75]})["v"] == [4.75]


@pytest.mark.parametrize("n", [1, 4, 246, 3000])
def test_exact_split(spark, n):
    df = spark.range(n)
    marked = split.split_exact(df, "id")
    test = {r.id for r in marked.filter("is_test").collect()}
    assert len(test) == math.ceil(0.2 * n) and marked.count() == n
    assert test == {r.id for r in split.split_exact(df.repartition(7), "id").filter("is_test").collect()}


def test_split_with_narrow_prefixes(spark, monkeypatch):
    monkeypatch.setattr(split, "ROWS_PER_PREFIX", 1)
    monkeypatch.setattr(split, "BROADCAST_CUTS", 0)
    marked = split.split_exact(spark.range(777), "id")
    assert marked.filter("is_test").count() == 156


def test_stratified_split(spark):
    df = spark.range(1000).withColumn("c", F.when(F.col("id") < 2, "rare").when(F.col("id") < 400, "mid"))
    got = {r.c: (r.n, r.t) for r in split.split_stratified(df, "id", "c").groupBy("c").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert sum(t for _, t in got.values()) == 200
    assert got["rare"] == (2, 0) and got["mid"][0] == 398 and got[None][0] == 600
    assert abs(got[None][1] - 120) <= 1
    # A class with a single row: plain split.
    lone = spark.range(50).withColumn("c", F.col("id") == 0)
    assert split.split_stratified(lone, "id", "c").filter("is_test").count() == 10


@pytest.mark.parametrize("sort_rows", [100_000, 20])
def test_contiguous_folds(spark, sort_rows):
    df = spark.range(0, 1003 * 3, 3)
    folds = split.kfold_contiguous(df, "id", 5, sort_rows=sort_rows).groupBy("fold").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    rows = folds.orderBy("fold").collect()
    assert [r.n for r in rows] == [201, 201, 201, 200, 200]
    assert all(x.b < y.a for x, y in zip(rows, rows[1:]))


def test_stratified_folds(spark):
    df = spark.range(103).withColumn("c", F.col("id") % 3 == 0)
    sizes = {}
    for r in split.kfold_stratified(df, "id", "c").groupBy("c", "fold").count().collect():
        sizes.setdefault(r.c, []).append(r["count"])
    assert sorted(sizes[True]) == [7, 7, 7, 7, 7] and sorted(sizes[False]) == [13, 13, 14, 14, 14]


def test_rank_search_ends_on_large_ids(spark):
    first = 2**62
    ids = spark.range(5_000).selectExpr(f"id + {first} AS id")
    found = order.values_at(ids, {"id": [0, 1234, 4999]}, {"id": 5_000}, sort_rows=10)
    assert [pair[0] for pair in found["id"]] == [first, first + 1234, first + 4999]
