"""Shapes of the physical plans that matter at scale."""

import re

import pytest

from heliogrid import session
from heliogrid.plans import energy
from heliogrid.queries import QUERIES, places
from tests.conftest import SF


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["spatial_within", "nearest_station", "plant_mart", "split_exact", "split_stratified", "kfold_assign", "minmax_score", "synergy_zones", "tag_station", "listing_match", "confusion_matrix"])
def test_no_pairing_joins(spark, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoop", plan(spark, name))


@pytest.mark.parametrize("name", ["split_exact", "kfold_assign", "minmax_score", "zscore", "equal_width_bins", "scan_station_typed"])
def test_applied_without_shuffle(spark, name):
    text = plan(spark, name)
    assert "Exchange" not in text and "Sort" not in text


def test_large_sides_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("spatial_within", "nearest_station", "tag_station"):
            assert "BroadcastHashJoin" not in plan(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stations_are_not_broadcast_by_the_size_of_their_file(spark, monkeypatch):
    stored, plans = energy.stage_table, {}

    def store(df, label="stage"):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, label)

    monkeypatch.setattr(energy, "stage_table", store)
    places.energy(spark, SF)
    assert "SortMergeJoin [s_suppkey" in plans["stations"] and "BroadcastHashJoin" not in plans["stations"]
    assert re.search(r"SortMergeJoin \[s_suppkey", plans["energy"]) and not re.search(r"BroadcastHashJoin \[s_suppkey", plans["energy"])


def test_columns_and_filters_reach_the_scan(spark):
    text = plan(spark, "monthly_season")
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in text
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan(spark, "filter_date_range")


def test_plant_measures_take_one_shuffle(spark):
    assert plan(spark, "plant_mart").count("Exchange hashpartitioning") == 1
