import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from heliogrid.columns import STATION_COLUMNS, canonical_name, header_to
from heliogrid.functions import dates, scale, text
from heliogrid.operators import project


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def apply(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_numbers(spark):
    df = column(spark, ["12,7", ",4", "-3,5", "", "NULL", "NaN", "abc", "1d", None, "1e3", "Infinity", " 7 "])
    assert apply(df, text.try_number(F.col("v"))) == [12.7, 0.4, -3.5, None, None, None, None, None, None, 1000.0, None, 7.0]
    assert apply(column(spark, ["12,5", "x"]), text.try_whole_number(F.col("v"))) == [13, None]
    assert apply(column(spark, ["359", "1,5"]), text.try_number(F.col("v"), "int")) == [359, 2]
    # A point as decimal mark refuses a comma.
    assert apply(column(spark, ["12,7", "12.7"]), text.try_number(F.col("v"), decimal_sep=".")) == [None, 12.7]


def test_null_tokens(spark):
    assert apply(column(spark, ["", "NULL", "NaN", "0", None]), text.null_tokens(F.col("v"))) == [None, None, None, "0", None]


def test_dates_and_times(spark):
    day = datetime.date(2021, 1, 31)
    df = column(spark, ["2021/01/31", "2021-01-31", "31/01/2021", "", None])
    assert apply(df, dates.try_date(F.col("v"))) == [day, day, None, None, None]
    df = column(spark, ["0000 UTC", "1300 UTC", "13:00", "13:05:09", "2500 UTC", "x", None])
    assert apply(df, dates.try_time(F.col("v"))) == ["00:00:00", "13:00:00", "13:00:00", "13:05:09", None, None, None]
    df = spark.createDataFrame([("2021/01/31", "1300 UTC"), ("bad", "1300 UTC"), ("2021/01/31", "bad")], "d string, h string")
    stamp = dates.observation_timestamp(dates.try_date(F.col("d")), F.col("h"))
    assert apply(df, stamp) == [datetime.datetime(2021, 1, 31, 13), None, None]


def test_years(spark):
    years = [r.year for r in dates.years_since(spark, 2001).orderBy("year").collect()]
    assert years == list(range(2001, years[-1] + 1)) and years[-1] >= 2025


def test_strict_date_stops(spark):
    with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed|DateTime"):
        column(spark, ["31/01/2021"]).select(dates.strict_date(F.col("v"))).collect()


def test_keys_and_names(spark):
    df = column(spark, ["files/2021/A (1) x.CSV", "a b/c.csv", "plain"])
    assert apply(df, text.safe_key(F.col("v"))) == ["files/2021/A_1_x.CSV", "a b/c.csv", "plain"]
    assert apply(df, text.has_special_chars(F.col("v"))) == [True, False, False]
    assert apply(df, text.join_key("/p/", F.col("v"), flatten=True)) == ["p/A (1) x.CSV", "p/c.csv", "p/plain"]
    lines = ["├── 2021", "│   ├── a.CSV", "│   └── b c.csv", "", "```", "x.txt", "└── .hidden", "└── a ── b.csv"]
    assert apply(column(spark, lines), text.tree_entry(F.col("v"))) == [None, "a.CSV", "b c.csv", None, None, "x.txt", None, "b.csv"]
    names = ["x_GO_y.CSV", "GOIAS.CSV"]
    assert apply(column(spark, names), text.has_token(F.col("v"), "GO")) == [True, False]
    assert apply(column(spark, names), text.has_token(F.col("v"), "GO", substring=True)) == [True, True]
    assert apply(column(spark, names), text.has_suffix(F.col("v"), ".csv", ignore_case=False)) == [False, False]


def test_station_file_name_round_trip(spark):
    df = spark.createDataFrame([("CO", "GO", "A002", "GOIANIA", 2024)], "r string, s string, c string, n string, y int")
    name = text.station_file_name(F.col("r"), F.col("s"), F.col("c"), F.col("n"), F.col("y"))
    assert apply(df, name) == ["INMET_CO_GO_A002_GOIANIA_01-01-2024_A_31-12-2024.CSV"]
    got = apply(df, text.parse_station_file_name(F.concat(F.lit("files/2024/"), name)))[0]
    assert (got.region, got.state, got.code, got.name, got.start, got.end) == (
        "CO", "GO", "A002", "GOIANIA", datetime.date(2024, 1, 1), datetime.date(2024, 12, 31),
    )
    assert apply(column(spark, ["other.csv"]), text.parse_station_file_name(F.col("v"))) == [None]


def test_registry():
    assert len(STATION_COLUMNS) == 19
    assert len(header_to("staging")) == 14
    assert canonical_name(" radiacao global (kj/m²) ") == "radiacao_global_kj_m2"
    assert canonical_name("RADIACAO_GLOBAL_KJ_MF") == "radiacao_global_kj_m2"
    assert canonical_name("other") is None


def test_score_on_three_rows(spark):
    df = spark.createDataFrame([(1, 0.0, 4), (2, 50.0, 0), (3, 100.0, 2)], "id int, radiacao_media_anual double, num_usinas_solares long")
    got = {r.id: round(r.potencial_score, 6) for r in scale.with_potential_score(df).collect()}
    assert got == {1: 0.0, 2: 0.764706, 3: 1.0}


def test_constant_column(spark):
    df = column(spark, [5.0, 5.0, None], "double")
    assert [r.n for r in scale.with_minmax(df, {"v": "n"}).collect()] == [0.0, 0.0, None]
    assert [r.n for r in scale.with_zscore(df, {"v": "n"}).collect()] == [0.0, 0.0, None]
    assert [r.c_bin for r in scale.with_equal_width_bin(df, "v", "c").collect()] == [2, 2, None]


def test_population_scale(spark):
    got = [round(r.z, 4) for r in scale.with_zscore(column(spark, [0.0, 1.0, 2.0, 3.0], "double"), {"v": "z"}).orderBy("v").collect()]
    assert got == [-1.3416, -0.4472, 0.4472, 1.3416]


def test_bins_agree_with_pandas(spark):
    values = [0.0, 1 / 3, 0.5, 2 / 3, 0.7, 1.0, *np.random.default_rng(1).uniform(0, 1, 50).tolist()]
    got = [r.c_bin for r in scale.with_equal_width_bin(column(spark, values, "double"), "v", "c").collect()]
    assert got[:6] == [1, 1, 2, 2, 3, 3]
    assert got == (pd.cut(pd.Series(values), 3, labels=False, include_lowest=True) + 1).tolist()


def test_fill_and_ensure(spark):
    df = spark.createDataFrame([(1, None, None)], "a int, b double, c string")
    assert project.fill_zero(df).first().asDict() == {"a": 1, "b": 0.0, "c": None}
    assert project.ensure_column(df, "x").first().x == 0.0
    assert project.ensure_column(df, "b").first().b == 0.0
