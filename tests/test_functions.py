"""Literal cases for the column functions."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from skerry import functions as fn
from skerry.plans.rows import AIR_BANDS, RISK_BANDS, WIND_BANDS


def over(spark, values, expr, kind="double"):
    """Values of an expression over a column `v`, in order."""
    rows = [(i, float(v) if kind == "double" and v is not None else v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.select(expr.alias("out"), "i").orderBy("i").select("out").collect()]


def test_air_bands(spark):
    got = over(spark, [0, 10, 20, 30, 40, 50, 70, 90, 150], fn.ladder(F.col("v"), AIR_BANDS, "Extremely Poor"))
    assert got == ["Good"] * 3 + ["Fair"] * 2 + ["Moderate", "Poor", "Very Poor", "Extremely Poor"]


def test_risk_bands(spark):
    got = over(spark, [0, 10, 25, 30, 60, 80], fn.ladder(F.col("v"), RISK_BANDS, "Extreme"))
    assert got == ["Low", "Low", "Low", "Moderate", "High", "Extreme"]


def test_wind_bands_and_missing(spark):
    got = over(spark, [0.5, 1.0, 22.0, None, math.nan], fn.ladder(F.col("v"), WIND_BANDS, "storm", closed="lower"))
    assert got == ["calm", "light", "storm", None, None]


def test_ladder_rejects_unknown_side(spark):
    with pytest.raises(ValueError):
        fn.ladder(F.col("v"), RISK_BANDS, "x", closed="left")


def test_exceeds(spark):
    limits = {"pm2_5": 15.0, "pm10": 45.0, "nitrogen_dioxide": 25.0}
    rows = [("pm2_5", 20.0), ("pm2_5", 10.0), ("pm10", 45.0), ("unknown", 100.0), ("nitrogen_dioxide", 30.0), ("pm10", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = [r[0] for r in df.select(fn.exceeds(F.col("k"), F.col("v"), limits)).collect()]
    assert got == [True, False, False, False, True, False]


def test_score_steps(spark):
    assert over(spark, [0, 0.5, 1.5, 3, 5, 8, None], fn.score_steps(F.col("v"))) == [0, 0, 25, 50, 75, 100, 0]


def test_score_ratio(spark):
    df = spark.createDataFrame(
        [(100.0, 100.0), (140.0, 100.0), (150.0, 100.0), (200.0, 100.0), (400.0, 100.0), (100.0, 0.0), (100.0, None)],
        "a double, b double",
    )
    got = [r[0] for r in df.select(fn.score_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0, 0, 50, 50, 100, 0, 0]


def test_units(spark):
    assert over(spark, [0.0, 100.0], fn.convert_units(F.col("v"), "C", "F")) == [32.0, 212.0]
    assert over(spark, [32.0, 212.0], fn.convert_units(F.col("v"), "F", "C")) == [0.0, 100.0]
    assert over(spark, [1.26], fn.convert_units(F.col("v"), "C", "C")) == [1.3]


def test_bins_close_on_the_declared_side(spark):
    edges, labels = (0, 10, 20), ("a", "b")
    assert over(spark, [0, 10, 20, 21], fn.band_label(F.col("v"), edges, labels)) == [None, "a", "b", None]
    assert over(spark, [0, 10, 20, 21], fn.band_label(F.col("v"), edges, labels, right=False)) == ["a", "b", None, None]


def test_to_number(spark):
    texts = ["1.5", " 7 ", "1e3", "-inf", "12d", "1f", "nan", "abc", "", None]
    got = over(spark, texts, fn.to_number(F.col("v")), "string")
    assert got == [1.5, 7.0, 1000.0, -math.inf, None, None, None, None, None, None]


def test_hash_key(spark):
    keys = over(spark, ["NOR", "NOR", "SWE", ""], fn.hash_key(F.col("v")), "string")
    assert keys[0] == keys[1] == 27236
    assert keys[0] != keys[2]
    assert all(0 <= k < 100_000 for k in keys)


def test_operands_and_complexity(spark):
    texts = ["#{a}+#{b}*2", "no operands", None]
    assert over(spark, texts, fn.count_pattern(F.col("v"), r"#\{[^}]+\}"), "string") == [2, 0, 0]
    assert over(spark, texts, fn.expression_complexity([F.col("v"), F.lit(None).cast("string")]), "string") == [4, 0, 0]


def test_path_depth(spark):
    assert over(spark, ["/a/b/c", "/a", None], fn.path_depth(F.col("v")), "string") == [2, 0, 0]


def test_arrays(spark):
    arrays = [[1, 2], [], None]
    assert over(spark, arrays, fn.array_length(F.col("v")), "array<int>") == [2, 0, 0]
    assert over(spark, arrays, fn.array_item(F.col("v"), 1, -1), "array<int>") == [2, -1, -1]


def test_row_mean_skips_missing(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (math.nan, 4.0, 2.0)], "a double, b double, c double")
    got = [r[0] for r in df.select(fn.row_mean([F.col("a"), F.col("b"), F.col("c")], 1)).collect()]
    assert got == [2.0, None, 3.0]


def test_traffic_light(spark):
    df = spark.createDataFrame([(3, 3), (1, 3), (0, 3), (2, 4), (1, 4)], "p int, t int")
    got = [r[0] for r in df.select(fn.traffic_light(F.col("p"), F.col("t"))).collect()]
    assert got == ["GREEN", "YELLOW", "RED", "YELLOW", "RED"]


def test_nested_field_of_something_else(spark):
    texts = ['{"id": "x"}', '"just text"', "[1]", "not json", None]
    assert over(spark, texts, fn.nested_field(F.col("v"), "$.id"), "string") == ["x", None, None, None, None]


def test_flatten_columns(spark):
    df = spark.sql("SELECT named_struct('id', 1, 'at', named_struct('lat', 2.0D, 'lon', 3.0D)) AS station, 'x' AS kind")
    flat = df.select(fn.flatten_columns(df.schema))
    assert flat.columns == ["station_id", "station_at_lat", "station_at_lon", "kind"]
