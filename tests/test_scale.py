"""Operators that spread work over tasks equal their plain forms."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skerry.operators import gram, ordering, statistics, windows
from skerry.plans import load_all
from skerry.plans.registry import Tables
from tests.oracle import TESTDATA
from tests.test_plans import plan


def numbers(rows, columns, seed=1):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(rows, columns)) + 1e6 * rng.integers(0, 3, columns)
    values[:, 1] = values[:, 0] * -2 + rng.normal(size=rows) * 0.1
    values[rng.random(values.shape) < 0.2] = np.nan
    values[:, 3] = 7.25  # constant
    values[:, 4] = np.nan  # nothing at all
    return pd.DataFrame(values, columns=[f"c{i}" for i in range(columns)])


@pytest.mark.parametrize(("columns", "block", "panel"), [(30, 7, 11), (45, 64, 1024), (26, 5, 26)])
def test_blocks_equal_the_pairwise_formula(spark, columns, block, panel):
    table = numbers(400, columns)
    got = gram.correlation_blocks(spark.createDataFrame(table).repartition(5), list(table.columns), block, panel).toPandas()
    assert len(got) == columns**2
    found = got.pivot(index="x", columns="y", values="r").loc[table.columns, table.columns].to_numpy(float)
    want = table.corr().to_numpy()
    want[3, :] = want[:, 3] = np.nan  # a constant has no correlation
    assert np.allclose(found, want, atol=1e-9, equal_nan=True)


def test_two_thousand_columns_in_panels(spark, tmp_path):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(80, 3))
    wide = np.stack([base[:, i % 3] * (i + 1) + base[:, (i + 1) % 3] for i in range(2000)], axis=1)
    wide[(np.arange(80)[:, None] + np.arange(2000)) % 9 == 0] = np.nan
    local = pd.DataFrame(wide, columns=[f"c{i}" for i in range(2000)])
    local.to_parquet(tmp_path / "wide.parquet")
    cells = statistics.correlation_matrix(spark.read.parquet(str(tmp_path / "wide.parquet")), list(local.columns))
    some = {(f"c{i}", f"c{j}") for i, j in [(0, 0), (0, 1999), (1999, 0), (1023, 1024), (5, 1500), (1100, 1800)]}
    seen = cells.where(F.concat_ws("|", "x", "y").isin([f"{x}|{y}" for x, y in some])).collect()
    assert {(r["x"], r["y"]) for r in seen} == some
    for r in seen:
        assert r["r"] == pytest.approx(local[r["x"]].corr(local[r["y"]]), abs=1e-9)


def test_few_columns_need_no_python(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 1.0, 5.0), (4.0, 4.0, None)], "a double, b double, c double")
    direct = {(r.x, r.y): r.r for r in statistics.correlation_matrix(df, ["a", "b", "c"]).collect()}
    blocks = {(r.x, r.y): r.r for r in gram.correlation_blocks(df, ["a", "b", "c"]).collect()}
    assert direct.keys() == blocks.keys()
    assert all(direct[k] == pytest.approx(blocks[k], abs=1e-12) for k in direct)
    assert gram.correlation_blocks(df.limit(0), ["a", "b"]).collect() == [] and gram.correlation_blocks(df, []).collect() == []


def test_one_series_uses_all_ranges(spark):
    """Ranges shorter than the frame take rows of several ranges before them."""
    rng = random.Random(3)
    rows = [(i, rng.random() if rng.random() < 0.9 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "t int, v double").repartition(4)
    plain = {r["t"]: r["v_vol"] for r in windows.rolling_volatility(df, "t", ["v"], n=30).collect()}
    for ranges in (3, 40):
        dealt = ordering.range_slices(df, [], [F.col("t")], ranges)
        held = ordering.with_halo(dealt, [], [F.col("t")], 29)
        per = {r[0]: r[1] for r in held.groupBy(ordering.RANGE).agg(F.count_if(ordering.HALO)).collect()}
        assert len(per) == ranges and max(per.values()) == 29 and per[0] == 0
    got = windows.rolling_volatility(df, "t", ["v"], n=30, ranges=True).collect()
    assert len(got) == 500 and all(r["v_vol"] == pytest.approx(plain[r["t"]]) for r in got)
    assert set(got[0].asDict()) == {"t", "v", "v_vol"}


def test_ranges_of_many_keys(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), i, rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    plain = sorted(map(tuple, windows.rolling_volatility(df, "t", ["v"], n=5, keys=["k"]).collect()), key=str)
    spread = sorted(map(tuple, windows.rolling_volatility(df, "t", ["v"], n=5, keys=["k"], ranges=True).collect()), key=str)
    assert [r[:3] for r in plain] == [r[:3] for r in spread]
    assert all(a[3] == pytest.approx(b[3]) for a, b in zip(plain, spread))


def test_residuals_in_one_pass_equal_the_two_steps(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(30), i, rng.choice([None, rng.uniform(1, 900), -1.0]), rng.choice([None, rng.uniform(0, 9)])) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, t int, x double, y double")
    args = ["k"], [F.col("t")], "x", "y"
    two = windows.residual_rank(df, statistics.log_regression(df, "x", "y"), *args)
    one = windows.residuals_in_one_pass(df, *args)
    key = lambda r: (r["k"], r["t"])
    for a, b in zip(sorted(two.collect(), key=key), sorted(one.collect(), key=key), strict=True):
        assert key(a) == key(b) and a["direction"] == b["direction"]
        assert b["residual"] == (None if a["residual"] is None else pytest.approx(a["residual"], abs=1e-9))
    assert windows.residuals_in_one_pass(df.limit(0), *args).count() == 0


@pytest.mark.parametrize(("name", "scans"), [("inputs_ready", 2), ("graph_nodes", 4)])
def test_shared_detail_is_read_once(spark, name, scans):
    text = plan(load_all()[name].build(Tables(spark, f"{TESTDATA}/sf0.001")))
    assert text.split("Initial Plan")[0].count("FileScan") == scans
