"""Shape of the plans: pushed filters, pruned columns, no hidden products, no Python in the hot path."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from skerry.operators import quality as q, windows
from skerry.plans import load_all
from skerry.plans.registry import Tables
from tests.oracle import TESTDATA

REGISTRY = load_all()
SF_DIR = f"{TESTDATA}/sf0.001"
BATCH = [n for n, x in REGISTRY.items() if not x.build.__module__.endswith(".streams")]
# These number bins, months, nations, years or slices: tables that do not grow with the rows.
SMALL_ORDERED = {
    "b_value", "magnitude_counts", "seasonal_anomaly", "log_returns", "rolling_volatility", "latest_volatility", "rank_by",
    "sequence_keys", "sequence_keys_sliced", "rolling_volatility_ranges", "sigma_events", "largest_events", "build_dimension", "build_fact",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF_DIR)


@pytest.mark.parametrize("name", BATCH)
def test_no_products_no_python(tables, name):
    text = plan(REGISTRY[name].build(tables))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in text
    lines = text.splitlines()
    alone = any(
        re.search(r"\bWindow \[", line) and "SinglePartition" in " ".join(lines[i + 1:i + 6]) for i, line in enumerate(lines)
    )
    assert not alone or name in SMALL_ORDERED


def test_slot_filter_reaches_the_scan(tables):
    text = plan(REGISTRY["filter_slot"].build(tables))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_scans_read_only_used_columns(tables):
    text = plan(REGISTRY["summarize_by"].build(tables))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in text


def test_checks_of_a_table_share_one_scan(tables):
    df = tables.lineitem
    checks = [q.bounds_check(df, "l_quantity", 0, 50), q.nulls_check(df, ["l_tax"], 1), q.row_count_check(1, 10**12)]
    assert plan(q.run_checks(df, checks)).count("FileScan") == 1


def test_bursts_cut_rows_before_the_shuffle(tables):
    text = plan(windows.burst_clusters(tables.events, ["event_type"], "ts"))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_top_k_does_not_sort_everything(tables):
    assert "TakeOrderedAndProject" in plan(REGISTRY["largest_events"].build(tables))


def test_latest_row_is_reduced_on_the_map_side(tables):
    out = windows.row_number_latest(tables.orders, ["o_custkey"], [F.col("o_orderdate")])
    assert "partial_max_by" in plan(out)


def test_partition_filter_is_used(spark, tmp_path):
    from skerry.sources.files import overwrite_partitions

    path = str(tmp_path / "t")
    overwrite_partitions(spark.range(10).withColumn("slot", F.col("id") % 3), path, "slot")
    text = plan(spark.read.parquet(path).filter(F.col("slot").isin([1])))
    assert re.search(r"PartitionFilters: \[.*slot.*\]", text)
