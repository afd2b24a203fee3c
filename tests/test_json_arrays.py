"""One JSON array per file, read by several tasks, and stages that count themselves."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from skerry.operators import quality as q, warehouse
from skerry.sources.json_arrays import json_elements, scan_json_arrays
from skerry.streaming import events as ev
from skerry.streaming.runner import run_rows
from tests.test_streaming import EVENTS, events, land

SCHEMA = "id bigint, text string, deep struct<list: array<struct<v: string>>, more: struct<x: int>>"
TEXTS = ["plain", "a } b", '{"in": [1]}', 'say "yes"', "back\\slash", "ends \\", '\\"', "}}]]", "[{", "é 漢 🙂", "two\nlines", "", '"}', None]


def element(rng, i):
    return {"id": i, "text": rng.choice(TEXTS), "deep": {"list": [{"v": rng.choice(TEXTS)} for _ in range(rng.randint(0, 3))], "more": {"x": i % 7}}}


def flat(r):
    return r["id"], r["text"], [v["v"] for v in r["deep"]["list"]], r["deep"]["more"]["x"]


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize(("seed", "indent"), [(1, None), (2, 2)])
def test_arrays_over_many_blocks(spark, tmp_path, small_blocks, seed, indent):
    rng, want = random.Random(seed), []
    for name in "ab":
        rows = [element(rng, i) for i in range(40)]
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=seed == 1))
        want += map(flat, rows)
    out = scan_json_arrays(spark, str(tmp_path), SCHEMA)
    assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 10
    assert sorted(map(flat, out.collect()), key=str) == sorted(want, key=str)


def test_odd_files(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text(" [ ]\n")
    (tmp_path / "object.json").write_text('{"id": 9}')
    (tmp_path / "cut.json").write_text('[{"id": 1}, {"id": 2, "text": "x}')
    (tmp_path / "mixed.json").write_text('[5, "}", {"id": 3}, null, {"id": 4, "other": {}}]')
    got = json_elements(spark, str(tmp_path)).select("place", "value").collect()
    assert sorted((r["place"], json.loads(r["value"])["id"]) for r in got) == [(0, 1), (0, 3), (1, 4)]


def test_stages_count_themselves(spark, tmp_path):
    audit = warehouse.ObservedStages(spark, "2")
    for name, n in (("a", 10), ("b", 0)):
        with audit.stage(name):
            audit.watch(name, spark.range(n), **{f"{name}_even": F.count_if(F.col("id") % 2 == 0)}).write.parquet(str(tmp_path / name))
    row = audit.trail().drop("recorded_at").first().asDict()
    assert row == {"a_rows": 10, "a_even": 5, "b_rows": 0, "b_even": 0, "schema_version": "2"}
    limits = spark.createDataFrame([("a", 0.0), ("b", 1e6)], "task string, limit_s double")
    found = {r["task"]: (r["rows"], r["status"]) for r in q.sla_breaches(audit.runs(), "task", "duration", limits).collect()}
    assert found == {"a": (10, "BREACH"), "b": (0, "OK")}


def test_batches_of_a_stream_are_runs(spark, tmp_path):
    land(events(spark, ("2024-01-01 10:00:00", "a", 1.0), ("2024-01-01 11:00:00", "b", 1.0)), tmp_path / "in")
    stream = ev.read_stream(spark, str(tmp_path / "in"), EVENTS)
    reports = ev.stream_window_counts(stream, "ts", "1 hour", ["k"], "v", str(tmp_path / "out"), str(tmp_path / "state"))
    (run,) = run_rows(spark, "windows", reports).collect()
    assert run["task"] == "windows" and run["rows"] == 2 and run["duration"] > 0
