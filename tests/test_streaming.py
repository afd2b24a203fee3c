"""Streams equal batches, also across restarts and replays."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skerry.operators import quality as q, windows
from skerry.operators.rows import numeric_fault
from skerry.streaming import events as ev, landing as ld
from skerry.workspace import scratch

SCHEMA = "k long, v string"


def land(df, path, **options):
    df.coalesce(1).write.mode("append").options(**options).csv(str(path)) if options else df.coalesce(1).write.mode("append").parquet(str(path))


def replay_last_batch(checkpoint):
    """As if the driver died after the sink wrote and before the batch was committed."""
    last = max((p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    crc = last.with_name(f".{last.name}.crc")
    if crc.exists():
        crc.unlink()


def test_only_new_files_are_read(spark, tmp_path):
    landing, out, state = (tmp_path / n for n in ("landing", "out", "state"))

    def run():
        ld.stream_new_files(spark, str(landing), SCHEMA, "parquet", str(out), str(state))
        return spark.read.parquet(str(out))

    land(spark.sql("SELECT 1L AS k, 'a' AS v"), landing)
    assert run().count() == 1
    assert run().count() == 1
    land(spark.sql("SELECT 2L AS k, 'b' AS v UNION ALL SELECT 3, 'c'"), landing)
    got = run()
    assert got.count() == 3
    assert sorted(r.rows for r in ld.file_counts(got).collect()) == [1, 2]


def test_replayed_batch_doubles_nothing(spark, tmp_path):
    landing, out, state = tmp_path / "landing", str(tmp_path / "out"), tmp_path / "state"
    land(spark.sql("SELECT '1' AS k, '5' AS v UNION ALL SELECT '2', 'word'"), landing, header="true")

    def run():
        ld.stream_quarantine(spark, str(landing), out, str(state), ["k", "v"], ["k", "v"], {"not numeric": numeric_fault("v")})
        return [spark.read.parquet(f"{out}/{n}").count() for n in ("clean", "rejected", "dead_letters")]

    assert run() == [1, 1, 0]
    replay_last_batch(state)
    assert run() == [1, 1, 0]


def test_replayed_upsert_changes_nothing(spark, tmp_path):
    landing, out, state = tmp_path / "landing", str(tmp_path / "out"), tmp_path / "state"
    schema = "k long, v string, n int, part int"

    def run():
        stream = ev.read_stream(spark, str(landing), schema)
        ev.stream_upsert(stream, out, str(state), ["k"], "part", [F.col("n")])
        return sorted((r.k, r.v) for r in spark.read.parquet(out).collect())

    land(spark.sql("SELECT 1L AS k, 'a' AS v, 1 AS n, 0 AS part UNION ALL SELECT 2, 'b', 1, 1"), landing)
    assert run() == [(1, "a"), (2, "b")]
    land(spark.sql("SELECT 2L AS k, 'c' AS v, 2 AS n, 1 AS part"), landing)
    assert run() == [(1, "a"), (2, "c")]
    replay_last_batch(state)
    assert run() == [(1, "a"), (2, "c")]


EVENTS = "ts timestamp, k string, v double"


def events(spark, *items):
    return spark.createDataFrame(list(items), "t string, k string, v double").select(F.col("t").cast("timestamp").alias("ts"), "k", "v")


def test_late_rows_count(spark, tmp_path):
    landing, out, state = tmp_path / "landing", str(tmp_path / "out"), tmp_path / "state"
    deliveries = [
        (("2024-01-03 10:00:00", "a", 5.0), ("2024-01-03 10:05:00", None, None)),
        (("2024-01-01 10:10:00", "a", 1.0), ("2024-01-01 10:50:00", "a", 3.0)),
        (("2024-01-01 10:30:00", "a", 11.0), ("2024-01-03 10:30:00", "a", 7.0), ("2024-01-03 10:45:00", None, 2.0)),
    ]

    def run():
        ev.stream_window_counts(ev.read_stream(spark, str(landing), EVENTS), "ts", "1 hour", ["k"], "v", out, str(state))
        return sorted(((str(r.window_start), r.k, r.n, r.mean) for r in spark.read.parquet(out).collect()), key=str)

    want = [("2024-01-01 10:00:00", "a", 3, 5.0), ("2024-01-03 10:00:00", "a", 2, 6.0), ("2024-01-03 10:00:00", None, 2, 2.0)]
    for rows in deliveries:
        land(events(spark, *rows), landing)
        got = run()
    assert got == want
    replay_last_batch(state)
    assert run() == want


def test_first_arrivals_in_reverse_time_order(spark, tmp_path):
    landing, out, state = tmp_path / "landing", str(tmp_path / "out"), tmp_path / "state"

    def run():
        ev.stream_dedupe(ev.read_stream(spark, str(landing), EVENTS), "ts", ["k"], out, str(state))
        return sorted(((r.k, r.v) for r in spark.read.parquet(out).collect()), key=str)

    land(events(spark, ("2024-03-01 10:00:00", "a", 1.0), ("2024-03-01 09:00:00", "a", 2.0), ("2024-03-01 10:00:00", None, 3.0)), landing)
    assert run() == [("a", 2.0), (None, 3.0)]
    land(events(spark, ("2024-01-01 10:00:00", "b", 4.0), ("2024-01-01 10:00:00", "a", 5.0), ("2024-01-01 10:00:00", None, 6.0)), landing)
    assert run() == [("a", 2.0), ("b", 4.0), (None, 3.0)]
    replay_last_batch(state)
    assert run() == [("a", 2.0), ("b", 4.0), (None, 3.0)]


def test_alerts_follow_late_events(spark, tmp_path):
    landing, root, state = tmp_path / "landing", str(tmp_path / "out"), tmp_path / "state"
    first = events(spark, *[(f"2024-01-05 0{h}:00:00", "a", 1.0) for h in range(4)], ("2024-01-05 00:00:00", "b", 1.0))
    late = events(spark, *[(f"2024-01-02 0{h}:00:00", "a", 1.0) for h in range(3)])

    def run():
        ev.stream_burst_alerts(ev.read_stream(spark, str(landing), EVENTS), ["k"], "ts", root, str(state))
        return [(r.k, str(r.start), r["count"]) for r in spark.read.parquet(f"{root}/alerts").collect()]

    land(first, landing)
    assert run() == [("a", "2024-01-05 00:00:00", 4)]
    land(late, landing)
    assert run() == [("a", "2024-01-02 00:00:00", 3)]
    replay_last_batch(state)
    assert run() == [("a", "2024-01-02 00:00:00", 3)]
    whole = windows.burst_clusters(first.unionByName(late), ["k"], "ts")
    assert [(r.k, str(r.start), r["count"]) for r in whole.collect()] == run()


def test_failing_datasets_are_routed_away(spark, tmp_path):
    landing, root, state = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "state")
    land(events(spark, ("2024-01-01 10:00:00", "a", 1.0), ("2024-01-01 11:00:00", "a", 99.0), ("2024-01-01 10:00:00", "b", 2.0)), landing)
    stream = ev.read_stream(spark, str(landing), EVENTS)
    ev.stream_checks(stream, [q.bounds_check(stream, "v", 0, 60)], root, state, ["k"], "v", -60, 60)
    assert [r.k for r in spark.read.parquet(f"{root}/published").collect()] == ["b"]
    assert spark.read.parquet(f"{root}/quarantined").count() == 2
    assert [r.passed for r in spark.read.parquet(f"{root}/results").collect()] == [False]


def test_files_move_to_the_archive(spark, tmp_path):
    landing, archive, state = tmp_path / "landing", tmp_path / "archive", str(tmp_path / "state")
    for n in (1, 2, 3):
        land(spark.sql(f"SELECT '{n}' AS k"), landing, header="true")
        ld.stream_landing_zone(spark, str(landing), str(tmp_path / "out"), state, ["k"], ["k"], lambda df: df, str(archive))
    assert spark.read.parquet(str(tmp_path / "out" / "rows")).count() == 3
    assert len(list(archive.rglob("*.csv"))) >= 1


class Session:
    """Just what `scratch` asks a session for."""

    def __init__(self, folder, master):
        self.conf = self
        self.sparkContext = self
        self.folder, self.master = folder, master

    def get(self, key, default=None):
        return self.folder or default


def test_scratch_follows_the_session():
    assert scratch(Session("hdfs://shared/folder/", "yarn"), "x").startswith("hdfs://shared/folder/skerry/x-")
    assert "/skerry/x-" in scratch(Session(None, "local[2]"), "x")
    with pytest.raises(ValueError):
        scratch(Session(None, "yarn"), "x")


def test_runaway_stream_is_stopped(spark, tmp_path):
    from skerry.streaming.runner import run_to_end

    import time

    stream = spark.readStream.format("rate").load()

    def slow(batch, batch_id):
        time.sleep(3)

    with pytest.raises(TimeoutError):
        run_to_end(stream.writeStream.foreachBatch(slow), str(tmp_path / "state"), timeout=1)


def test_old_scratch_is_swept(spark, tmp_path, monkeypatch):
    import os

    from skerry import workspace

    monkeypatch.setattr(workspace, "_base", lambda session: str(tmp_path / "skerry"))
    for name, age in (("old", 7200), ("new", 0)):
        spark.range(3).write.parquet(str(tmp_path / "skerry" / name))
        made = os.stat(tmp_path / "skerry" / name).st_mtime - age
        os.utime(tmp_path / "skerry" / name, (made, made))
    assert workspace.sweep(spark, 1.0) == ["old"] and spark.read.parquet(workspace.scratch(spark, "x").rsplit("/", 1)[0] + "/new").count() == 3
    assert workspace.sweep(spark, 1.0) == []
