"""State of streams: equal to batches in any order of arrival, at a cost that does not grow."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skerry.operators import windows
from skerry.sources.tables import KeyedTable
from skerry.streaming import events as ev
from skerry.streaming.state import FirstBurst
from tests.test_streaming import EVENTS, events, land, replay_last_batch


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Listed:
    def __init__(self):
        self.rows, self.reads = [], 0

    def get(self):
        self.reads += 1
        return list(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def appendList(self, rows):
        self.rows += rows


class Mapped(dict):
    def exists(self):
        return bool(self)

    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        self.pop(key, None)


def processor(span, count):
    made = FirstBurst(["k"], span, count)
    made.alert, made.early, made.inside = Value(), Mapped(), Listed()
    return made


def brute(times, span, count):
    times = sorted(times)
    for t in times:
        n = sum(t <= x <= t + span for x in times)
        if n >= count:
            return t, n
    return None


@pytest.mark.parametrize("seed", range(60))
def test_first_burst_in_any_order(seed):
    rng = random.Random(seed)
    span, count = rng.choice([(10, 2), (10, 3), (25, 4), (7, 5)])
    made, seen = processor(span, count), []
    for _ in range(rng.randint(1, 25)):
        base = rng.randrange(-300, 600)
        chunk = sorted(base + rng.randrange(0, rng.choice([5, 60, 400])) for _ in range(rng.randint(1, 8)))
        made._absorb(chunk)
        seen += chunk
        want = brute(seen, span, count)
        assert (made.alert.value[:2] if made.alert.value else None) == want
        assert all(len(v[0]) < count for v in made.early.values())
        if want:
            assert sum(len(v[0]) for v in made.early.values()) == sum(t < want[0] for t in seen)
            assert sorted(t for (t,) in made.inside.rows) == sorted(t for t in seen if want[0] <= t <= want[0] + span)


def test_a_hot_cell_keeps_only_its_burst():
    made = processor(1000, 3)
    for start in range(0, 200_000, 1000):
        made._absorb(list(range(start, start + 1000)))
    assert made.alert.value[:2] == (0, 1001) and len(made.inside.rows) == 1001 and not made.early and made.inside.reads == 0


ALERTS = "k string, start timestamp, count bigint"


def test_alerts_over_many_small_batches_in_reverse_order(spark, tmp_path):
    landing, state = tmp_path / "landing", tmp_path / "state"
    alerts = KeyedTable(spark, str(tmp_path / "alerts"), ALERTS, ("k",))
    rng, first = random.Random(2), datetime(2024, 3, 1)
    rows = [((first - timedelta(hours=5 * i + rng.randint(0, 9))).strftime("%Y-%m-%d %H:%M:%S"), rng.choice(["a", "b", None]), 1.0) for i in range(60)]

    def run():
        # Each delivery is its own batch.
        ev.stream_burst_state(ev.read_stream(spark, str(landing), EVENTS, 1), ["k"], "ts", alerts, str(state), 86_400, 3)
        return sorted(((r.k, str(r.start), r["count"]) for r in alerts.read().collect()), key=str)

    for start in range(0, 60, 12):
        land(events(spark, *rows[start : start + 12]), landing)
    got = run()
    whole = windows.burst_clusters(events(spark, *rows), ["k"], "ts", 86_400, 3)
    want = sorted(((r.k, str(r.start), r["count"]) for r in whole.collect()), key=str)
    assert got == want and len(want) >= 2
    replay_last_batch(state)
    assert run() == want


def test_dedupe_costs_the_same_in_every_batch(spark, tmp_path):
    """20 batches, each of 100 new keys and 50 that came before: look-ups stay flat while the state grows."""
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    rng = random.Random(3)
    for n in range(20):
        known = [rng.randrange(100 * n) for _ in range(50)] if n else []
        rows = [("2024-01-01 10:00:00", str(k), float(n)) for k in [*range(100 * n, 100 * n + 100), *known]]
        land(events(spark, *rows), landing)
    reports = ev.stream_dedupe(ev.read_stream(spark, str(landing), EVENTS, 1), "ts", ["k"], out, str(tmp_path / "state"))
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 2000 and all(int(r["k"]) // 100 == r["v"] for r in rows)
    metrics = [r["stateOperators"][0] for r in reports if r["numInputRows"]]
    assert metrics[-1]["numRowsTotal"] == 2000
    reads = [m["customMetrics"]["rocksdbGetCount"] for m in metrics]
    assert len(reads) == 20 and max(reads[1:]) <= 150 * 2


def test_sessions_get_their_settings_back(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    land(events(spark, ("2024-01-01 10:00:00", "a", 1.0)), tmp_path / "landing")
    ev.stream_dedupe(ev.read_stream(spark, str(tmp_path / "landing"), EVENTS), "ts", ["k"], str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.conf.get(name) == before
