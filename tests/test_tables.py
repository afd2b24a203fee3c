"""Committed tables: kills, replays, splits; history from deliveries in any order."""

from __future__ import annotations

import itertools
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from skerry.operators import history as hs
from skerry.sources.tables import ConcurrentCommit, KeyedTable, children, part_name
from skerry.streaming import events as ev
from tests.test_streaming import land, replay_last_batch

SCHEMA = "k long, v string, n int"


def table(spark, path, **options):
    return KeyedTable(spark, str(path), SCHEMA, ("k",), **options)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(t, version=None):
    return sorted(((r.k, r.v) for r in t.read(version).collect()), key=str)


def order():
    return [F.col("n")]


def test_commits_replace_keys_and_old_versions_stay(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert content(t) == [] and t.versions() == []
    t.upsert(frame(spark, (1, "a", 1), (2, "b", 1), (None, "c", 1)), order())
    t.upsert(frame(spark, (2, "old", 0), (2, "new", 3), (None, "d", 2), (3, "e", 1)), order())
    assert content(t) == [(1, "a"), (2, "new"), (3, "e"), (None, "d")]
    assert content(t, 1) == [(1, "a"), (2, "b"), (None, "c")]
    t.upsert(frame(spark), order())
    assert content(t) == content(t, 2) and t.versions() == [1, 2, 3]
    t.update(F.col("k") >= 2, {"v": F.upper("v")})
    assert content(t) == [(1, "a"), (2, "NEW"), (3, "E"), (None, "d")]
    gone = t.vacuum(keep=1)
    assert gone and content(t) == [(1, "a"), (2, "NEW"), (3, "E"), (None, "d")] and t.versions() == [4]
    with pytest.raises(ValueError):
        t.read(1)


def test_parts_split_and_only_touched_ones_are_written(spark, tmp_path):
    t = table(spark, tmp_path / "t", part_rows=100)
    t.upsert(spark.range(1000).selectExpr("id AS k", "'a' AS v", "1 AS n"), order())
    before = t.state()["parts"]
    assert len(before) >= 10 and max(rows for _, rows in before.values()) < 200
    t.upsert(frame(spark, (5, "z", 2)), order())
    after = t.state()["parts"]
    changed = [p for p in after if after[p] != before.get(p)]
    assert len(changed) <= 2 and sum(rows for _, rows in after.values()) == 1000
    rng = random.Random(1)
    want = {k: "a" for k in range(1000)} | {5: "z"}
    for step in range(3):
        some = {rng.randrange(3000): f"s{step}" for _ in range(700)}
        t.upsert(spark.createDataFrame([(k, v, 1) for k, v in some.items()], SCHEMA), order())
        want |= some
    # Many keys of one part: it alone is split, and keys find their part among several depths.
    name = part_name(F.xxhash64("k"), F.lit(4))
    near = spark.range(5000, 40_000).select(F.col("id").alias("k")).where(name == "4-3").selectExpr("k", "'n' AS v", "1 AS n")
    t.upsert(near, order())
    want |= {r.k: "n" for r in near.collect()}
    assert len({int(p.split("-")[0]) for p in t.state()["parts"]}) > 1
    t.upsert(frame(spark, (1, "last", 5), (6000, "last", 5)), order())
    assert content(t) == sorted((want | {1: "last", 6000: "last"}).items(), key=str)


def test_children_cover_a_part():
    assert children("0-0", 2) == ["2-0", "2-1", "2-2", "2-3"] and children("3-5", 4) == ["4-10", "4-11"] and children("3-5", 3) == ["3-5"]


def test_a_kill_before_the_commit_leaves_the_old_table(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path / "t")
    t.upsert(frame(spark, (1, "a", 1)), order())
    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "_publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            t.upsert(frame(spark, (1, "b", 2), (2, "c", 2)), order())
    assert content(t) == [(1, "a")]
    # Killed while the commit itself was written.
    (tmp_path / "t" / "commits" / "0000000002.json").write_text('{"parts": {"0-0"')
    assert content(t) == [(1, "a")] and t.versions() == [1]
    assert t.upsert(frame(spark, (1, "b", 2), (2, "c", 2)), order()) == 3
    assert content(t) == [(1, "b"), (2, "c")]
    t.vacuum(1)
    assert content(t) == [(1, "b"), (2, "c")]


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path / "t")
    t.upsert(frame(spark, (1, "a", 1)), order())
    write = KeyedTable._write

    def slow(self, rows, depths):
        monkeypatch.setattr(KeyedTable, "_write", write)
        t.upsert(frame(spark, (2, "other", 1)), order())
        return write(self, rows, depths)

    monkeypatch.setattr(KeyedTable, "_write", slow)
    with pytest.raises(ConcurrentCommit):
        t.upsert(frame(spark, (3, "late", 1)), order())
    assert content(t) == [(1, "a"), (2, "other")]


def test_a_replayed_batch_is_not_committed_again(spark, tmp_path):
    landing, state, t = tmp_path / "landing", tmp_path / "state", table(spark, tmp_path / "t")

    def run():
        ev.stream_upsert_table(ev.read_stream(spark, str(landing), SCHEMA), t, str(state), order())
        return t.versions()

    land(frame(spark, (1, "a", 1), (2, "b", 1)), landing)
    assert run() == [1]
    land(frame(spark, (2, "c", 2)), landing)
    assert run() == [1, 2]
    replay_last_batch(state)
    assert run() == [1, 2] and content(t) == [(1, "a"), (2, "c")]


def brute(deliveries, tracked):
    """deliveries: {date: (full, {key: row})} -> set of (key, row, from, to)."""
    end, out = date(9999, 12, 31), []
    for key in {k for _, rows in deliveries.values() for k in rows}:
        open_, start, row = None, None, None
        for on in sorted(deliveries):
            full, rows = deliveries[on]
            new = rows.get(key)
            if new is None and not full:
                continue
            core = None if new is None else tuple(new[i] for i in tracked)
            if core != open_ and open_ is not None:
                out.append((key, row, start, on))
            if core is not None and core != open_:
                start = on
            open_, row = core, new if new is not None else row
        if open_ is not None:
            out.append((key, row, start, end))
    return sorted(out, key=str)


ATTRIBUTES = "name string, balance double"


def load(spark, path, deliveries, dates):
    t = KeyedTable(spark, str(path), hs.history_schema("k long", ATTRIBUTES), ("k",), part_rows=4)
    for on in dates:
        full, rows = deliveries[on]
        df = spark.createDataFrame([(k, *r, "extra") for k, r in rows.items()], f"k long, {ATTRIBUTES}, spells string")
        hs.load_delivery(t, df, on, full)
    found = hs.versions(t.read(), "k", ["balance"], hs.snapshots(t)).collect()
    assert all(r.is_current == (r.valid_to == date(9999, 12, 31)) for r in found)
    return sorted(((r.k, (r.name, r.balance), r.valid_from, r.valid_to) for r in found), key=str)


def test_deliveries_in_any_order_give_one_history(spark, tmp_path):
    rng = random.Random(4)
    days = [date(2024, m, 1) for m in (1, 3, 6, 9)]
    deliveries = {
        d: (full, {k: (rng.choice("xy"), rng.choice([1.0, 2.0, None])) for k in range(12) if rng.random() < 0.7})
        for d, full in zip(days, (True, False, True, False))
    }
    want = brute(deliveries, [1])
    orders = [tuple(reversed(days)), *rng.sample(list(itertools.permutations(days)), 1)]
    for i, order in enumerate(orders):
        assert load(spark, tmp_path / str(i), deliveries, [*order, order[1]]) == want


def test_late_delivery_splits_and_early_one_extends(spark, tmp_path):
    a, b, d = {1: ("n", 1.0)}, {1: ("n", 2.0)}, [date(2024, i, 1) for i in range(1, 7)]
    deliveries = {d[1]: (False, a), d[4]: (False, a), d[2]: (False, b), d[0]: (False, a), d[5]: (True, {})}
    got = load(spark, tmp_path / "t", deliveries, [d[1], d[4], d[2], d[0], d[2], d[5]])
    assert got == [(1, ("n", 1.0), d[0], d[2]), (1, ("n", 1.0), d[4], d[5]), (1, ("n", 2.0), d[2], d[4])]


def test_two_rows_of_one_key_and_date_and_rows_without_key(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), hs.history_schema("k long", ATTRIBUTES), ("k",))
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", None), (None, "c", 3.0), (2, None, None)], f"k long, {ATTRIBUTES}")
    for part in (df, df.orderBy(F.desc("name")), df.limit(0)):
        hs.load_delivery(t, part, date(2024, 1, 1), False)
    got = hs.versions(t.read(), "k", ["name", "balance"], []).collect()
    assert sorted((r.k, r.name, r.balance) for r in got) == [(1, "b", None), (2, None, None)]
