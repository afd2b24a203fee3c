from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skerry.llm import topk


def brute(rows, k, query):
    usable = {}
    for vec_id, vector in rows:
        if vec_id is None or not vector or any(x is None or not np.isfinite(x) for x in vector):
            continue
        z = [int(np.floor(64 * float(np.float32(x)))) for x in vector]
        usable[vec_id] = max(z, usable.get(vec_id, z))
    out = []
    for q, a in usable.items():
        if not query(q):
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in usable.items() if c != q and len(a) == len(b))
        out += [(q, rank, c, -s) for rank, (s, c) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block,batch", [(2048, 4096), (90, 7)])
def test_against_brute_force(spark, block, batch):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)]) for i in range(400)]
    rows += [(500 + i, [rng.choice([-0.1, 0.0, 0.1]) for _ in range(16)]) for i in range(200)]  # many ties
    rows += [(720 + 20 * i, [rng.gauss(0, 1) * 10.0 ** (2 * i + 1) for _ in range(16)]) for i in range(4)]  # huge ones
    rows += [(800, None), (820, [1.0, None]), (840, [float("nan")] * 16), (860, [float("inf")] * 16), (880, [0.0] * 16)]
    rows += [(900, [0.5, -1.0]), (901, [1.0, 1.0]), (920, [3.0]), (None, [0.1] * 16), (0, rows[0][1]), (20, [0.3] * 16), (940, [])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, vec int")
    got = topk.top_k(topk.integer_vectors(frame), F.col("vec_id") % 20 == 0, 20, block, batch)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, lambda q: q % 20 == 0)


def test_reads_less_than_all():
    rng = np.random.default_rng(1)
    rows = np.floor(rng.normal(0, 8, (2000, 16))).astype(np.int64)
    rows[:40] += 60
    lists = topk.SortedLists(np.arange(2000), rows)
    ids, scores = lists.top(rows[0], 20, 0)
    direct = rows @ rows[0]
    direct[0] = -(2**40)
    assert list(scores) == sorted(direct, reverse=True)[:20] and 0 not in ids


def test_empty(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.integer_vectors(frame), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("scale", [20, 10**5])
def test_bounds_hold_at_every_depth(scale):
    """Against bounds from the lists themselves, entry by entry."""
    rng = np.random.default_rng(4)
    rows = np.floor(rng.normal(0, scale, (200, 6))).astype(np.int64)
    lists, every = topk.SortedLists(np.arange(200), rows), np.arange(200)
    for query in np.floor(rng.normal(0, scale, (4, 6))).astype(np.int64):
        query[0] = 0
        direct, former = rows @ query, None
        for depth in (1, 60, 150, 199, 200):
            lower, upper = lists.lower_bounds(query, depth, every), lists.upper_bounds(query, depth, every)
            for r in range(0, 200, 17):
                low = high = 0
                for j, q in enumerate(query):
                    column = sorted(rows[:, j], reverse=q > 0)
                    edge, end = column[depth - 1], column[-1]
                    read = rows[r, j] >= edge if q > 0 else rows[r, j] <= edge
                    low, high = low + q * (rows[r, j] if read else end), high + q * (rows[r, j] if read else edge)
                assert (lower[r], upper[r]) == (low, high)
            assert (lower <= direct).all() and (direct <= upper).all()
            assert former is None or ((former[0] <= lower).all() and (upper <= former[1]).all())
            former = lower, upper
        assert (lower == direct).all() and (upper == direct).all()
        some = np.array([3, 50, 199])
        assert (lists.upper_bounds(query, 60, some) == lists.upper_bounds(query, 60, every)[some]).all()


def test_scores_beyond_64_bits_are_an_error(spark):
    far = spark.createDataFrame([(0, [1e300]), (20, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exceeds 64 bits"):
        topk.top_k(topk.integer_vectors(far), F.col("vec_id") % 20 == 0).collect()
    lists = topk.SortedLists(np.arange(2), np.array([[2**40, 2**40], [2**40, -(2**40)]]))
    query = np.array([2**23, 2**22])
    with pytest.raises(OverflowError):
        lists.scores(np.arange(2), query)
    assert list(lists.scores(np.array([1]), query)) == [2**62]


def table(ids, rows, queries):
    vec = [list(map(int, v)) for v in (*rows, *rows[queries])]
    asks = [False] * len(rows) + [True] * len(queries)
    return pa.table({"vec_id": [*ids, *ids[queries]], "vec": pa.array(vec, pa.list_(pa.int64())), "ask": asks})


def test_bounds_are_made_for_many_queries_at_once(spark, monkeypatch):
    """The bounds of 300 queries against a block take a few products, not some for each query."""
    made = []
    for name in ("lower_bounds", "upper_bounds"):
        one = getattr(topk.SortedLists, name)
        monkeypatch.setattr(topk.SortedLists, name, lambda *a, one=one: made.append(1) or one(*a))
    rng = np.random.default_rng(5)
    rows, ids, queries = np.floor(rng.normal(0, 8, (3000, 24))).astype(np.int64), np.arange(3000) * 3, np.arange(300) * 10
    found = topk._search(20)(table(ids, rows, queries)).to_pylist()
    assert len(made) <= 2 * len(topk.DEPTHS) * 2
    direct = rows[queries] @ rows.T
    direct[np.arange(300), queries] = -(2**40)
    for i, q in enumerate(queries):
        best = np.lexsort((ids, -direct[i]))[:20]
        assert [(f["query_id"], f["vec_id"], f["score"]) for f in found[20 * i : 20 * i + 20]] == [(ids[q], ids[b], direct[i][b]) for b in best]


@pytest.mark.parametrize("step", [1, 7, 256])
def test_queries_of_any_size_side_by_side(monkeypatch, step):
    """Zero, small and huge queries, copies and a repeated id in one batch, with products of any width."""
    monkeypatch.setattr(topk, "STEP_QUERIES", step)
    monkeypatch.setattr(topk, "STEP_ROWS", 50)
    rng = np.random.default_rng(6)
    rows = np.floor(rng.normal(0, 8, (400, 12))).astype(np.int64)
    rows[100:220], rows[220] = rows[100], 0
    rows[230:240] *= 10**6
    rows[240:250] *= 10**7
    ids = rng.permutation(400)
    ids[7] = ids[8]
    lists = topk.SortedLists(ids, rows)
    queries = np.r_[0:20, 95:110, 215:250]
    for q, (found, scores) in zip(queries, lists.tops(rows[queries], 20, ids[queries])):
        others = np.flatnonzero(ids != ids[q])
        direct = rows[others] @ rows[q]
        best = np.lexsort((ids[others], -direct))[:20]
        assert list(found) == list(ids[others][best]) and list(scores) == list(direct[best])
