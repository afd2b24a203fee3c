from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from skerry.llm import suffix_dedup


def brute(rows, length):
    """(id, bytes, removed, spans, digest) by remembering every string seen, ids ascending."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        body = (text or "").encode()
        gone = [False] * len(body)
        for at in range(len(body) - length + 1):
            part = body[at : at + length]
            if part in seen:
                gone[at : at + length] = [True] * length
            seen.add(part)
        kept = bytes(b for b, g in zip(body, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((doc, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, length, **options):
    frame = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], "doc_id long, text string, n_removed int, block string")
    got = suffix_dedup.deduplicate(frame.repartition(3), length, **options).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, length)


def corpus(seed: int, count: int) -> list[tuple]:
    rng = random.Random(seed)
    words = ["ä", "bee", "cat", "dog ", "\n", "e", "fun", "日"]
    line = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(n))
    passages = [line(rng.randint(4, 60)) for _ in range(6)]
    rows = []
    for doc in range(count):
        parts = [line(rng.randint(0, 40)) if rng.random() < 0.6 else rng.choice(passages) for _ in range(rng.randint(0, 5))]
        rows.append((doc * 7 % count, " ".join(parts)))
    near = rows[3][1]
    rows += [(count + i, near[: 5 + i] + "!" + near[5 + i :]) for i in range(15)]
    rows += [(count + 50 + i, rows[5][1]) for i in range(10)]
    return rows


@pytest.mark.parametrize("length,seed", [(100, 1), (100, 2), (20, 3), (7, 4)])
def test_against_brute_force(spark, length, seed):
    check(spark, corpus(seed, 40), length, block_bytes=3000, bucket_hashes=300)


def test_runs_ties_and_odd_rows(spark):
    rows = [(1, "a" * 500), (2, "a" * 99), (3, "ab" * 300), (4, "a" * 100), (5, None), (6, ""), (None, "ba" * 60), (7, "x"), (8, "ab" * 300)]
    check(spark, rows, 100)
    check(spark, rows, 100, block_bytes=200, bucket_hashes=10)


def test_long_text_and_segments(spark, monkeypatch):
    rng = random.Random(9)
    long = "".join(rng.choice("abcd ") for _ in range(30_000))
    rows = [(1, long), (2, long[10_000:20_000] + "z" + long[5_000:9_000]), (3, long[::-1]), (4, "q" + long)]
    check(spark, rows, 100)


def test_hash_over_segments():
    data = np.frombuffer(random.Random(1).randbytes(3 * suffix_dedup.SEGMENT // 2), np.uint8)
    again = np.concatenate([data, data])
    prefix = suffix_dedup.PrefixHash(100)
    places = np.arange(0, len(data) - 100, 997)
    assert (prefix(data, places) == prefix(again, places + len(data))).all()
    assert len(np.unique(prefix(data, places))) == len(places)


@pytest.mark.parametrize("period", [1, 2, 7, 13, 31])
def test_difference_cover(period):
    cover = suffix_dedup.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_equal_ids_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "s" * 150), (1, "s" * 150)], "doc_id long, text string")
    rows = suffix_dedup.deduplicate(frame, keep_text=True).collect()
    assert sorted(r["n_removed"] for r in rows) == [149, 150]
    assert suffix_dedup.deduplicate(frame.limit(0)).count() == 0
