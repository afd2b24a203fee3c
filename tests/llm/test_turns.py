"""Conversation repair against a search over all repairs."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
from collections import defaultdict
from zlib import crc32

import pytest

from skerry.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, part int, chunk string"
LEGAL = {"su", "ua", "au"}


def damaged(rows):
    """The rows after damage, per conversation in order."""
    out = defaultdict(list)
    for talk, turn, role, text in rows:
        lot = crc32(f"{' ' if talk is None else talk}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out[talk] += []
        if lot:
            row = (turn, "user" if lot == 4 else role, "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text)
            out[talk] += [row, row] if lot == 3 else [row]
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for k, v in out.items()}


def cheapest(rows, faults):
    """Least cost, then least letters, by a search over grammar states that knows nothing of tables."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, at, state, lines = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in ("", "a"):
            return cost, letters, lines
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        new = after[-1]
        said = {"u": "user", "a": "assistant"}[new]
        heapq.heappush(heap, (cost + 2, letters + "I", at, new, (*lines, f"{said}:")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, letters + "D", at + 1, state, lines))
            if faults[at] in ("", "truncated"):
                more = cost + (faults[at] == "truncated")
                heapq.heappush(heap, (more + 2, letters + "R", at + 1, new, (*lines, f"{said}:{text}")))
                if role[:1] and role[0] in after:
                    heapq.heappush(heap, (more, letters + "K", at + 1, role[0], (*lines, f"{role}:{text}")))


def brute(rows):
    out = []
    for talk, own in damaged(rows).items():
        faults, seen = [], set()
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        known = {r[0] for r in own if r[0] is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(own, own[1:]))
        cost, letters, lines = cheapest(own, faults)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((talk, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, digest, letters))
    return sorted(out, key=repr)


def run(spark, rows, partitions=3):
    df = spark.createDataFrame([(*r, 0, "clash") for r in rows], SCHEMA).repartition(partitions)
    return sorted((tuple(r) for r in turns.repair_turns(turns.damage(df)).collect()), key=repr)


def talks(seed, n, most):
    rng = random.Random(seed)
    for talk in range(n):
        for turn in range(rng.randint(0, most)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "User", None])
            text = rng.choice(["Yes.", "No!", "and then", "Who?", "", " \t", None, "é.", f"turn {turn}.", f"open {turn}"])
            yield talk, turn + rng.choice([0, 0, 0, 3]), role, text


def test_equals_search(spark):
    rows = list(talks(1, 150, 12))
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize(("rows_each", "chars"), [(4, 10**6), (1000, 9), (1, 1)])
def test_conversations_over_many_chunks(spark, monkeypatch, rows_each, chars):
    """Chunks end anywhere; one conversation holds most rows."""
    rows = list(talks(2, 20, 10)) + [(77, i, ("user", "assistant")[i % 2], f"text {i % 90}.") for i in range(600)]
    # Functions go to the workers by reference, so chunk limits travel as default values there.
    original = turns._chunks
    monkeypatch.setattr(turns, "pack", lambda batches: turns.batched(original(turns.rows_of(batches), rows_each, chars), turns.CHUNK))
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "Hello."), (None, 2, "assistant", "Hi."), (1, None, "user", "a."), (1, None, "user", "a."), (1, None, "system", "z."),
        (1, 3, "user", "b."), (1, 3, "assistant", "b."), (2, None, None, None), (3, -5, "assistant", "x" * 2_000_000 + "."),
        (4, 10**12, "user", "far."), (4, 1, "user", "near."), (5, 0, "supervisor", "s."), (5, 1, "usher", "u."), (5, 2, "aide", "a."),
    ]
    assert run(spark, rows) == brute(rows)


def test_all_rows_dropped_and_empty_table(spark):
    gone = next(i for i in range(1000) if crc32(f"{i}:0".encode()) % 20 == 0)
    assert run(spark, [(gone, 0, "user", "x.")]) == [(gone, 0, 0, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")]
    assert run(spark, []) == []


def test_tables_are_few_and_blocks_equal_single_steps():
    t = turns.tables()
    assert len(t.vectors) < 100
    rng = random.Random(3)
    for _ in range(300):
        symbols = bytes(rng.randrange(turns.SYMBOLS) for _ in range(rng.randint(1, 17)))
        cut = rng.randint(0, len(symbols))
        whole, left, right = (turns.summary(s) for s in (symbols, symbols[:cut], symbols[cut:]))
        for behind, (front, cost, *land) in enumerate(whole):
            middle = right[behind]
            first = left[middle[0]]
            assert (front, cost) == (first[0], first[1] + middle[1])
            assert land == [middle[2 + first[2 + q]] for q in range(4)]
