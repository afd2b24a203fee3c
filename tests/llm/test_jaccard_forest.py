from __future__ import annotations

import random

import numpy as np
import pytest

from skerry.llm import jaccard_forest as forest


def shingles(text):
    words = (text or "").lower().encode().translate(forest.SEPARATORS).split()
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def brute(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links = [[] for _ in rows]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i].append(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        reached, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in reached and rows[j][0] is not None:
                    reached.add(j)
                    todo.append(j)
        names = [rows[j][0] for j in reached if rows[j][0] is not None]
        out.append((doc, min(names) if doc is not None else None, len(links[i])))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 30))
    rows, doc = [], 0
    for size in [1, 1, 1, 2, 3, 5, 8, 60]:
        base = [word() for _ in range(rng.randint(60, 300))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                own[rng.randrange(len(own))] = word()
            rows.append((doc, " ".join(own)))
            doc += 1
    return rows + [(doc + 1, "Tiny text"), (doc + 2, "tiny, TEXT!"), (doc + 3, None), (doc + 4, ""), (doc + 5, "...")]


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 8)])
def test_against_brute_force(spark, seed, block):
    rows = corpus(seed)
    frame = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, node int, root string")
    got = sorted(map(tuple, forest.near_duplicates(frame.repartition(4), block=block).collect()))
    assert got == sorted(brute(rows))


def test_repeated_rows_null_ids_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, text + " more"), (None, "alone here now"), (1, "other words at all today")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, forest.near_duplicates(frame).collect()), key=str)
    assert got == sorted([(1, 1, 4), (1, 1, 4), (2, 1, 4), (None, None, 4), (3, 1, 4), (None, None, 0), (1, 1, 0)], key=str)
    assert forest.near_duplicates(frame.limit(0)).count() == 0


def test_one_of_each_class_stays(spark):
    rows = corpus(3)
    frame = spark.createDataFrame([(d, t, "x") for d, t in rows] + [(0, rows[0][1], "x")], "doc_id long, text string, extra string")
    kept = forest.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _ in brute(rows)})


def test_no_text_is_lost_where_an_id_stands_for_several(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [
        (1, a, 0), (1, b, 0), (2, b, 0), (3, c, 0), (4, c + " more", 0), (4, d, 0), (5, "", 0), (5, d, 0), (5, "...", 0), (6, b, 0), (6, a, 0),
        (None, a, 0), (7, None, 0), (1, a, 0),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, node int")
    kept = sorted(((r["doc_id"], r["text"]) for r in forest.drop_near_duplicates(frame).collect()), key=str)
    want = [(1, a), (1, b), (3, c), (4, d), (5, ""), (5, "..."), (7, None), (None, a)]
    assert kept == sorted(want, key=str)


def test_components(spark):
    rng = random.Random(5)
    path = list(range(200))
    rng.shuffle(path)
    ties = list(zip(path, path[1:])) + [(1000 + i, 1000) for i in range(1, 40)] + [(5000, 5001)]
    got = {r["node"]: r["root"] for r in forest.components(spark.createDataFrame(ties, "a long, b long")).collect()}
    groups = {}
    for node, root in got.items():
        groups.setdefault(root, set()).add(node)
    assert sorted(map(len, groups.values())) == [2, 40, 200]


def test_recall_bound():
    depth = forest.prefix_depth(forest.TREES, forest.DEEPEST, 0.8, forest.TARGET)
    assert 1 - (1 - 0.8**depth) ** forest.TREES >= forest.TARGET > 1 - (1 - 0.8 ** (depth + 1)) ** forest.TREES


@pytest.mark.parametrize("step", [2223, 2778, 5557, 11_113])
def test_exact_ties_of_long_texts(step):
    """8 of 9 shingles of equal sets are shared at similarity 0.8; one less is below it."""
    sets = [np.arange(9 * step), np.arange(step, 10 * step), np.arange(step + 1, 10 * step + 1), np.arange(9 * step)]
    sets = [s.astype(np.uint64) for s in sets]
    linked = forest._linked(sets, np.array([len(s) for s in sets]), 0.8)
    near = {(0, 1), (0, 3), (1, 2), (1, 3)}
    assert {(i, j) for i, j in zip(*np.nonzero(linked)) if i < j} == near and (linked == linked.T).all()


def test_exact_ties_of_uneven_texts():
    for step in range(2500, 2600, 7):
        small, large = np.arange(8 * step, dtype=np.uint64), np.arange(10 * step, dtype=np.uint64)
        sizes = lambda *s: np.array([len(x) for x in s])
        assert forest._linked([small, large], sizes(small, large), 0.8)[0, 1]
        assert not forest._linked([small[1:], large], sizes(small[1:], large), 0.8)[0, 1]
