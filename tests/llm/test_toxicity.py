from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import pytest

from skerry.llm import toxicity

SMALL = toxicity.Shape(buckets=1 << 12)


def corpus(count):
    rng = random.Random(3)
    rows = []
    for doc in range(count):
        words = [rng.choice("bcdfg") + rng.choice("aeiou") + str(rng.randint(0, 40)) for _ in range(rng.randint(3, 80))]
        bad = rng.random() < 0.3
        if bad:
            words[rng.randrange(len(words))] = f"vilest{rng.randint(0, 500)}"
        rows.append((doc, " ".join(words), rng.choice(["en", "de"]), int(bad)))
    return rows


@pytest.fixture(scope="module")
def frames(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([(d, t, g, 1.0) for d, t, g, _ in rows], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(d, y, None) for d, _, _, y in rows] + [(0, None, None), (None, 1, None)], "doc_id long, toxic int, lang string")
    return rows, docs, labels, toxicity.train(docs, labels, shape=SMALL)


def test_held_out_accuracy(spark, frames):
    rows, docs, _, model = frames
    truth = {d: y for d, _, _, y in rows}
    got = toxicity.score_texts(docs, model).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {d: crc32(str(d).encode()) % 3 == 1 for d in truth}
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert np.mean([r["rejected"] == bool(truth[r["doc_id"]]) for r in held]) > 0.95
    assert set(model.thresholds) == {None, "en", "de"}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_score_sees_only_text(spark, frames):
    _, _, _, model = frames
    odd = [(1, "vilest1 ba1", "en"), (None, "vilest1 ba1", None), (7, None, "xx"), (8, "", "de"), (8, "", "de"), (9, "ba1 " * 40_000, "en")]
    got = toxicity.score_texts(spark.createDataFrame(odd, "doc_id long, text string, lang string"), model).collect()
    scores = {(r["doc_id"], r["held_out"]): r["score"] for r in got}
    assert len(got) == 6 and scores[(1, False)] == scores[(None, False)]
    assert len({r["score"] for r in got if r["doc_id"] in (7, 8)}) == 1
    assert toxicity.score_texts(spark.createDataFrame([], "doc_id long, text string, lang string"), model).count() == 0


def test_rejection_keeps_columns(spark, frames):
    rows, docs, _, model = frames
    kept = toxicity.reject(docs, model)
    flags = {r["doc_id"]: r["rejected"] for r in toxicity.score_texts(docs, model).collect()}
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, bad in flags.items() if not bad}


def test_without_labels(spark, frames):
    _, docs, labels, _ = frames
    model = toxicity.train(docs, labels.limit(0), shape=SMALL)
    assert model.thresholds == {None: 0.5}
    assert toxicity.score_texts(docs, model).count() == docs.count()


def test_memory_of_words_is_bounded(frames, monkeypatch):
    _, _, _, model = frames
    text = " ".join(f"w{i}" for i in range(500))
    whole = model.scorer()([text, "w1 w2", text])
    monkeypatch.setattr(toxicity, "MEMO_WORDS", 100)
    assert np.allclose(model.scorer()([text, "w1 w2", text]), whole)


def test_threshold():
    assert toxicity.best_threshold(np.array([0.9, 0.8, 0.2, 0.1]), np.array([1, 1, 0, 0]), 0.5) == pytest.approx(0.5)
    assert toxicity.best_threshold(np.array([0.9]), np.array([1]), 0.4) == 0.4


def test_thresholds_count_all_labelled_rows(spark, frames, monkeypatch):
    """Only the fit is bounded: every labelled row that was not fitted calibrates, whatever `max_rows` is."""
    rows, docs, labels, _ = frames
    seen, real = [], toxicity.threshold_of_cells
    monkeypatch.setattr(toxicity, "threshold_of_cells", lambda *a: seen.append(a) or real(*a))
    fitted, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda texts, *a: fitted.append(len(texts)) or fit(texts, *a))
    usable = [(d, g, y) for d, _, g, y in rows if crc32(str(d).encode()) % 3 != 1]
    model = toxicity.train(docs.unionByName(docs), labels, max_rows=200, shape=SMALL)
    assert 0 < fitted[0] <= 200 and seen[0][2].sum() == len(usable) - fitted[0] > 300
    assert sum(part[2].sum() for part in seen[1:]) == seen[0][2].sum() and set(model.thresholds) == {None, "en", "de"}


def test_both_classes_need_labels(spark, frames):
    rows, docs, labels, _ = frames
    none = [d for d, _, g, y in rows if g == "de" and y]
    few = labels.where(~labels["doc_id"].isin(none[3:]))
    model = toxicity.train(docs, few, max_rows=200, shape=SMALL)
    assert set(model.thresholds) == {None, "en"}


def test_threshold_of_cells_equals_single_rows():
    rng = np.random.default_rng(1)
    scores, labels = rng.random(400).round(2), (rng.random(400) < 0.4).astype(float)
    values, back = np.unique(scores, return_inverse=True)
    toxic = np.bincount(back, labels)
    assert toxicity.threshold_of_cells(values, values, np.bincount(back), toxic, 0.5) == toxicity.best_threshold(scores, labels, 0.5)
