"""The pipeline's stages against brute force on planted documents."""

from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from skerry.llm import decontaminate, pii
from skerry.llm.shared import read_table
from tests.llm.test_jaccard_forest import brute

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = " ".join(f"exam{i}" for i in range(25))


def documents():
    rng = random.Random(8)
    word = lambda: rng.choice("bdfgklm") + rng.choice("aeiou") + rng.choice("nrst") + str(rng.randint(0, 20))
    texts, toxic, leaks, copies = [], set(), set(), {}
    for at in range(500):
        words = [word() for _ in range(rng.randint(30, 90))]
        kind = at % 10
        if kind == 3:
            for _ in range(4):
                words[rng.randrange(len(words))] = f"vilest{rng.randint(0, 30)}"
            toxic.add(at)
        if kind == 5:
            words[10:10] = ITEM.upper().split()
            leaks.add(at)
        if kind == 6:
            words.insert(4, f"mail me{at}@mail{at % 9}.example.com or 4111 1111 1111 1111")
        if kind == 7 and at > 10:
            words = texts[at - 7].split()
            words[3] = "changed"
            copies[at] = at - 7
        texts.append(" ".join(words))
    texts += [None, "", texts[0], "exam1 exam2"]
    return texts, toxic, leaks, copies


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    texts, toxic, leaks, copies = documents()
    rows = [(i, t, "xy"[i % 2], "src", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in range(500)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, seen = read_table(spark, folder, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), "test-stage")
        seen.append((docs.columns, {r["doc_id"]: r for r in docs.collect()}))
    return texts, toxic, leaks, copies, seen, folder


def test_toxic_documents_go(stages):
    texts, toxic, _, _, seen, _ = stages
    columns, kept = seen[0]
    assert columns == [c.split()[0] for c in COLUMNS.split(", ")]
    assert len(toxic & set(kept)) <= 2 and len(set(range(len(texts))) - toxic - set(kept)) <= 2


def test_one_of_each_class_stays(stages):
    _, _, _, _, seen, _ = stages
    before, after = seen[0][1], seen[1][1]
    want = {c for _, c, _ in brute([(i, r["text"]) for i, r in sorted(before.items())])}
    assert set(after) == want and all(after[i] == before[i] for i in after)


def test_passages_go_and_clean_documents_stay(stages):
    _, _, leaks, _, seen, _ = stages
    before, after = seen[1][1], seen[2][1]
    automaton = decontaminate.Automaton([(1, ITEM)], 10)
    for doc, row in before.items():
        if doc not in leaks:
            assert after[doc] == row
        elif doc in after:
            assert not automaton.hits(decontaminate.words_of(after[doc]["text"]))[0]
            assert after[doc]["n_chars"] == len(after[doc]["text"])
    assert len(leaks & set(after)) > 10


def test_private_values_are_replaced(stages):
    _, _, _, _, seen, _ = stages
    before, after = seen[2][1], seen[3][1]
    feistel = pii.Feistel(corpus_pipeline.PSEUDONYM_KEY.encode())
    assert set(before) == set(after)
    for doc, row in before.items():
        found = pii.find_private(row["text"] or "", feistel)
        assert (after[doc]["text"] == row["text"]) == (not found)
        assert after[doc]["text"] is None or after[doc]["n_chars"] == len(after[doc]["text"])
        assert "4111 1111 1111 1111" not in (after[doc]["text"] or "")


def test_the_rest_is_encoded(spark, stages):
    _, _, _, _, seen, folder = stages
    lines = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read().split(b"\n")
    ranks = {base64.b64decode(x.split()[0]): int(x.split()[1]) for x in lines if x.strip()}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    before, after = seen[3][1], seen[4][1]
    assert set(before) == set(after)
    for doc, row in before.items():
        ids = reference.encode_ordinary(row["text"] or "")
        assert after[doc]["ids"] == ids
        assert after[doc]["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()
    assert {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, folder).collect()} == {d: r["ids"] for d, r in after.items()}


def test_stages_survive_odd_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(None, None), (1, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    odd = [(1, None, None, None, None), (1, None, None, None, None), (None, "", "x", "s", 0), (None, "some words here", "x", "s", 15), (2, "w " * 9000, "x", "s", 18000)]
    for rows in (odd, []):
        docs = spark.createDataFrame([(*r, 7, "k") for r in rows], COLUMNS + ", node long, score string")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns
            # An untrained classifier may reject anything; the other stages keep these documents.
            docs = docs if stage is corpus_pipeline.drop_toxic and out.count() >= 0 else corpus_pipeline.stored(out, "odd")
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == (4 if rows else 0)
