"""Fill-in-the-middle against plain string operations."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from skerry.llm.infill import ByteIndex, Plan, fill_in_middle, rearrange, rebuild, restore

TEXT = st.text(alphabet=st.sampled_from("ab\n\r<PSM>éß漢🙂́ "), max_size=60)


def brute(text, key, plan):
    text = text or ""
    units = list(text) if plan.unit == "char" else re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{plan.seed}:{key}".encode()).hexdigest()
    one, two, three, four = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or three % 100 >= plan.share:
        return len(units), "plain", None, None, text
    a, b = sorted((one % (len(units) + 1), two % (len(units) + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    spm = four % 100 < plan.suffix_first
    return len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=400, deadline=None)
@given(TEXT, st.integers(0, 10**6), st.sampled_from(["line", "char"]))
def test_equals_brute_force_and_rebuilds(text, key, unit):
    plan = Plan(unit=unit, share=90)
    got = rearrange(text.encode(), str(key), plan)
    assert (*got[:4], got.output.decode()) == brute(text, key, plan)
    assert rebuild(got.output, got.form) == text.encode()


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_index_converts_both_ways(text):
    index = ByteIndex(np.frombuffer(text.encode(), np.uint8))
    for at in range(len(text) + 1):
        byte = len(text[:at].encode())
        assert index.bytes(at) == byte and index.chars(byte) == at
    assert len(index.at) == sum(ord(c) > 127 for c in text)


SCHEMA = "doc_id long, text string, output string, form string, n int"
ROWS = [
    (1, "a\nb\nc"), (1, "a\nb\nc"), (1, "other"), (None, "no\nid"), (None, None), (2, None), (3, ""), (4, "\n"), (5, "has <M> inside"),
    (6, "é\n" * 300_000 + "ende"), (7, "x" * 3_000_000), (8, "<S\n<P\n>"), (9, "\r\n \n"),
]


@pytest.mark.parametrize("plan", [Plan(), Plan(seed=3, share=0), Plan(unit="char", suffix_first=0)])
def test_frame(spark, plan):
    df = spark.createDataFrame([(i, t, "clash", "clash", 0) for i, t in ROWS], SCHEMA).repartition(3)
    got = restore(fill_in_middle(df, plan)).collect()
    want = [(i, *brute(t, "" if i is None else i, plan), t or "") for i, t in ROWS]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    made = restore(fill_in_middle(spark.createDataFrame([], SCHEMA)))
    assert made.collect() == [] and made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
