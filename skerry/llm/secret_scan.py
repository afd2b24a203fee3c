"""Secrets in texts: fixed patterns, and windows of high entropy inside long candidate strings.

A candidate is a run of at least `window` characters of [A-Za-z0-9+/_=-]. In it,
a window slides over every maximal run of each class: hex digits, letters and
digits, all of these characters. Counts per character are updated by one
character in and one out, and the Shannon entropy follows from the running sum
of c * log2 c. Windows at or above the threshold of the class are united to
spans over all classes; a span is named by the narrowest class that holds it. A
run of letters, digits or hex digits on the allow-list gives no spans, nor does a
window whose tokens (between '=' and '/'), taken together, are on the list; the
patterns are not touched by it.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import cache

from pyspark.sql import DataFrame

from skerry.llm.shared import keyed_texts, map_texts

# Patterns, the group that is measured and its least length; fixed values.
BASE = [
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
        ),
        2,
        8,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
]
# Only texts with a run this long can match the last pattern; the search is far cheaper than all short runs.
HEX_RUN = re.compile(r"[0-9a-f]{32}")
WINDOW = 20
CLASSES = [
    ("entropy_hex", re.compile(r"[0-9a-fA-F]+"), 3.0),
    ("entropy_alnum", re.compile(r"[0-9A-Za-z]+"), 3.6),
    ("entropy_base64", re.compile(r"[0-9A-Za-z+/_=-]+"), 3.8),
]
ORDER = {name: rank for rank, name in enumerate([*(b[0] for b in BASE), *(c[0] for c in CLASSES)])}
TOKEN = re.compile(r"[^=/]+|[=/]")
# Runs and tokens that look random and are not secret: identifiers, example values, alphabets, rules and paths of words.
ALLOWED = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"(?i).*(example|sample|placeholder|changeme).*",
    r"(?i).*(0123456789|abcdefghij|qwertyuiop).*",
    r"[-_=+/]+",
    r"/?([a-z]+[/_-])+[a-z]+/?",
    r"[A-Za-z]+",
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and non-overlapping per kind."""
    found = []
    for kind, pattern, group, least in BASE:
        if kind == "hex" and not HEX_RUN.search(text):
            continue
        if kind == "access" and "AKIA" not in text:
            continue
        for match in pattern.finditer(text):
            if match.end(group) - match.start(group) >= least:
                found.append((match.start(), match.end(), kind))
    return found


def hot_starts(candidate: str, window: int, threshold: float) -> Iterator[int]:
    """Starts of all windows whose entropy reaches the threshold."""
    weight = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    ceiling = window * (math.log2(window) - threshold) + 1e-9
    for at, char in enumerate(candidate):
        now = counts.get(char, 0)
        counts[char] = now + 1
        total += weight[now + 1] - weight[now]
        if at >= window:
            out = candidate[at - window]
            had = counts[out]
            counts[out] = had - 1
            total += weight[had - 1] - weight[had]
        if at >= window - 1 and total <= ceiling:
            yield at - window + 1


def _united(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ordered ranges that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def hot_windows(candidate: str, window: int, threshold: float) -> list[tuple[int, int]]:
    """United [start, end) of all windows whose entropy reaches the threshold."""
    return _united((at, at + window) for at in hot_starts(candidate, window, threshold))


def entropy_spans(
    text: str, candidates: re.Pattern, allowed: Sequence[re.Pattern], window: int = WINDOW
) -> list[tuple[int, int, str]]:
    found = []
    for match in candidates.finditer(text):
        candidate = match[0]
        known = cache(lambda start, end: any(rule.fullmatch(candidate, start, end) for rule in allowed))
        hot, searched = [], set()
        for _, alphabet, threshold in CLASSES:
            for run in alphabet.finditer(candidate):
                # What a wider class finds in the run of a narrower one, that class has found.
                if run.end() - run.start() < window or run.span() in searched:
                    continue
                searched.add(run.span())
                if alphabet is CLASSES[-1][1]:
                    first, last = _token_bounds(candidate)
                    starts = (at for at in hot_starts(run[0], window, threshold) if not known(first[at], last[at + window - 1]))
                elif known(*run.span()):
                    continue
                else:
                    starts = (run.start() + at for at in hot_starts(run[0], window, threshold))
                hot += _united((at, at + window) for at in starts)
        for start, end in _united(sorted(hot)):
            kind = next(name for name, alphabet, _ in CLASSES if alphabet.fullmatch(candidate, start, end))
            found.append((match.start() + start, match.start() + end, kind))
    return found


def _token_bounds(candidate: str) -> tuple[array, array]:
    """Per character the start and the end of its token; '=' and '/' stand alone."""
    first, last = array("i"), array("i")
    for token in TOKEN.finditer(candidate):
        size = token.end() - token.start()
        first.extend(array("i", [token.start()]) * size)
        last.extend(array("i", [token.end()]) * size)
    return first, last


def _joined(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], ORDER[s[2]], s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def scan_secrets(
    docs: DataFrame,
    allow: Sequence[str] = ALLOWED,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy.

    Positions are code points, ends exclusive. A NULL or empty text has no
    spans and the hash of the empty string. Repeated rows stay repeated.
    """

    def make():
        rules = [re.compile(rule) for rule in allow]
        candidates = re.compile(rf"[A-Za-z0-9+/_=-]{{{window},}}")

        def work(texts: list[str]) -> list[tuple]:
            rows = []
            for text in texts:
                base = base_spans(text)
                extra = entropy_spans(text, candidates, rules, window)
                kinds = [s[2] for s in base]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                counts = (kinds.count("assign"), kinds.count("access"), kinds.count("hex"))
                rows.append((*counts, digest, _joined(base + extra), len(extra)))
            return rows

        return work

    schema = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_entropy bigint"
    return map_texts(keyed_texts(docs, id_col, text_col), make, schema)
