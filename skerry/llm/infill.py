"""Fill-in-the-middle rearrangement of texts on UTF-8 bytes.

Cuts lie at line ends, found as bytes; lengths are stated in code points. A
sparse index turns one into the other: it records the characters of more than one
byte only, each with the bytes it has over one, and a binary search in it finds
how many of these lie before a cut. Between two of them the conversion is an
addition, and a text in ASCII has an empty index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skerry.llm.shared import SLICE_ROWS

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FIELDS = "n long, form string, prefix_chars long, middle_chars long, output string"


class ByteIndex:
    """Characters of more than one byte in `raw`: where they start, in bytes and in code points, and their excess."""

    def __init__(self, raw: np.ndarray) -> None:
        self.at = np.flatnonzero(raw >= 0xC0)
        lead = raw[self.at]
        over = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        # excess[k]: bytes over one each of the first k such characters.
        self.excess = np.concatenate([[0], np.cumsum(over)])
        self.chars_at = self.at - self.excess[:-1]

    def chars(self, byte: int) -> int:
        """Code points before a byte position at which a character starts."""
        return int(byte - self.excess[np.searchsorted(self.at, byte)])

    def bytes(self, char: int) -> int:
        """Byte position of a code point."""
        return int(char + self.excess[np.searchsorted(self.chars_at, char)])


def line_ends(raw: np.ndarray) -> np.ndarray:
    """Byte positions right after each line; the last line needs no line feed."""
    ends = np.flatnonzero(raw == 10) + 1
    return ends if not raw.size or (ends.size and ends[-1] == raw.size) else np.append(ends, raw.size)


class Plan(NamedTuple):
    """How the rearrangement is drawn: seed of the hash, per cent of texts rearranged, per cent of these suffix first.

    Cuts fall between units, which are lines or single characters ("char").
    """

    seed: int = 7
    share: int = 100
    suffix_first: int = 50
    unit: str = "line"


class Piece(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def rearrange(text: bytes, key: str, plan: Plan = Plan()) -> Piece:
    """One text cut into prefix, middle and suffix between units, drawn from a hash of `key`.

    Empty texts, texts that hold a marker and those not drawn stay plain.
    """
    raw = np.frombuffer(text, np.uint8)
    index = ByteIndex(raw)
    ends = line_ends(raw) if plan.unit == "line" else None
    n = index.chars(raw.size) if ends is None else len(ends)
    digest = hashlib.sha256(f"{plan.seed}:{key}".encode()).hexdigest()
    one, two, drawn, order = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or drawn % 100 >= plan.share:
        return Piece(n, PLAIN, None, None, text)
    first, second = sorted((one % (n + 1), two % (n + 1)))
    if ends is None:
        a, b = index.bytes(first), index.bytes(second)
    else:
        a, b = (int(ends[cut - 1]) if cut else 0 for cut in (first, second))
    start = index.chars(a)
    head, middle, tail = text[:a], text[a:b], text[b:]
    if order % 100 < plan.suffix_first:
        form, output = SPM, SUFFIX + tail + PREFIX + head + MIDDLE + middle
    else:
        form, output = PSM, PREFIX + head + SUFFIX + tail + MIDDLE + middle
    return Piece(n, form, start, index.chars(b) - start, output)


def rebuild(output: bytes, form: str) -> bytes:
    """The text a rearranged one was made of. No marker starts inside another, so the first of each is the inserted one."""
    if form == PLAIN:
        return output
    left, rest = output[len(PREFIX):].split(SUFFIX if form == PSM else PREFIX, 1)
    right, middle = rest.split(MIDDLE, 1)
    return left + middle + right if form == PSM else right + middle + left


def _map(df: DataFrame, keep: list[str], fields: str, make: Callable[[list[pa.Array]], list[pa.Array]]) -> DataFrame:
    """The columns `keep` and new ones made from all columns of `df`, a few rows at a time."""
    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    at = [df.columns.index(c) for c in keep]
    names = [*keep, *(f.split()[0] for f in fields.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in at), *make(part.columns)], names=names)

    return df.mapInArrow(run, f"{kept}, {fields}")


def _utf8(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def fill_in_middle(docs: DataFrame, plan: Plan = Plan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n (lines), form (plain, psm or spm), prefix_chars, middle_chars (NULL if plain) and `output`.

    Cuts are drawn from the seed and the id alone, so repeated rows give equal
    results. A missing id draws like an empty one; NULL texts are empty. Other
    columns of `docs` are not read. A text must fit a task.
    """
    def make(columns: list[pa.Array]) -> list[pa.Array]:
        keys = ["" if k is None else str(k) for k in columns[0].to_pylist()]
        pieces = [rearrange(t, k, plan) for t, k in zip(_utf8(columns[1]), keys)]
        n, form, prefix, middle, output = zip(*pieces)
        whole = pa.array(output, pa.binary()).cast(pa.string())
        return [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), whole]

    return _map(docs.select(f"`{id_col}`", f"`{text_col}`"), [id_col], FIELDS, make)


def restore(df: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """`df` with `restored`, the text before the rearrangement, from output and form alone."""
    at, kind = df.columns.index(output_col), df.columns.index(form_col)

    def make(columns: list[pa.Array]) -> list[pa.Array]:
        texts = [rebuild(t, f) for t, f in zip(_utf8(columns[at]), columns[kind].to_pylist())]
        return [pa.array(texts, pa.binary()).cast(pa.string())]

    return _map(df, df.columns, "restored string", make)
