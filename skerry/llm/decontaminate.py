"""Benchmark passages in documents, by a generalised suffix automaton over the words of the test items.

The items' words become numbers; all items are entered into one suffix
automaton. A document streams through it word by word: the state and the length
of the longest suffix of what was read that occurs in some item. A length of at
least `window` means that the last `window` words are a window of an item; a
shorter item counts as one window and is recognised at the state of its whole.

Items are dealt into blocks of at most `block_words` words, one automaton and
one pass per block, so that neither driver nor executors hold more than one
block however large the benchmark grows. Each block is broadcast; its bound is
`block_words` (a single longer item makes a block of its own).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from skerry.llm.shared import SLICE_ROWS, keyed_texts, map_slices, stored, with_values

WINDOW = 10
BLOCK_WORDS = 250_000
# Bytes of words: digits, a to z, everything above ASCII. Upper-case ASCII is lowered, the rest separates.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split(b" ") if text else []


class Automaton:
    """Generalised suffix automaton of word sequences with the windows marked at their states."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        self.window = window
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for item, text in items:
            words = [self.number.setdefault(w, len(self.number)) for w in words_of(text) if w]
            if words:
                sequences.append((item, words))
        for _, words in sequences:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._mark(sequences)

    def _clone(self, state: int, length: int) -> int:
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.length.append(length)
        return len(self.next) - 1

    def _redirect(self, state: int, word: int, old: int, new: int) -> None:
        while state != -1 and self.next[state].get(word) == old:
            self.next[state][word] = new
            state = self.link[state]

    def _extend(self, last: int, word: int) -> int:
        """Enter one more word after the state `last`; the state of the longer sequence comes back."""
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            split = self._clone(known, self.length[last] + 1)
            self.link[known] = split
            self._redirect(last, word, known, split)
            return split
        new = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        state = last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state != -1:
            target = self.next[state][word]
            if self.length[target] != self.length[state] + 1:
                split = self._clone(target, self.length[state] + 1)
                self.link[target] = split
                self._redirect(state, word, target, split)
                target = split
            self.link[new] = target
        return new

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest match after one more word of a document."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if word in self.next[state]:
            return self.next[state][word], length + 1
        return 0, 0

    def _mark(self, sequences: list[tuple[int, list[int]]]) -> None:
        """At the state of each window: its length and the items that hold it; and per state the windows ending there."""
        size, holders = len(self.next), {}
        for item, words in sequences:
            state, length = 0, 0
            for at, word in enumerate(words):
                state, length = self.step(state, length, word)
                wanted = self.window if len(words) >= self.window else len(words)
                if at + 1 < wanted:
                    continue
                own = state
                while self.length[self.link[own]] >= wanted:
                    own = self.link[own]
                holders.setdefault((own, wanted), set()).add(item)
        self.windows: list[list[tuple[int, frozenset]]] = [[] for _ in range(size)]
        for (state, wanted), items in holders.items():
            self.windows[state].append((wanted, frozenset(items)))
        # Shorter windows that end at the same place stand at the ancestors.
        for state in sorted(range(1, size), key=self.length.__getitem__):
            self.windows[state] = self.windows[state] + self.windows[self.link[state]]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """United [start, end) word ranges covered by windows, and the items whose windows occur."""
        spans: list[list[int]] = []
        items: set = set()
        find, follow, links, lengths, marks = self.number.get, self.next, self.link, self.length, self.windows
        state = length = 0
        for at, word in enumerate(words):
            number = find(word)
            if number is None:
                state = length = 0
                continue
            to = follow[state].get(number)
            while to is None and state:
                state = links[state]
                length = lengths[state]
                to = follow[state].get(number)
            if to is None:
                state = length = 0
                continue
            state, length = to, length + 1
            reach = 0
            for wanted, holders in marks[state]:
                if wanted <= length:
                    items |= holders
                    reach = max(reach, wanted)
            if reach:
                start = at + 1 - reach
                while spans and start <= spans[-1][1]:
                    start = min(start, spans.pop()[0])
                spans.append([start, at + 1])
        return [(a, b) for a, b in spans], items


_BUILT: list = []


def automaton_of(items: list[tuple[str | None, str | None]], window: int) -> Automaton:
    """The automaton of a broadcast block of items, built once per worker and not per task; the last one is kept."""
    if not _BUILT or _BUILT[0] is not items or _BUILT[1] != window:
        _BUILT.clear()  # before the next one is built, so that two are never held
        _BUILT.extend((items, window, Automaton(items, window)))
    return _BUILT[2]


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> tuple[DataFrame, int]:
    """Items with a block number; the blocks hold about `block_words` words at most."""
    size = F.size(F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), r"[^0-9A-Za-z\u0080-\x{10FFFF}]+")).cast("long")
    items = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text"), size.alias("n"))
    total = items.agg(F.sum("n").alias("n")).first()["n"] or 0
    blocks = int(total // max(1, block_words // 2) + 1)
    # Half full on average, so that uneven dealing stays inside the bound.
    return items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), blocks


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (word ranges start:end).

    A NULL or empty text has no words and no hits; an item without words has no
    windows; an empty benchmark hits nothing. Equal items each count under
    their own id, an id on several rows counts once, a NULL id not at all among
    n_items and items_sha256. Repeated documents give repeated rows.
    """
    items, blocks = _item_blocks(benchmark, item_col, item_text_col, block_words)
    texts = keyed_texts(docs, id_col, text_col)
    parts = [_scan_block(texts, items, block, window) for block in range(blocks)]
    found = parts[0] if blocks == 1 else _merge_blocks(reduce(DataFrame.unionByName, parts), blocks)
    listed = F.array_sort("items")
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))).alias("spans"),
    )


FOUND = "text_key string, n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>"


def _scan_block(texts: DataFrame, items: DataFrame, block: int, window: int) -> DataFrame:
    rows = items.where(F.col("block") == block).select(F.col("item_id").cast("string"), "text").collect()
    held = texts.sparkSession.sparkContext.broadcast([(r["item_id"], r["text"]) for r in rows])
    types = to_arrow_schema(StructType.fromDDL(f"doc_id bigint, {FOUND}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(held.value, window)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part, rows = batch.slice(start, SLICE_ROWS), []
                for text in part.column("text").to_pylist():
                    words = [w for w in words_of(text) if w]
                    spans, found = automaton.hits(words)
                    named = sorted(i for i in found if i is not None)
                    key = hashlib.blake2b(text.encode(), digest_size=16).hexdigest()
                    rows.append((key, len(words), [{"start": a, "end": b} for a, b in spans], named))
                columns = [pa.array(v, t) for v, t in zip(zip(*rows), types.types[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], schema=types)

    return texts.mapInArrow(run, f"doc_id bigint, {FOUND}")


def _merge_blocks(found: DataFrame, blocks: int) -> DataFrame:
    """Unite the word ranges and items that the blocks found in one document; each row came once per block."""
    united = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    merged = found.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"),
        united.alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        (F.count("*") / blocks).cast("int").alias("rows"),
    )
    return merged.withColumn("row", F.explode(F.sequence(F.lit(1), "rows")))


def clean_text(text: str, automaton: Automaton, max_coverage: float) -> str | None:
    """`text` without the passages found, again and again until none is left; None above the coverage limit."""
    while text is not None:
        spans, _ = automaton.hits([w for w in words_of(text) if w])
        if not spans:
            return text
        text = cut_spans(text, spans, max_coverage)
    return None


def cut_spans(text: str, spans: list[tuple[int, int]], max_coverage: float) -> str | None:
    """`text` without these united word ranges; None if they cover more than `max_coverage` of its words."""
    raw = text.encode()
    bounds, at = [], 0
    for piece in raw.translate(WORD_BYTES).split(b" "):
        if piece:
            bounds.append((at, at + len(piece)))
        at += len(piece) + 1
    if sum(b - a for a, b in spans) > max_coverage * len(bounds):
        return None
    kept, done = [], 0
    for a, b in spans:
        kept.append(raw[done : bounds[a][0]])
        done = bounds[b - 1][1]
    return b"".join([*kept, raw[done:]]).decode()


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            a, b = out[-1][0], max(b, out.pop()[1])
        out.append((a, b))
    return out


def remove_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    length_col: str | None = None,
) -> DataFrame:
    """The rows of `docs` with found passages cut out; rows covered above `max_coverage` go.

    A cut may bring words together that form a window anew; it is repeated
    until nothing of any block of items is found. Each round unites the passages
    of all blocks before it judges the coverage and cuts, so the number of
    blocks changes nothing. `length_col`, if given, is set to the new number of
    characters of changed texts. Other columns stay, NULL texts stay.
    """
    items, blocks = _item_blocks(benchmark, item_col, item_text_col, block_words)
    if blocks == 1:
        return _clean_block(docs, _held(items, 0), window, max_coverage, text_col, length_col)
    none = F.lit(None).cast("array<struct<start: bigint, end: bigint>>")
    done, rest = [], docs.withColumn(SPANS, none)
    while True:
        for block in range(blocks):
            # One automaton at a time: the passes of several blocks are kept apart by a written table.
            held = _held(items, block)
            rest = stored(_mark_block(rest, held, window, text_col), "decontaminate")
            held.destroy()
        done.append(rest.where(F.size(SPANS) == 0).drop(SPANS))
        found = rest.where(F.size(SPANS) > 0)
        if found.isEmpty():
            return reduce(DataFrame.unionByName, done).select(*[f"`{c}`" for c in docs.columns])
        rest = stored(_cut_marked(found, max_coverage, text_col, length_col), "decontaminate")


SPANS = "__spans"


def _held(items: DataFrame, block: int) -> Broadcast:
    rows = items.where(F.col("block") == block).select(F.col("item_id").cast("string"), "text").collect()
    return items.sparkSession.sparkContext.broadcast([(r["item_id"], r["text"]) for r in rows])


def _mark_block(docs: DataFrame, held: Broadcast, window: int, text_col: str) -> DataFrame:
    """`docs` with the passages of one block united with those marked already."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        automaton = automaton_of(held.value, window)

        def mark(part: pa.RecordBatch) -> pa.RecordBatch:
            marked = []
            for text, known in zip(part.column(text_col).to_pylist(), part.column(SPANS).to_pylist()):
                spans, _ = automaton.hits([w for w in words_of(text) if w])
                spans = united(spans + [(s["start"], s["end"]) for s in known or []])
                marked.append([{"start": a, "end": b} for a, b in spans])
            return with_values(part, SPANS, marked)

        return mark

    return map_slices(docs, make)


def _cut_marked(docs: DataFrame, max_coverage: float, text_col: str, length_col: str | None) -> DataFrame:
    """Marked rows with their passages cut and no marks; rows covered above the limit go."""

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        spans = [[(s["start"], s["end"]) for s in marked] for marked in part.column(SPANS).to_pylist()]
        new = [cut_spans(t, s, max_coverage) for t, s in zip(part.column(text_col).to_pylist(), spans)]
        part = with_values(with_values(part, text_col, new), SPANS, [None] * part.num_rows)
        if length_col:
            part = with_values(part, length_col, [None if n is None else len(n) for n in new])
        return part.filter(pa.array([n is not None for n in new], pa.bool_()))

    return map_slices(docs, lambda: cut)


def _clean_block(
    docs: DataFrame, held: Broadcast, window: int, max_coverage: float, text_col: str, length_col: str | None
) -> DataFrame:
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        automaton = automaton_of(held.value, window)

        def clean(part: pa.RecordBatch) -> pa.RecordBatch:
            old = part.column(text_col).to_pylist()
            new = [t if t is None else clean_text(t, automaton, max_coverage) for t in old]
            part = with_values(part, text_col, new)
            if length_col:
                size = part.column(length_col).to_pylist()
                size = [s if n is None or n == o else len(n) for s, o, n in zip(size, old, new)]
                part = with_values(part, length_col, size)
            return part.filter(pa.array([n is not None or o is None for o, n in zip(old, new)], pa.bool_()))

        return clean

    return map_slices(docs, make)


def items_digest(items: list[int]) -> str:
    """The digest `find_contamination` gives for these items."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
