"""Exact substring deduplication: bytes covered by an earlier equal string of `length` bytes are removed.

Only the first `length` bytes of suffixes matter, so the work of a blockwise
suffix sort is done on hashes of prefixes, one bucket of suffixes at a time:

1. Documents are packed into blocks, sorted by id, compressed, and stored.
2. Cover sample: positions whose offset in the document lies in a difference
   cover modulo `PERIOD`. Two equal strings at any two offsets have a sampled
   position at one common shift below `PERIOD`. Samples are ranked by the
   `length - PERIOD + 1` bytes after them: equal bytes, equal rank, the rank
   being the earliest position that has them. A first pass with short hashes
   finds the samples that repeat at all; documents without one are done.
3. Long ties are decided by the ranks: three samples of a document, `PERIOD`
   apart, whose ranks lie on one diagonal of one earlier document, prove that
   everything between them repeats, without looking at bytes.
4. The suffixes that are left (at the rims of repeats, and first copies) are
   dealt into buckets by the hash of their prefix and sorted bucket by bucket,
   first by short hashes, then those with a possible equal by full ones; all but
   the earliest of equal ones are repeats.

Every message names a hash once per block, with its earliest position there: a
passage that stands in a third of all documents costs a bucket one entry per
block, not per document. Answers come back in the order of the message. A task
holds one block or one bucket. Hashes have 64 bits, and equality is only asked
inside a bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from skerry.llm.shared import SLICE_ROWS, keyed_texts, stored

LENGTH = 100
PERIOD = 31
# Text bytes of a block, and hashes of a bucket.
BLOCK_BYTES = 4_000_000
BUCKET_HASHES = 2_000_000
SEGMENT = 1 << 20
# Short hashes only sort out what cannot repeat; chance meetings cost work, not correctness.
SHORT_BITS = 28
NO_ID = -(2**63)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def difference_cover(period: int) -> np.ndarray:
    """A small set of residues such that every residue is a difference of two of them, found greedily with backtracking."""

    def grow(chosen: list[int], most: int) -> list[int] | None:
        covered = {(a - b) % period for a in chosen for b in chosen}
        if len(covered) == period:
            return chosen
        if len(chosen) == most or len(covered) + 2 * sum(range(len(chosen), most)) < period:
            return None
        return next(filter(None, (grow([*chosen, c], most) for c in range(chosen[-1] + 1, period))), None)

    size = 1
    while (found := grow([0], size)) is None:
        size += 1
    return np.array(found)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _name(block: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A 64-bit name of a document from its block and its place there."""
    return _mix(block.astype(np.uint64) * GOLDEN + doc.astype(np.uint64))


class PrefixHash:
    """Hashes of the `length` bytes at given positions, from running sums of powers modulo 2^64."""

    def __init__(self, length: int, seed: int = 3) -> None:
        draw = np.random.default_rng(seed)
        self.length = length
        self.table = draw.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(draw.integers(2**40, 2**62)) * 8 + 5
        size = SEGMENT + length + 1
        self.power = self._powers(base, size)
        self.inverse = self._powers(pow(base, -1, 2**64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps)

    def __call__(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """`places` ascend; the data is looked at one segment at a time."""
        out = np.empty(len(places), np.uint64)
        for start in range(0, len(data), SEGMENT):
            lo, hi = np.searchsorted(places, (start, start + SEGMENT))
            if lo == hi:
                continue
            part = data[start : start + SEGMENT + self.length]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.table[part] * self.power[: len(part)], out=sums[1:])
            at = places[lo:hi] - start
            out[lo:hi] = _mix((sums[at + self.length] - sums[at]) * self.inverse[at])
        return out


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length in one value: differences, their bytes by significance, compressed."""
    planes = []
    for array in arrays:
        whole = np.ascontiguousarray(array).view(f"u{array.dtype.itemsize}")
        steps = np.diff(whole, prepend=whole.dtype.type(0))
        planes.append(steps.view(np.uint8).reshape(-1, whole.dtype.itemsize).T.tobytes())
    return len(arrays[0]).to_bytes(8, "little") + squeeze(b"".join(planes), 3)


def unpack(value: bytes, *types: str) -> list[np.ndarray]:
    count, raw = int.from_bytes(value[:8], "little"), unsqueeze(value[8:])
    out, at = [], 0
    for kind in map(np.dtype, types):
        planes = np.frombuffer(raw, np.uint8, kind.itemsize * count, at).reshape(kind.itemsize, count)
        steps = np.ascontiguousarray(planes.T).view(f"u{kind.itemsize}").ravel()
        out.append(np.cumsum(steps, dtype=steps.dtype).view(kind))
        at += kind.itemsize * count
    return out


def squeeze(raw: bytes, level: int = 9) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", level).compress(raw, asbytes=True)


def unsqueeze(value: bytes) -> bytes:
    return pa.decompress(value[8:], int.from_bytes(value[:8], "little"), codec="zstd", asbytes=True)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _emit(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types.types)], schema=types)


PACKED = "block bigint, ids array<bigint>, sizes array<bigint>, hashes array<string>, data binary"


def packed_blocks(texts: DataFrame, block_bytes: int) -> DataFrame:
    """Documents in blocks of about `block_bytes`, inside a block by id; the id of a NULL is the least."""
    types = to_arrow_schema(StructType.fromDDL(PACKED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def close() -> pa.RecordBatch:
            held.sort(key=lambda d: (d[0] is not None, d[0] or 0))
            ids, bodies = [d[0] for d in held], [d[1] for d in held]
            digests = [hashlib.sha256(b).hexdigest() for b in bodies]
            return _emit([(number, ids, list(map(len, bodies)), digests, squeeze(b"".join(bodies)))], types)

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    held.append((doc, text.encode()))
                    size += len(held[-1][1])
                    if size >= block_bytes:
                        yield close()
                        number, held, size = number + 1, [], 0
        if held:
            yield close()

    return texts.mapInArrow(run, PACKED)


class Cover:
    """The cover sample of a string length."""

    def __init__(self, length: int) -> None:
        self.period = min(PERIOD, (length + 1) // 2)
        self.length, self.width = length, length - self.period + 1
        self.residues = difference_cover(self.period)

    def places(self, sizes: np.ndarray) -> np.ndarray:
        """Sampled positions of documents laid end to end; documents shorter than the string have none."""
        starts = np.cumsum(sizes) - sizes
        longest = int(sizes.max(initial=0))
        rounds = np.arange(0, longest + self.period, self.period)
        offsets = (rounds[:, None] + self.residues).ravel()
        ends = np.searchsorted(offsets, np.where(sizes >= self.length, sizes - self.width + 1, 0))
        return np.concatenate([s + offsets[:e] for s, e in zip(starts, ends)] or [np.empty(0, np.int64)])


def _by_bucket(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Bucket numbers and the indices that belong to them, in their order."""
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.uint64)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, edges) if len(order) else []:
        yield int(bucket[part[0]]), part


MESSAGE = "kind string, block bigint, bucket int, data binary"
ANSWER = "block bigint, bucket int, data binary"


def short(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint32) & np.uint32((1 << SHORT_BITS) - 1)


def short_messages(kind: str, block: int, hashes: np.ndarray, buckets: int) -> list[tuple]:
    """Per bucket the short hashes of a block, each once, and whether it repeats inside the block."""
    hashes, counts = np.unique(hashes, return_counts=True)
    out = []
    for bucket, part in _by_bucket(hashes, buckets):
        found, back = np.unique(short(hashes[part]), return_inverse=True)
        out.append((kind, block, bucket, pack(found, np.bincount(back, counts[part]) > 1)))
    return out


def told_again(hashes: np.ndarray, answers: list | None, buckets: int) -> np.ndarray:
    """Which hashes the buckets have named as repeated."""
    hit = np.zeros(len(hashes), bool)
    told = {a["bucket"]: a["data"] for a in answers or []}
    for bucket, part in _by_bucket(hashes, buckets):
        if bucket in told:
            hit[part] = np.isin(short(hashes[part]), unpack(told[bucket], "u4")[0])
    return hit


def sample_messages(packed: DataFrame, cover: Cover, buckets: int) -> DataFrame:
    """Per block and bucket the short hashes of its samples."""
    types = to_arrow_schema(StructType.fromDDL(MESSAGE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = PrefixHash(cover.width)
        for row in _rows(batches):
            data, sizes = np.frombuffer(unsqueeze(row["data"]), np.uint8), np.array(row["sizes"], np.int64)
            out = short_messages("short", row["block"], prefix(data, cover.places(sizes)), buckets)
            if out:
                yield _emit(out, types)

    return packed.select("block", "sizes", "data").mapInArrow(run, MESSAGE)


def _group_answer(work: Callable[[pa.Table], list[tuple]]):
    types = to_arrow_schema(StructType.fromDDL(ANSWER))

    def run(table: pa.Table) -> pa.Table:
        rows = work(table)
        return pa.table([pa.array(v, t) for v, t in zip(zip(*rows) if rows else [[], [], []], types.types)], schema=types)

    return run


def _messages(table: pa.Table, *types: str) -> tuple[np.ndarray, int, list[list[np.ndarray]], np.ndarray]:
    """Blocks of the messages, the bucket, their arrays joined, and where each message begins."""
    blocks = table.column("block").to_numpy()
    parts = [unpack(v, *types) for v in table.column("data").to_pylist()]
    starts = np.append(0, np.cumsum([len(p[0]) for p in parts]))
    return blocks, table.column("bucket")[0].as_py(), [np.concatenate(c) for c in zip(*parts)], starts


def _repeated(table: pa.Table) -> list[tuple]:
    """Per message the short hashes that another block has too, or that repeat in their own."""
    blocks, bucket, (values, often), starts = _messages(table, "u4", "?")
    order = np.argsort(values, kind="stable")
    same = np.zeros(len(values) + 1, bool)
    same[1:-1] = values[order][1:] == values[order][:-1]
    again = np.empty(len(values), bool)
    again[order] = same[1:] | same[:-1]
    again |= often
    out = []
    for block, start, end in zip(blocks, starts[:-1], starts[1:]):
        found = values[start:end][again[start:end]]
        if len(found):
            out.append((int(block), bucket, pack(found)))
    return out


def gathered(answers: DataFrame, name: str = "answers") -> DataFrame:
    """All answers to one block; there are at most as many as it sent messages."""
    return answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "data")).alias(name))


class Rest:
    """What is kept of a block after the first pass: its documents with repeated samples."""

    def __init__(self, row: dict) -> None:
        self.block = row["block"]
        index, ids, sizes = unpack(row["docs"], "i8", "i8", "i8")
        self.index, self.ids, self.sizes = index, ids, sizes
        self.starts = np.cumsum(sizes) - sizes
        self.data = np.frombuffer(unsqueeze(row["data"]), np.uint8)
        self.places = unpack(row["places"], "i8")[0]

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1

    def first_ones(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the first of equal hashes, ascending, and for every hash the number of its first."""
        _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        order = np.argsort(first)
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        return first[order], number[back]

    def messages(self, kind: str, hashes: np.ndarray, places: np.ndarray, buckets: int) -> list[tuple]:
        """(kind, block, bucket, data): hash, id, document and offset, in the order of their places."""
        doc = self.doc_of(places)
        ids, offset = self.ids[doc], (places - self.starts[doc]).astype(np.uint32)
        return [
            (kind, self.block, bucket, pack(hashes[p], ids[p], self.index[doc[p]], offset[p]))
            for bucket, p in _by_bucket(hashes, buckets)
        ]


REST = "block bigint, docs binary, data binary, places binary"


def kept_rests(packed: DataFrame, answers: DataFrame, cover: Cover, buckets: int) -> DataFrame:
    """One `Rest` per block: the documents with samples that repeat, and the places of these."""
    types = to_arrow_schema(StructType.fromDDL(REST))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = PrefixHash(cover.width)
        for row in _rows(batches):
            data, sizes = np.frombuffer(unsqueeze(row["data"]), np.uint8), np.array(row["sizes"], np.int64)
            places = cover.places(sizes)
            places = places[told_again(prefix(data, places), row["answers"], buckets)]
            starts = np.cumsum(sizes) - sizes
            doc = np.searchsorted(starts, places, side="right") - 1
            # Empty documents share their start with the next one; the last of equal starts has the bytes.
            index = np.unique(doc)
            ids = np.array([NO_ID if i is None else i for i in row["ids"]], np.int64)
            kept = sizes[index]
            body = b"".join(data[starts[i] : starts[i] + sizes[i]].tobytes() for i in index)
            moved = places + ((np.cumsum(kept) - kept) - starts[index])[np.searchsorted(index, doc)]
            docs = pack(index.astype(np.int64), ids[index], kept)
            yield _emit([(row["block"], docs, squeeze(body), pack(moved))], types)

    joined = packed.select("block", "ids", "sizes", "data").join(gathered(answers), "block")
    return joined.mapInArrow(run, REST)


def rank_messages(rests: DataFrame, cover: Cover, buckets: int) -> DataFrame:
    """Per block and bucket the full hashes of the samples of a rest."""
    types = to_arrow_schema(StructType.fromDDL(MESSAGE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix = PrefixHash(cover.width)
        for row in _rows(batches):
            rest = Rest(row)
            hashes = prefix(rest.data, rest.places)
            first, _ = rest.first_ones(hashes)
            yield _emit(rest.messages("sample", hashes[first], rest.places[first], buckets), types)

    return rests.mapInArrow(run, MESSAGE)


def _earliest(table: pa.Table) -> tuple[np.ndarray, int, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """For every message entry the index of the earliest entry with its hash, over all blocks, and how many there are."""
    blocks, bucket, (hashes, ids, doc, offset), starts = _messages(table, "u8", "i8", "i8", "u4")
    block = np.repeat(blocks, np.diff(starts))
    order = np.lexsort((offset, doc, block, ids, hashes))
    new = np.append(True, hashes[order][1:] != hashes[order][:-1])
    group = np.cumsum(new) - 1
    first = np.empty(len(order), np.int64)
    first[order] = order[np.flatnonzero(new)[group]]
    return blocks, bucket, first, starts, (block, doc, offset)


def _ranks(table: pa.Table) -> list[tuple]:
    """Per message, in its order: the document and offset of the earliest equal sample, and whether another block has it."""
    blocks, bucket, first, starts, (block, doc, offset) = _earliest(table)
    several = np.bincount(first, minlength=len(first))[first] > 1
    name = _name(block, doc)[first]
    return [
        (int(b), bucket, pack(name[s:e], offset[first[s:e]], several[s:e]))
        for b, s, e in zip(blocks, starts[:-1], starts[1:])
    ]


def _mine(table: pa.Table) -> list[tuple]:
    """Per message, in its order: whether the entry is the earliest of all."""
    blocks, bucket, first, starts, _ = _earliest(table)
    own = first == np.arange(len(first))
    return [(int(b), bucket, pack(own[s:e])) for b, s, e in zip(blocks, starts[:-1], starts[1:])]


def _told(
    rest: Rest, hashes: np.ndarray, answers: list | None, buckets: int, *types: str
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """First ones, their numbers per entry, and the answers put back into the order of the first ones."""
    first, number = rest.first_ones(hashes)
    told = {a["bucket"]: a["data"] for a in answers or []}
    out = [np.zeros(len(first), t) for t in types]
    for bucket, part in _by_bucket(hashes[first], buckets):
        for whole, piece in zip(out, unpack(told[bucket], *types)):
            whole[part] = piece
    return first, number, out


def _covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True at the positions inside any [start, end)."""
    step = np.zeros(size + 1, np.int32)
    np.add.at(step, starts, 1)
    np.subtract.at(step, ends, 1)
    return np.cumsum(step, out=step)[:size] > 0


def _edges(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    turn = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def proven_and_open(rest: Rest, row: dict, cover: Cover, prefix: PrefixHash, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of strings that the ranks prove to be repeats, and of those that are open (both as masks)."""
    places, size = rest.places, len(rest.data)
    hashes = prefix(rest.data, places)
    first, number, (name, source, several) = _told(rest, hashes, row["answers"], buckets, "u8", "u4", "?")
    doc = rest.doc_of(places)
    offset = places - rest.starts[doc]
    own = _name(np.full(len(doc), rest.block), rest.index[doc])
    repeated = several[number] | (np.bincount(number, minlength=len(first))[number] > 1)
    later = repeated & ~((name[number] == own) & (source[number] == offset))
    # A diagonal is the earlier document and the distance in offsets.
    diagonal = _mix(name[number] + (offset - source[number].astype(np.int64)).astype(np.uint64) * GOLDEN)
    at = np.searchsorted(places, places + cover.period)
    nxt = np.minimum(at, len(places) - 1)
    chained = later & later[nxt] & (at < len(places)) & (places[nxt] == places + cover.period)
    chained &= (doc[nxt] == doc) & (diagonal[nxt] == diagonal)
    third = chained & chained[nxt]
    last = places + 2 * cover.period + cover.width - cover.length  # the last string inside three samples
    proven = _covered(size, places[third], np.maximum(last[third], places[third]) + 1)
    lowest = np.maximum(places - cover.period + 1, rest.starts[doc])
    final = rest.starts[doc] + rest.sizes[doc] - cover.length
    highest = np.minimum(places, final)
    some = repeated & (highest >= lowest)
    return proven, _covered(size, lowest[some], highest[some] + 1) & ~proven


def open_suffixes(rests: DataFrame, answers: DataFrame, cover: Cover, buckets: int) -> DataFrame:
    """Rows of kind `proven` and `open` (runs of such starts) and `short` (messages of the open ones)."""
    types = to_arrow_schema(StructType.fromDDL(MESSAGE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, whole = PrefixHash(cover.width), PrefixHash(cover.length)
        for row in _rows(batches):
            rest = Rest(row)
            proven, left = proven_and_open(rest, row, cover, prefix, buckets)
            out = [("proven", rest.block, -1, pack(*_edges(proven))), ("open", rest.block, -1, pack(*_edges(left)))]
            out += short_messages("short", rest.block, whole(rest.data, np.flatnonzero(left)), buckets)
            yield _emit(out, types)

    return rests.join(gathered(answers), "block").mapInArrow(run, MESSAGE)


def left_open(rest: Rest, row: dict, whole: PrefixHash, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the open suffixes whose short hash repeats; the others have no equal."""
    places = np.flatnonzero(_covered(len(rest.data), *unpack(row["open"], "i8", "i8")))
    hashes = whole(rest.data, places)
    hit = told_again(hashes, row["again"], buckets)
    return places[hit], hashes[hit]


def suffix_messages(open_rests: DataFrame, cover: Cover, buckets: int) -> DataFrame:
    """Per block and bucket the full hashes of the open suffixes that may have an equal."""
    types = to_arrow_schema(StructType.fromDDL(MESSAGE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = PrefixHash(cover.length)
        for row in _rows(batches):
            rest = Rest(row)
            places, hashes = left_open(rest, row, whole, buckets)
            first, _ = rest.first_ones(hashes)
            out = rest.messages("suffix", hashes[first], places[first], buckets)
            if out:
                yield _emit(out, types)

    return open_rests.where("again IS NOT NULL").mapInArrow(run, MESSAGE)


RESULT = "block bigint, at bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def removals(open_rests: DataFrame, answers: DataFrame, cover: Cover, buckets: int, keep_text: bool) -> DataFrame:
    """(block, at, n_removed, n_spans, kept_sha256) of every document of a rest; `kept` bytes follow if asked for."""
    schema = RESULT + ", kept binary" * keep_text
    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = PrefixHash(cover.length)
        for row in _rows(batches):
            rest = Rest(row)
            size = len(rest.data)
            repeats = _covered(size, *unpack(row["proven"], "i8", "i8"))
            places, hashes = left_open(rest, row, whole, buckets)
            first, number, (mine,) = _told(rest, hashes, row["answers"], buckets, "?")
            earliest = mine[number] & (first[number] == np.arange(len(places)))
            repeats[places[~earliest]] = True
            starts, ends = _edges(repeats)
            gone = _covered(size, starts, ends - 1 + cover.length)
            out = []
            for at, start, length in zip(rest.index, rest.starts, rest.sizes):
                mask = gone[start : start + length]
                kept = rest.data[start : start + length][~mask].tobytes()
                digest = hashlib.sha256(kept).hexdigest()
                spans = len(_edges(mask)[0])
                out.append((rest.block, int(at), int(mask.sum()), spans, digest, *([kept] if keep_text else [])))
                if len(out) >= SLICE_ROWS:
                    yield _emit(out, types)
                    out = []
            if out:
                yield _emit(out, types)

    return open_rests.join(gathered(answers), "block", "left").mapInArrow(run, schema)


def deduplicate(
    docs: DataFrame,
    length: int = LENGTH,
    block_bytes: int = BLOCK_BYTES,
    bucket_hashes: int = BUCKET_HASHES,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_text: bool = False,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, over the UTF-8 bytes of the text.

    Removed is each byte covered by a `length`-byte string that also starts
    earlier: in a row with a smaller doc_id, or before in the same row. A NULL
    id comes before all others; rows of equal id are in the order they were
    packed. Texts shorter than `length`, NULL and empty ones lose nothing.
    `keep_text` adds the remaining bytes (`kept`; NULL where nothing was lost).
    """
    texts = keyed_texts(docs, id_col, text_col)
    cover = Cover(length)
    packed = stored(packed_blocks(texts, block_bytes), "packed")
    total = packed.agg(F.sum(F.expr("aggregate(sizes, 0L, (t, s) -> t + s)")).alias("n")).first()["n"] or 0
    buckets = int(total * len(cover.residues) / cover.period / bucket_hashes) + 1

    def per_bucket(messages: DataFrame, work: Callable[[pa.Table], list[tuple]]) -> DataFrame:
        return messages.select("block", "bucket", "data").groupBy("bucket").applyInArrow(_group_answer(work), ANSWER)

    often = per_bucket(sample_messages(packed, cover, buckets), _repeated)
    rests = stored(kept_rests(packed, often, cover, buckets), "rests")
    ranks = per_bucket(rank_messages(rests, cover, buckets), _ranks)
    runs = stored(open_suffixes(rests, ranks, cover, buckets), "runs")
    again = per_bucket(runs.where("kind = 'short'"), _repeated)
    kinds = [runs.where(F.col("kind") == k).select("block", F.col("data").alias(k)) for k in ("proven", "open")]
    told = kinds[0].join(kinds[1], "block").join(gathered(again, "again"), "block", "left")
    told = stored(told, "told")
    mine = per_bucket(suffix_messages(rests.join(told, "block"), cover, buckets), _mine)
    changed = removals(rests.join(told, "block"), mine, cover, buckets, keep_text)
    parts = F.posexplode(F.arrays_zip("ids", "sizes", "hashes")).alias("at", "doc")
    every = packed.select("block", parts).select(
        "block", F.col("at").cast("long").alias("at"), "doc.ids", "doc.sizes", "doc.hashes"
    )
    none = F.lit(0).cast("long")
    return every.join(changed, ["block", "at"], "left").select(
        F.col("ids").alias("doc_id"),
        F.col("sizes").alias("n_bytes"),
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "hashes").alias("kept_sha256"),
        *(["kept"] if keep_text else []),
    )
