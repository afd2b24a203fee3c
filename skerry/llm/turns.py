"""Repair of the turn structure of conversations at least cost.

A conversation is sound if it is empty, or an optional system turn and then pairs
of user and assistant turns. Rows are kept, given another role, deleted or
inserted; of all cheapest repairs the one with the alphabetically least list of
edits counts.

The costs to finish from each state of that grammar are a vector of four numbers.
Less its minimum it is one of a few (`Tables.vectors`), because states differ by
a bounded number of edits. So a block of `BLOCK` rows is a step between numbered
vectors, looked up in tables that hold it for every block and every vector
(the Four Russians' way), and a chunk of rows is a row per vector: the vector
before it, the cost it adds and where each state ends up. Conversations are folded
from their end over such summaries; then every chunk is traced alone, block by
block, with the vectors inside a block expanded backward from the one behind it.

Rows are dealt by ranges of (conversation, turn, role, text) and packed into
chunks of `CHUNK_ROWS` rows or `CHUNK_CHARS` characters, so a conversation that holds
a third of all rows spreads over tasks. What must follow its order alone is the
digest of its repaired text: one task reads its chunks as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from io import StringIO
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from skerry.llm.shared import stored

BLOCK = 3
CHUNK_ROWS = 1_024
CHUNK_CHARS = 1_000_000
# Roles by initial; anything else is OTHER. A row's symbol is its initial, plus TRUNCATED; GONE rows must be deleted.
INITIALS, OTHER, TRUNCATED, GONE = "sua", 3, 4, 8
SYMBOLS = 9
# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. STEP[state][initial] is the state after.
STEP = ((1, 2, None), (None, 2, None), (None, None, 3), (None, 2, None))
# The one role that may be inserted or given in a state, and the state it leads to.
NEXT = (2, 2, 3, 2)
ACCEPTED = (0, 3)
DELETE, INSERT, RENAME, UNENDED = 3, 2, 2, 1
ROLE_OF = {2: "user", 3: "assistant"}
NO_COST = 1 << 20


def close(cost: list[int]) -> list[int]:
    """Costs to finish if rows may be inserted first."""
    out = list(cost)
    for _ in range(3):
        out = [min(c, INSERT + out[NEXT[q]]) for q, c in enumerate(out)]
    return out


END = close([0 if q in ACCEPTED else NO_COST for q in range(4)])


def choices(symbol: int, after: list[int], q: int) -> dict[str, int]:
    """What each edit of a row costs in state `q`, the rest of the conversation included."""
    found = {"D": DELETE + after[q]}
    if symbol != GONE:
        extra = UNENDED if symbol & TRUNCATED else 0
        initial = symbol & 3
        kept = None if initial == OTHER else STEP[q][initial]
        if kept is not None:
            found["K"] = extra + after[kept]
        found["R"] = RENAME + extra + after[NEXT[q]]
    return found


def before(symbol: int, after: list[int]) -> list[int]:
    """Costs to finish in front of a row from those behind it."""
    return close([min(choices(symbol, after, q).values()) for q in range(4)])


def trace(symbol: int, after: list[int], q: int) -> tuple[str, int]:
    """The least letters of a cheapest way over one row, rows inserted before it included, and the state behind it."""
    front, letters = before(symbol, after), ""
    while True:
        options = choices(symbol, after, q) | {"I": INSERT + front[NEXT[q]]}
        edit = min(e for e, cost in options.items() if cost == front[q])
        letters += edit
        if edit == "K":
            return letters, STEP[q][symbol & 3]
        if edit == "D":
            return letters, q
        q = NEXT[q]
        if edit == "R":
            return letters, q


class Tables(NamedTuple):
    """Steps for single symbols (`letters`, too) and for blocks, by symbol or block code and number of the vector behind.

    `vectors` are normalised, `front` is the vector before, `cost` what the step
    adds to the minimum, `land` the state behind for each state before.
    """

    vectors: list[list[int]]
    front1: np.ndarray
    cost1: np.ndarray
    land1: np.ndarray
    letters: list
    front: np.ndarray
    cost: np.ndarray
    land: np.ndarray


@lru_cache(maxsize=1)
def tables() -> Tables:
    """All vectors that rows can lead to from the end of a conversation, and the tables over them."""
    def normal(vector: list[int]) -> tuple[tuple[int, ...], int]:
        least = min(vector)
        return tuple(c - least for c in vector), least

    numbers, order, steps = {normal(END)[0]: 0}, [normal(END)[0]], {}
    for v, vector in enumerate(order):  # grows while it is read
        for a in range(SYMBOLS):
            front, cost = normal(before(a, list(vector)))
            if front not in numbers:
                numbers[front] = len(order)
                order.append(front)
            traced = [trace(a, list(vector), q) for q in range(4)]
            steps[a, v] = numbers[front], cost, [end for _, end in traced], [letters for letters, _ in traced]
    size = len(order)
    pick = lambda i: np.array([[steps[a, v][i] for v in range(size)] for a in range(SYMBOLS)])
    front1, cost1, land1 = pick(0), pick(1), pick(2)
    front, cost, land = front1, cost1, land1
    for _ in range(BLOCK - 1):  # one more symbol in front of every block
        first = front1[:, front]  # symbol, block, vector
        total = cost[None] + cost1[:, front]
        # The state behind the new symbol goes on through the block.
        moved = np.take_along_axis(np.broadcast_to(land[None], (SYMBOLS, *land.shape)), land1[:, front], axis=3)
        front, cost, land = (x.reshape(-1, *x.shape[2:]) for x in (first, total, moved))
    letters = [[steps[a, v][3] for v in range(size)] for a in range(SYMBOLS)]
    return Tables([list(v) for v in order], front1, cost1, land1, letters, front, cost, land)


def pieces(symbols: bytes) -> tuple[np.ndarray, bytes]:
    """Codes of whole blocks, and the symbols left at the end."""
    whole = len(symbols) // BLOCK * BLOCK
    digits = np.frombuffer(symbols[:whole], np.uint8).reshape(-1, BLOCK).astype(np.int64)
    return digits @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1)), symbols[whole:]


def summary(symbols: bytes) -> np.ndarray:
    """Per number of the vector behind a chunk: number of the one before, cost added, state behind for each state before."""
    t = tables()
    blocks, rest = pieces(symbols)
    size = len(t.vectors)
    at, cost, land = np.arange(size), np.zeros(size, np.int64), np.tile(np.arange(4), (size, 1))

    def step(front: np.ndarray, price: np.ndarray, moves: np.ndarray) -> None:
        nonlocal at, cost, land
        land = np.take_along_axis(land, moves[at], axis=1)
        cost = cost + price[at]
        at = front[at]

    for a in reversed(rest):
        step(t.front1[a], t.cost1[a], t.land1[a])
    for code in blocks[::-1]:
        step(t.front[code], t.cost[code], t.land[code])
    return np.column_stack([at, cost, land])


def edits(symbols: bytes, behind: int, state: int) -> Iterator[str]:
    """The letters of each row of a chunk, given the number of the vector behind it and the state before it."""
    t = tables()
    blocks, rest = pieces(symbols)
    fronts = []  # vector behind each block
    at = behind
    for a in reversed(rest):
        at = t.front1[a, at]
    for code in blocks[::-1]:
        fronts.append(at)
        at = t.front[code, at]
    fronts.reverse()
    parts = [(symbols[i * BLOCK : (i + 1) * BLOCK], v) for i, v in enumerate(fronts)] + ([(rest, behind)] if rest else [])
    for block, at in parts:
        inside = []  # the block expanded backward: vector behind each of its rows
        for a in reversed(block):
            inside.append(at)
            at = t.front1[a, at]
        for a, v in zip(block, reversed(inside)):
            yield t.letters[a][v][state]
            state = int(t.land1[a, v, state])


def closing(state: int) -> str:
    """Rows inserted at the end."""
    letters = ""
    while state not in ACCEPTED:
        letters, state = letters + "I", NEXT[state]
    return letters


class Repair:
    """Repaired rows from the edits of one conversation, in order; `lines` are `role:text`."""

    def __init__(self) -> None:
        self.state = 0

    def lines(self, letters: str, role: str = "", text: str = "") -> Iterator[str]:
        for edit in letters:
            if edit == "K":
                yield f"{role}:{text}"
                self.state = STEP[self.state][INITIALS.index(role[0])]
            elif edit in "IR":
                self.state = NEXT[self.state]
                yield f"{ROLE_OF[self.state]}:{text if edit == 'R' else ''}"


# --- Spark ---

ENDS = "[.!?]"


def damage(talks: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults drawn from crc32(`conv_id:turn`) mod 20; dropped rows have a NULL role.

    0 drops a row, 1 empties its text, 2 takes its `.!?`, 3 repeats it, 4 makes it a
    user's. NULLs are one space, in the drawn key too; a NULL turn stays the order's first.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    drawn = talks.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), lot.alias("lot"))
    again = F.when(F.col("lot") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return drawn.select(
        "conv_id", "turn",
        F.when(F.col("lot") == 4, "user").when(F.col("lot") != 0, F.col("role")).alias("role"),
        F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(again).alias("copy"),
    ).drop("copy")


LONG, INT, TEXT = pa.int64(), pa.int32(), pa.string()
PLACE = [("conv_id", LONG), ("part", INT), ("chunk", INT)]
CHUNK = pa.schema([
    *PLACE, ("symbols", pa.binary()), ("first_turn", LONG), ("last_turn", LONG), ("turns", LONG), ("first_role", TEXT), ("last_role", TEXT),
    ("illegal", LONG), ("blank", LONG), ("ended", pa.binary()), ("h1", pa.list_(LONG)), ("h2", pa.list_(LONG)),
    ("roles", pa.list_(TEXT)), ("texts", pa.list_(TEXT)),
])
LEGAL = ("su", "ua", "au")
SPACES = " \t\n\x0b\x0c\r"


def batched(rows: Iterable[tuple], schema: pa.Schema, most: int = 64, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most `most` rows, fewer where their last value is long text."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)

    for row in rows:
        held.append(row)
        size += sum(map(len, row[-1])) if isinstance(row[-1], list) else len(row[-1]) if isinstance(row[-1], str) else 0
        if len(held) >= most or size >= chars:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def rows_of(batches: Iterable[pa.RecordBatch], most: int = 64) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, most).columns))


def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered rows to chunks of one conversation each; equal neighbours are marked as repeated already."""
    return batched(_chunks(rows_of(batches)), CHUNK)


def _chunks(ordered: Iterator[tuple], most: int = CHUNK_ROWS, chars: int = CHUNK_CHARS) -> Iterator[tuple]:
    part, number, talk, rows, size, last = TaskContext.get().partitionId(), 0, None, [], 0, None

    def chunk() -> tuple:
        symbols, ended, blank = bytearray(), bytearray(), 0
        for _, role, text, again, *_ in rows:
            bare = text.strip(SPACES)
            at = INITIALS.find(role[:1]) if role else -1
            open_ = bool(bare) and bare[-1] not in ".!?"
            symbols.append(GONE if again or not bare else (at if at >= 0 else OTHER) | (TRUNCATED if open_ else 0))
            blank += not bare
            ended.append(open_)
        turns = [r[0] for r in rows if r[0] is not None]
        roles = [r[1][:1] for r in rows]
        return (
            talk, part, number, bytes(symbols), min(turns, default=None), max(turns, default=None), len(set(turns)), roles[0], roles[-1],
            sum(a + b not in LEGAL for a, b in zip(roles, roles[1:])), blank, bytes(ended),
            [r[4] for r in rows], [r[5] for r in rows], [r[1] for r in rows], [r[2] for r in rows],
        )

    for row in ordered:
        if rows and (row[0] != talk or len(rows) >= most or size >= chars):
            yield chunk()
            number, rows, size = number + 1, [], 0
        talk = row[0]
        rows.append((*row[1:4], row[:4] == last, *row[4:]))
        size += len(row[3])
        last = row[:4]
    if rows:
        yield chunk()


# Characters of role and text by which ranges are drawn: their bounds come from a sample that the driver holds.
RANGE_CHARS = 32


def chunks_of(rows: DataFrame) -> DataFrame:
    """Rows in order, in chunks, stored: ranges are drawn from a sample and must not be drawn again."""
    talk, turn, role, text = F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")
    hashes = F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), role, text).alias("h2")
    # Never at odds with the order by whole roles and texts: behind a cut role, no text decides.
    start = F.when(F.char_length(role) <= RANGE_CHARS, F.substring(text, 1, RANGE_CHARS)).asc_nulls_last()
    dealt = rows.where(role.isNotNull()).repartitionByRange(talk, turn, F.substring(role, 1, RANGE_CHARS), start)
    ordered = dealt.sortWithinPartitions(talk, turn, role, text).select("conv_id", "turn", role, text, *hashes)
    return stored(ordered.mapInArrow(pack, from_arrow_schema(CHUNK)), "turn-chunks")


def later_copies(chunks: DataFrame, salts: int = 64) -> DataFrame:
    """(part, chunk, again): positions of rows whose role and text occur earlier in their conversation.

    A conversation and a hash are one key. Its rows are dealt to `salts` parts by
    chunk; the first of each part is found, then the first of all.
    """
    salt = F.pmod(F.xxhash64("part", "chunk"), F.lit(salts)).cast("int").alias("salt")
    cells = chunks.select("conv_id", "part", "chunk", salt, F.posexplode(F.arrays_zip("h1", "h2")).alias("at", "h"))
    place = F.struct("part", "chunk", "at")
    light = cells.select("conv_id", "h.h1", "h.h2", "salt", place.alias("place"))
    key = ["conv_id", "h1", "h2"]
    parts = light.groupBy(*key, "salt").agg(F.min("place").alias("least"), F.count("*").alias("n"))
    whole = Window.partitionBy(*key)
    firsts = parts.withColumns({"first": F.min("least").over(whole), "total": F.sum("n").over(whole)}).where("total > 1")
    named = firsts.select(*[F.col(k).alias(f"__{k}") for k in [*key, "salt"]], "first")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in [*key, "salt"]]
    return light.join(named, same).where("place > first").groupBy("place.part", "place.chunk").agg(
        F.collect_list("place.at").alias("again")
    )


def _with_copies(symbols: bytes, again: list[int] | None) -> bytes:
    marked = bytearray(symbols)
    for at in again or ():
        marked[at] = GONE
    return bytes(marked)


SUMMARY = pa.schema([*PLACE, ("summary", pa.list_(INT))])
PLACED = pa.schema([*PLACE, ("behind", INT), ("state", INT), ("cost", LONG)])


def summarise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = ((talk, part, chunk, summary(_with_copies(symbols, again)).ravel()) for talk, part, chunk, symbols, again in rows_of(batches))
    return batched(made, SUMMARY)


def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summaries of each conversation, its last chunk first, to the vector behind and the state before each chunk.

    One conversation's summaries are held at a time: a few small numbers for a thousand rows.
    """
    return batched(_places(rows_of(batches)), PLACED, 1024)


def _places(summaries: Iterator[tuple]) -> Iterator[tuple]:
    for talk, group in groupby(summaries, lambda r: r[0]):
        at, total, found = 0, 0, []
        for _, part, chunk, flat in group:
            row = flat[6 * at : 6 * at + 6]
            found.append((part, chunk, at, row[2:]))
            at, total = row[0], total + row[1]
        cost, state = total + tables().vectors[at][0], 0
        for part, chunk, behind, land in reversed(found):
            yield talk, part, chunk, behind, state, cost
            state = land[state]


RESULT = pa.schema([
    ("conv_id", LONG), ("gaps", LONG), ("blank", LONG), ("duplicate", LONG), ("truncated", LONG), ("illegal", LONG), ("cost", LONG),
    ("repaired_sha256", TEXT), ("audit", TEXT),
])


def assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of each conversation in order to its row; some chunks' texts are held at a time, and the letters so far."""
    talks = groupby(rows_of(batches, 4), lambda r: r[0])
    return batched((_repaired(talk, group) for talk, group in talks), RESULT)


def _repaired(talk: int | None, group: Iterator[tuple]) -> tuple:
    low = high = role = place = None
    turns = blank = duplicate = truncated = illegal = cost = 0
    letters, repair, digest, start = StringIO(), Repair(), hashlib.sha256(), ""
    for _, part, _, is_chunk, symbols, first, last, own, first_role, last_role, bad, empty, ended, roles, texts, *found in group:
        if not is_chunk:  # the conversation itself, or where the next chunk stands
            place = found
            continue
        again, behind, state, cost = place
        marked = _with_copies(symbols, again)
        if own:
            turns += own - (high is not None and high == first)
            low, high = first if low is None else low, last
        blank += empty
        duplicate += marked.count(GONE) - empty
        truncated += sum(e and s != GONE for e, s in zip(ended, marked))
        illegal += bad + (role is not None and role + first_role not in LEGAL)
        role = last_role
        for edit, kind, text in zip(edits(marked, behind, state), roles, texts):
            letters.write(edit)
            for line in repair.lines(edit, kind, text):
                digest.update((start + line).encode())
                start = "\n"
    tail = closing(repair.state)
    letters.write(tail)
    for line in repair.lines(tail):
        digest.update((start + line).encode())
        start = "\n"
    gaps = 0 if low is None else high - low + 1 - turns
    return talk, gaps, blank, duplicate, truncated, illegal, cost, digest.hexdigest(), letters.getvalue()


def repair_turns(rows: DataFrame) -> DataFrame:
    """One row per conversation of `rows` (conv_id, turn, role, text): faults, least cost, edits and repaired digest.

    Rows follow their turn, missing turns first, equal turns by role and text;
    equal rows are repeats. A row with a NULL role names its conversation and
    nothing else; a NULL text is empty. A missing conv_id is a conversation of
    its own. `gaps` are missing turns, `blank`, `duplicate` and `truncated` count
    each row's first fault, `illegal` neighbours that do not follow each other,
    `audit` holds K(eep), R(ename), D(elete) and I(nsert). Other columns are not
    read. A text must fit a task, a conversation need not.
    """
    rows = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    chunks = chunks_of(rows)
    light = chunks.select("conv_id", "part", "chunk", "symbols").join(later_copies(chunks), ["part", "chunk"], "left")
    marked = stored(light.select("conv_id", "part", "chunk", "symbols", "again"), "turn-marks")
    backward = marked.mapInArrow(summarise, from_arrow_schema(SUMMARY)).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.desc("part"), F.desc("chunk")
    )
    placed = backward.mapInArrow(fold, from_arrow_schema(PLACED)).join(marked.select("part", "chunk", "again"), ["part", "chunk"])
    talks = rows.select("conv_id").distinct().withColumns({"part": F.lit(-1), "chunk": F.lit(0)})
    # A chunk's place comes to it as a row of its own, sorted before it, so texts move once more and not twice.
    every = (
        chunks.drop("h1", "h2").withColumn("is_chunk", F.lit(True))
        .unionByName(placed.withColumn("is_chunk", F.lit(False)), allowMissingColumns=True)
        .unionByName(talks.withColumn("is_chunk", F.lit(False)), allowMissingColumns=True)
        .select(
            "conv_id", "part", "chunk", "is_chunk", "symbols", "first_turn", "last_turn", "turns", "first_role", "last_role",
            "illegal", "blank", "ended", "roles", "texts", "again", "behind", "state", "cost",
        )
    )
    ordered = every.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk", "is_chunk")
    return ordered.mapInArrow(assemble, from_arrow_schema(RESULT))
