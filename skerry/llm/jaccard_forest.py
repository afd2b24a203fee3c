"""Near-duplicate join on word shingles: MinHash LSH forest, then exact verification.

1. Documents of equal shingle sets are one node; copies never meet each other.
2. A node's MinHash signature is cut into `trees` labels of `deepest` one-byte
   symbols. Documents are banded by one label prefix per tree, of a depth computed
   once from the parameters: the longest with which the recall bound at the
   similarity threshold reaches the target (`prefix_depth`). This is the level of
   an LSH forest's tries that a threshold join needs; there are no sorted tries
   and no descent that depends on the data, and symbols below it are not read.
3. Nodes of one prefix are candidates of each other. They are tied to the least
   node of the prefix, not to each other, and the ties are joined to candidate
   groups (`components`), so no pair is written anywhere.
4. Inside a group all pairs are verified on the exact shingle sets, in square
   blocks: a group of any size becomes tasks of at most two blocks of nodes.
   Blocks give link counts per node and ties of linked nodes, again no pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from skerry.llm.shared import SLICE_ROWS, stored

SHINGLE = 5
THRESHOLD = 0.8
TREES = 64
DEEPEST = 10
TARGET = 0.9999
BLOCK_NODES = 512
MEMO_WORDS = 150_000
# Words: letters, digits and everything above ASCII; case is folded.
SEPARATORS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# Fixed odd multipliers by word position, drawn once from a seed.
_DRAW = np.random.default_rng(20240917)
POSITION = _DRAW.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def prefix_depth(trees: int, deepest: int, threshold: float, target: float) -> int:
    """The longest prefix with which a pair at the threshold meets in some tree with probability `target`."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def shingler(size: int = SHINGLE) -> Callable[[str], np.ndarray]:
    """A function from a text to its sorted distinct shingle hashes (64 bits).

    A text of fewer words than a shingle, but not none, is one shingle.
    """
    known: dict[bytes, int] = {}

    def run(text: str) -> np.ndarray:
        words = text.lower().encode().translate(SEPARATORS).split()
        if not words:
            return np.empty(0, np.uint64)
        if len(known) > MEMO_WORDS:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(size, len(words))
        count = len(words) - width + 1
        total = np.full(count, np.uint64(width))
        for at in range(width):
            total += codes[at : at + count] * POSITION[at]
        return np.unique(_mix(total))

    return run


def signer(trees: int, deepest: int) -> Callable[[np.ndarray], bytes]:
    """A function from shingle hashes to the labels of all trees, `deepest` bytes each."""
    draw = np.random.default_rng(11)
    factors = draw.integers(0, 2**31, trees * deepest, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def run(hashes: np.ndarray) -> bytes:
        low = (hashes >> np.uint64(16)).astype(np.uint32)
        best = np.full(len(factors), np.uint32(0xFFFFFFFF))
        for start in range(0, len(low), 512):
            np.minimum(best, (low[start : start + 512, None] * factors).min(axis=0), out=best)
        return ((best * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()

    return run


def node_of(hashes: np.ndarray) -> int:
    """A signed 64-bit name of a shingle set."""
    return int.from_bytes(blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


PROFILE = "doc_id bigint, node bigint, size int, labels binary"


def profiles(docs: DataFrame, trees: int = TREES, deepest: int = DEEPEST, size: int = SHINGLE) -> DataFrame:
    """(doc_id, node, size, labels) per row; rows without words have a NULL node."""
    types = to_arrow_schema(StructType.fromDDL(PROFILE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, sign = shingler(size), signer(trees, deepest)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part, rows = batch.slice(start, SLICE_ROWS), []
                for text in part.column("text").to_pylist():
                    found = shingles(text)
                    rows.append((node_of(found), len(found), sign(found)) if len(found) else (None, 0, None))
                columns = [pa.array(v, t) for v, t in zip(zip(*rows), types.types[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], schema=types)

    return docs.select("doc_id", "text").mapInArrow(run, PROFILE)


def candidate_ties(nodes: DataFrame, trees: int, deepest: int, depth: int) -> DataFrame:
    """(a, b): nodes under one path of some tree's trie, each tied to the least of them."""
    path = F.substring(F.col("labels"), F.col("tree") * deepest + 1, F.lit(depth))
    paths = nodes.select("node", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "labels").select(
        "node", F.xxhash64("tree", path).alias("path")
    )
    shared = paths.groupBy("path").agg(F.min("node").alias("b"), F.max("node").alias("other")).where("b < other")
    return paths.join(shared.select("path", "b"), "path").where("node > b").select(F.col("node").alias("a"), "b").distinct()


def components(ties: DataFrame) -> DataFrame:
    """(node, root) of every tied node; nodes joined by ties have one root.

    Every round each node moves to the first of itself and its neighbours in a
    random order (the hash of the node) and ties are drawn between the places
    they moved to, so that the number of places falls by a constant share.
    """
    key = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
    ties = stored(ties.select("a", "b"), "ties")
    both = ties.unionByName(ties.select(F.col("b").alias("a"), F.col("a").alias("b")))
    roots = stored(both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    while not ties.isEmpty():
        both = ties.unionByName(ties.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = both.groupBy("a").agg(F.least(key("a"), F.min(key("b")))["n"].alias("to"))
        moves = stored(moves.select(F.col("a").alias("place"), "to"), "moves")
        moved = ties
        for end in ("a", "b"):
            moved = moved.join(moves.select(F.col("place").alias(end), F.col("to").alias(f"to_{end}")), end)
        moved = moved.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).where("a <> b").distinct()
        roots = stored(
            roots.join(moves, roots["root"] == moves["place"], "left").select(
                "node", F.coalesce("to", "root").alias("root")
            ),
            "roots",
        )
        ties = stored(moved, "ties")
    return roots


def _linked(sets: list[np.ndarray], sizes: np.ndarray, threshold: float, limit: int = 1 << 22) -> np.ndarray:
    """Which pairs of sets have at least the threshold as Jaccard similarity, as a square matrix."""
    count = len(sets)
    values, owner = np.concatenate(sets), np.repeat(np.arange(count), sizes)
    _, column, seen = np.unique(values, return_inverse=True, return_counts=True)
    common = seen[column] > 1  # a shingle of one set only adds to no intersection
    owner, column = owner[common], column[common]
    shared = np.zeros((count, count), np.int64)
    if len(column):
        _, column = np.unique(column, return_inverse=True)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        step = max(1, limit // count)
        for first in range(0, int(column[-1]) + 1, step):
            lo, hi = np.searchsorted(column, (first, first + step))
            present = np.zeros((count, step), np.float32)
            present[owner[lo:hi], column[lo:hi] - first] = 1
            shared += (present @ present.T).astype(np.int64)  # at most `step` shingles, exact in float32
    # shared / (a + b - shared) >= p / q in whole numbers, a few rows at a time
    share = Fraction(str(float(threshold))).limit_denominator(10**9)
    p, q, sizes = share.numerator, share.denominator, sizes.astype(np.int64)
    linked = np.empty((count, count), bool)
    for first in range(0, count, 64):
        rows = slice(first, first + 64)
        linked[rows] = shared[rows] * (p + q) >= (sizes[rows, None] + sizes[None, :]) * p
    np.fill_diagonal(linked, False)
    return linked


FOUND = "node bigint, links bigint, root bigint"


def _verify(threshold: float):
    types = to_arrow_schema(StructType.fromDDL(FOUND))

    def run(table: pa.Table) -> pa.Table:
        # A repeated row of the document brings its node twice.
        table = table.take(np.unique(table.column("node").to_numpy(), return_index=True)[1])
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        blocks = table.column("block").to_numpy()
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("hashes").combine_chunks()]
        linked = _linked(sets, np.array([len(s) for s in sets]), threshold)
        if table.column("left")[0].as_py() != table.column("right")[0].as_py():
            linked &= blocks[:, None] != blocks[None, :]  # pairs inside a block have their own task
        links = linked @ copies
        place = np.arange(len(nodes), dtype=np.int32)
        while True:  # the least place reachable over links
            best = np.minimum(place, np.where(linked, place[None, :], np.int32(len(nodes))).min(axis=1))
            best = best[best]
            if (best == place).all():
                break
            place = best
        return pa.table([pa.array(nodes), pa.array(links), pa.array(nodes[place])], schema=types)

    return run


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    trees: int = TREES,
    deepest: int = DEEPEST,
    target: float = TARGET,
    block: int = BLOCK_NODES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, n_links.

    Two rows are linked if the Jaccard similarity of their shingle sets is at
    least `threshold`; n_links counts the other rows linked to a row, copies
    included. Classes are what links connect, named by their least doc_id. A
    NULL, empty or wordless text has no shingles and links to nothing. A row
    with a NULL id has a NULL class and counts among the links of its copies
    only. Repeated rows are copies. An empty table gives an empty result.
    """
    found = _classes(docs, threshold, shingle, trees, deepest, target, block, id_col, text_col)
    return found.select("doc_id", "class_id", "n_links")


def _classes(
    docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, trees: int = TREES, deepest: int = DEEPEST,
    target: float = TARGET, block: int = BLOCK_NODES, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """`near_duplicates` with the row's node, and whether the row is the head of its class: the least id, then node."""
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    profile = stored(profiles(texts, trees, deepest, shingle), "profiles")
    nodes = stored(
        profile.where("node IS NOT NULL")
        .groupBy("node", "size")
        .agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("labels").alias("labels")),
        "nodes",
    )
    named = nodes.where("doc_id IS NOT NULL")
    groups = components(candidate_ties(named, trees, deepest, prefix_depth(trees, deepest, threshold, target)))
    sizes = groups.groupBy("root").agg(F.count("*").alias("n"))
    wanted = (
        groups.join(sizes, "root")
        .join(named.select("node", "doc_id", "copies"), "node")
        .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("doc_id", "node", "copies", F.col("root").alias("group"), "blocks", "block")
    )
    checked = stored(_verified(texts, wanted, threshold, shingle), "checked")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    ties = checked.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    tied = components(ties.distinct()).join(named.select("node", "doc_id"), "node")
    classes = tied.groupBy("root").agg(F.min(F.struct("doc_id", "node")).alias("first")).select(
        "root", F.col("first.doc_id").alias("class_id"), F.col("first.node").alias("head")
    )
    found = (
        nodes.select("node", "size", "doc_id", "copies")
        .join(links, "node", "left")
        .join(tied.select("node", "root").join(classes, "root").select("node", "class_id", "head"), "node", "left")
        .select(
            "node",
            "size",
            F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("head", "node").alias("head"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    return profile.join(found, ["node", "size"], "left").select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "node",
        F.coalesce((F.col("node") == F.col("head")) & (F.col("doc_id") == F.col("class_id")), F.lit(False)).alias("head"),
    )


def _verified(texts: DataFrame, wanted: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """(node, links, root) from every pair of blocks of every candidate group."""
    fields = "node bigint, copies bigint, group bigint, blocks int, block int, hashes binary"
    types = to_arrow_schema(StructType.fromDDL(fields))
    names = types.names[:-1]

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler(shingle)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                found = [shingles(t) for t in part.column("text").to_pylist()]
                # An id may stand for several texts; the row of the node is the one that hashes to it.
                own = pa.array([node_of(f) == n for f, n in zip(found, part.column("node").to_pylist())])
                columns = [*(part.column(c) for c in names), pa.array([f.tobytes() for f in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=types).filter(own)

    # The wanted documents grow with the corpus, so neither side is ever broadcast.
    rows = texts.join(wanted.hint("merge"), "doc_id").select("text", *names).mapInArrow(shingled, fields)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.withColumn("other", other).select(
        "node", "copies", "block", "hashes", "group", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    )
    return dealt.groupBy("group", "left", "right").applyInArrow(_verify(threshold), FOUND)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` that head their class: one row of each class, all columns kept.

    Rows without words or id stay; of repeated ones of one id and text one does.
    An id may stand for several texts: each is judged as a text of its own, so no
    text goes without a linked one that stays.
    """
    found = stored(_classes(docs, id_col=id_col, **options).select("doc_id", "node", "head"), "heads")
    stays = F.col("head") | F.col("node").isNull()
    ids = stored(
        found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("__rows"), F.max(stays).alias("stays"))
        .where("stays").select(F.col("doc_id").alias("__head"), "__rows"), "head-ids",
    )
    columns = [f"`{c}`" for c in docs.columns]
    # One head per class grows with the corpus, so it is never broadcast.
    named = docs.join(ids.hint("merge"), F.col(f"`{id_col}`") == F.col("__head"))
    parts = [docs.where(F.col(f"`{id_col}`").isNull()), named.where("__rows = 1").select(*columns)]
    if not ids.where("__rows > 1").isEmpty():
        heads = found.where("head").select(F.col("doc_id").alias("__id"), F.col("node").alias("__own")).distinct()
        text_col = options.get("text_col", "text")
        several = _with_node(named.where("__rows > 1").select(*columns), text_col, options.get("shingle", SHINGLE))
        same = (F.col(f"`{id_col}`") == F.col("__id")) & (F.col("__node") == F.col("__own"))
        parts += [
            several.where("__node IS NULL").dropDuplicates([id_col, text_col]).select(*columns),
            several.join(heads.hint("merge"), same).dropDuplicates([id_col, "__node"]).select(*columns),
        ]
    kept = parts[0].select(*columns)
    for part in parts[1:]:
        kept = kept.unionAll(part)
    return kept


def _with_node(df: DataFrame, text_col: str, size: int) -> DataFrame:
    """`df` with `__node`, the name of the text's shingle set; NULL without words."""
    at = df.columns.index(text_col)
    names = [*df.columns, "__node"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler(size)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                found = (shingles(t or "") for t in part.column(at).to_pylist())
                nodes = pa.array([node_of(f) if len(f) else None for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, nodes], names=names)

    return df.mapInArrow(run, StructType([*df.schema, StructField("__node", LongType())]))
