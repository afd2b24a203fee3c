"""Exact top-k search by inner product with no-random-access aggregation.

Candidates are dealt into blocks. A task takes one block and one batch of
queries and builds, for every dimension, the list of the block's rows sorted by
that component. Queries read the lists in step, best contributions first: by
value from above where a query's component is positive, from below where it
is negative. What was read gives every row a lower bound (unread entries are the
worst of their list, whose ends are stored) and an upper bound (unread entries
are at the frontier of their list). Rows whose upper bound is under the k-th
lower bound drop out. What a depth makes known of a row depends on no query but
for the direction of each list, so one matrix product gives the bounds of many
queries. No row is looked up while lists are read: only when reading has
stopped, because few rows can still qualify, are their final scores made. Rows
that tie with the bound stay, so ties go to the smaller id.

The best k of every block meet in one window per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Rows of a block and queries of a batch: the two bound what one task holds. A large block has a high k-th score, so
# its lists can be left early; a batch is what one task does, and every batch has the block sent and sorted once more.
BLOCK_ROWS = 32_768
BATCH_QUERIES = 8192
# Shares of the lists read before the bounds are looked at.
DEPTHS = (0.5, 0.8, 0.95, 1.0)
# Reading stops when at most this share of the block, or this many rows, can still qualify.
RESOLVE_SHARE, RESOLVE_ROWS = 0.25, 64
# Queries and rows whose bounds are made by one product.
STEP_QUERIES, STEP_ROWS = 256, 4096
MADE = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(vectors: DataFrame, factor: int = 64, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """(vec_id, vec): components floor(factor * x). Rows without a usable vector or id are left out.

    A row counts once however often it is repeated; of different vectors under
    one id the greatest array counts. A component beyond 64 bits is an error.
    """
    x = F.col(f"`{col}`").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    far = F.raise_error(F.lit(f"a component times {factor} exceeds 64 bits")).cast("bigint")
    whole = F.transform(x, lambda v: F.when(F.abs(v * factor) < 2.0**63, F.floor(v * factor).cast("bigint")).otherwise(far))
    return (
        vectors.where(F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & ~bad & (F.size(x) > 0))
        .groupBy(F.col(f"`{id_col}`").cast("long").alias("vec_id"))
        .agg(F.max(whole).alias("vec"))
    )


class SortedLists:
    """One block of integer vectors, and the sorted list of every dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids)
        self.ids = ids[order]
        self.most = float(np.abs(rows).max(initial=0))
        self.whole = rows[order]
        self.rows = self.whole.astype(np.float32 if self.most < 2**24 else np.float64)
        self.value = np.sort(self.rows, axis=0)  # per dimension, ascending

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Final scores of some rows, in the fastest type in which every partial sum is exact."""
        reach = self.reach(query)
        if reach < 2**52:
            kind = np.float32 if reach < 2**24 else np.float64
            return (self.rows[rows].astype(kind, copy=False) @ query.astype(kind)).astype(np.int64)
        if reach < 2**63:
            return self.whole[rows] @ query
        exact = self.whole[rows].astype(object) @ query.astype(object)
        if any(abs(score) >= 2**63 for score in exact):
            raise OverflowError("a score exceeds 64 bits")
        return exact.astype(np.int64)

    def reach(self, query: np.ndarray) -> np.ndarray:
        """What no sum of products of a row and the query (or each of several) can exceed."""
        return np.abs(query.astype(np.float64)).sum(axis=-1) * self.most

    def top(self, query: np.ndarray, k: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than `skip`."""
        return self.tops(query[None], k, np.array([skip]))[0]

    def tops(self, queries: np.ndarray, k: int, skips: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query, ids and scores of the k best rows other than the one it skips.

        All lists are read in step, for many queries at once. Rows whose upper bound
        is under the k-th lower bound cannot qualify and drop out; reading stops when
        few are left, and only then are final scores made. Bounds only tighten, so a
        row that has dropped out stays out at greater depths.
        """
        size, reach = len(self.ids), self.reach(queries)
        few = max(RESOLVE_ROWS, k + 1, int(size * RESOLVE_SHARE))
        own = [slice(*edges) for edges in zip(np.searchsorted(self.ids, skips), np.searchsorted(self.ids, skips, "right"))]
        found: list = [None] * len(queries)
        still = np.argsort(reach)  # queries of like reach together, so that huge ones do not widen the others' type
        for share in DEPTHS if size > few else (1.0,):
            depth, later = max(1, int(size * share)), []
            for start in range(0, len(still), STEP_QUERIES):
                some = still[start : start + STEP_QUERIES]
                if size > few:
                    can = self.candidates(queries[some], depth, k, [own[at] for at in some])
                else:
                    can = np.ones((len(some), size), bool)
                for at, mine in zip(some, can):
                    mine[own[at]] = False
                    if share < 1 and np.count_nonzero(mine) > few:
                        later.append(at)
                    else:
                        found[at] = self.best(queries[at], np.flatnonzero(mine), k)
                if len(later) == len(some) == STEP_QUERIES and not start:  # too early for the first: no look for the others
                    later.extend(still[STEP_QUERIES:])
                    break
            still = np.array(later, int)
        return found

    def candidates(self, queries: np.ndarray, depth: int, k: int, own: list[slice]) -> np.ndarray:
        """Whether a row (column) can still be one of a query's k best when its lists are read to `depth`."""
        size, kind = len(self.ids), self.kind(queries)
        lower, upper = np.empty((len(queries), size), kind), np.empty((len(queries), size), kind)
        for start in range(0, size, STEP_ROWS):
            rows = slice(start, start + STEP_ROWS)
            lower[:, rows] = self.lower_bounds(queries, depth, rows)
            upper[:, rows] = self.upper_bounds(queries, depth, rows)
        for line, rows in zip(lower, own):
            line[rows] = -np.inf
        lower.partition(size - k, axis=1)
        return upper >= (lower[:, size - k].astype(np.float64) - 2 * self.slack(queries)).astype(kind)[:, None]

    def best(self, query: np.ndarray, left: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and final scores of the k best among some rows."""
        scores = self.scores(left, query)
        if len(left) > k:
            among = scores >= np.partition(scores, len(left) - k)[len(left) - k]
            left, scores = left[among], scores[among]
        first = np.lexsort((self.ids[left], -scores))[:k]
        return self.ids[left][first], scores[first]

    def slack(self, query: np.ndarray) -> np.ndarray:
        """What rounding may take from a bound: nothing in whole numbers, unless they are huge."""
        reach = self.reach(query)
        return np.where(reach < 2**50, 0.0, 1e-9 * reach)

    def kind(self, query: np.ndarray) -> type:
        """The smaller float in which bounds of the query, or of all queries, are exact, else the larger."""
        return np.float32 if self.reach(query).max() < 2**24 else np.float64

    def upper_bounds(self, query: np.ndarray, depth: int, rows: np.ndarray | slice) -> np.ndarray:
        """Scores if every entry not read were at the frontier of its list; its own value does not enter."""
        entries, high, low = self._read(query, depth, rows)
        return self._halves(query) @ np.hstack([np.maximum(entries, high), np.minimum(entries, low)]).T

    def lower_bounds(self, query: np.ndarray, depth: int, rows: np.ndarray | slice) -> np.ndarray:
        """Scores if every entry not read were the worst of its list; its own value does not enter."""
        entries, high, low = self._read(query, depth, rows)
        worst, most = self.value[0].astype(entries.dtype), self.value[-1].astype(entries.dtype)
        known = [np.where(entries >= high, entries, worst), np.where(entries <= low, entries, most)]
        return self._halves(query) @ np.hstack(known).T

    def _read(self, query: np.ndarray, depth: int, rows: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entries of some rows, and the frontiers at `depth` of lists read from above and from below.

        An entry is read if it stands before the frontier or equals it, so ties are
        read together.
        """
        kind = self.kind(query)
        entries = self.rows[rows].astype(kind, copy=False)
        return entries, self.value[-depth].astype(kind), self.value[depth - 1].astype(kind)

    def _halves(self, query: np.ndarray) -> np.ndarray:
        """The components whose lists are read from above, then those whose lists are read from below, else 0.

        What a depth makes known of a row depends on no query but for this
        choice, so one product with it gives the bounds of many queries.
        """
        return np.concatenate([np.maximum(query, 0), np.minimum(query, 0)], axis=-1).astype(self.kind(query))


def _search(k: int):
    types = to_arrow_schema(StructType.fromDDL(MADE))

    def run(table: pa.Table) -> pa.Table:
        vec, ids = table.column("vec").combine_chunks(), table.column("vec_id").to_numpy()
        asks = table.column("ask").to_numpy(zero_copy_only=False)
        sizes = vec.value_lengths().to_numpy(zero_copy_only=False)
        flat, starts = vec.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(sizes))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for dim in np.unique(sizes):  # only vectors of one length can be compared
            pick = lambda want: np.flatnonzero((sizes == dim) & (asks == want))
            rows, queries = pick(False), pick(True)
            if not len(rows) or not len(queries):
                continue
            matrix = flat[starts[rows][:, None] + np.arange(dim)]
            lists = SortedLists(ids[rows], matrix)
            tops = lists.tops(flat[starts[queries][:, None] + np.arange(dim)], min(k, len(rows)), ids[queries])
            out += [(np.full(len(found), at), found, scores) for at, (found, scores) in zip(ids[queries], tops)]
        parts = [np.concatenate(c) if out else np.array([], np.int64) for c in (zip(*out) if out else [[], [], []])]
        return pa.table([pa.array(p, pa.int64()) for p in parts], schema=types)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, block: int = BLOCK_ROWS, batch: int = BATCH_QUERIES) -> DataFrame:
    """For each row of `vectors` (vec_id, vec) that `is_query` marks, its k best other rows.

    query_id, rank (from 1), vec_id, score. Fewer than k other rows give all of
    them; ties go to the smaller vec_id. Vectors of different length are not
    compared. Every query meets every block: the number of tasks is blocks
    times batches, and batches are smaller where there would be fewer tasks than
    cores.
    """
    sizes = vectors.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    blocks = -(-sizes["n"] // block) or 1
    spread = min(-(-vectors.sparkSession.sparkContext.defaultParallelism // blocks), -(-sizes["q"] // STEP_QUERIES))
    batches = max(-(-sizes["q"] // batch), spread, 1)
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    candidates = vectors.select(
        "vec_id", "vec", F.lit(False).alias("ask"), deal(blocks, 1).alias("block"), all_of(batches).alias("batch")
    )
    queries = vectors.where(is_query).select(
        "vec_id", "vec", F.lit(True).alias("ask"), all_of(blocks).alias("block"), deal(batches, 2).alias("batch")
    )
    found = candidates.unionByName(queries).groupBy("block", "batch").applyInArrow(_search(k), MADE)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
