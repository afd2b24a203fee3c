"""Correlations of many columns from blocked sums of products.

Each task turns its Arrow batches into a matrix of values and one of presence and
adds up, per pair of column blocks, how many rows have both values, their sums,
squares and products. The blocks of all tasks are dealt by pair and added as a
stream. A plan of k²/2 expressions does not compile for thousands of columns; here
the plan has a fixed size, and a task holds the blocks of one pair of panels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skerry.functions.measures import nan_to_null

BLOCK = 128
# Columns of one pass over the rows: two panels, 4 matrices of PANEL x PANEL doubles a task.
PANEL = 1_024
SUMS = "left int, right int, sums binary"
CELLS = "x string, y string, r double"
# A variance under this share of the mean square is that of a constant, but for rounding.
CONSTANT = 1e-12


def correlation_blocks(df: DataFrame, columns: Sequence[str], block: int = BLOCK, panel: int = PANEL) -> DataFrame:
    """Pairwise-complete correlations of all pairs, long form (x, y, r), both triangles.

    NULL where a side is constant over the rows that have both values, or there
    are none. Values are taken less their column's mean, so that large ones lose
    no digits.
    """
    columns = list(columns)
    if not columns:
        return df.sparkSession.createDataFrame([], CELLS)
    numbers = df.select([nan_to_null(F.col(f"`{c}`").cast("double")).alias(c) for c in columns])
    means = numbers.agg(*[F.avg(f"`{c}`") for c in columns]).first()
    centre = np.array([0.0 if m is None or not np.isfinite(m) else m for m in means])
    starts = range(0, len(columns), panel)
    parts = [_panels(numbers, columns, centre, a, b, block, panel) for a, b in combinations_with_replacement(starts, 2)]
    return reduce(DataFrame.unionAll, parts)


def _panels(
    numbers: DataFrame, columns: list[str], centre: np.ndarray, a: int, b: int, block: int, panel: int
) -> DataFrame:
    """Cells of two panels of columns, or of one with itself; only their columns are read."""
    own = list(range(a, min(a + panel, len(columns)))) + ([] if a == b else list(range(b, min(b + panel, len(columns)))))
    names, shift = [columns[i] for i in own], centre[own]
    half = len(own) if a == b else min(panel, len(columns) - a)
    cuts = [*range(0, half, block), *range(half, len(own), block), len(own)]
    blocks = [slice(lo, hi) for lo, hi in zip(cuts, cuts[1:])]
    first_right = next((i for i, s in enumerate(blocks) if s.start >= half), len(blocks))
    pairs = [(i, j) for i in range(len(blocks)) for j in range(i, len(blocks)) if a == b or i < first_right <= j]

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - shift
            there = ~np.isnan(values)
            values, present = np.where(there, values, 0.0), there.astype(np.float64)
            squares = values * values
            for i, j in pairs:
                x, y = blocks[i], blocks[j]
                sums = np.stack([
                    present[:, x].T @ present[:, y], values[:, x].T @ present[:, y], present[:, x].T @ values[:, y],
                    squares[:, x].T @ present[:, y], present[:, x].T @ squares[:, y], values[:, x].T @ values[:, y],
                ])
                held[i, j] = held[i, j] + sums if (i, j) in held else sums
        for (i, j), sums in held.items():
            yield _batch([i], [j], [sums.tobytes()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for i, j, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (i, j) != at:
                    if at is not None:
                        yield from cells(at, total)
                    at, total = (i, j), 0.0
                total = total + np.frombuffer(raw)
        if at is not None:
            yield from cells(at, total)

    def cells(at: tuple[int, int], total: np.ndarray) -> Iterator[pa.RecordBatch]:
        x, y = (names[blocks[k]] for k in at)
        n, sx, sy, sxx, syy, sxy = total.reshape(6, len(x), len(y))
        with np.errstate(invalid="ignore", divide="ignore"):
            vx, vy = sxx - sx * sx / n, syy - sy * sy / n
            r = (sxy - sx * sy / n) / np.sqrt(vx * vy)
        r[~((n > 0) & (vx > CONSTANT * sxx) & (vy > CONSTANT * syy))] = np.nan
        yield _cells(np.repeat(x, len(y)), np.tile(y, len(x)), r.ravel())
        if at[0] != at[1]:
            yield _cells(np.tile(y, len(x)), np.repeat(x, len(y)), r.ravel())

    summed = numbers.select([f"`{c}`" for c in names]).mapInArrow(collect, SUMS)
    return summed.repartition("left", "right").sortWithinPartitions("left", "right").mapInArrow(add, CELLS)


def _batch(left: list[int], right: list[int], sums: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array(left, pa.int32()), pa.array(right, pa.int32()), pa.array(sums, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["left", "right", "sums"])


def _cells(x: np.ndarray, y: np.ndarray, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(r, mask=np.isnan(r))], names=["x", "y", "r"])
