"""Unions and key set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from skerry.operators.rows import select_present


def concat_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all inputs, aligned by name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def concat_common(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """Union over the listed columns each input has."""
    return concat_frames([select_present(df, columns) for df in frames])


def key_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of `left` that `right` lacks.

    Both sides are reduced to distinct keys first, so repeats of a hot key
    never reach the join.
    """
    names = list(keys)
    return left.select(names).distinct().join(right.select(names).distinct(), names, "left_anti")


def key_difference_summary(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: distinct keys in `left`, how many `right` has, how many are missing."""
    names = list(keys)
    known = right.select(names).distinct().withColumn("__known", F.lit(1))
    return (
        left.select(names).distinct().join(known, names, "left")
        .agg(F.count("*").alias("total"), F.count("__known").alias("matched"))
        .withColumn("missing", F.col("total") - F.col("matched"))
    )


def key_intersection(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys every input has; repeats are dropped before the sides meet."""
    return reduce(DataFrame.intersect, [df.select(list(keys)).distinct() for df in frames])


def common_keys(df: DataFrame, keys: Sequence[str], tag: str, values: Sequence[object]) -> DataFrame:
    """Distinct keys that occur with every value of a tag column: the intersection of slices of one table, in one pass."""
    has = [F.max((F.col(tag) == v).cast("int")).alias(f"__has{i}") for i, v in enumerate(values)]
    seen = df.filter(F.col(tag).isin(list(values))).groupBy(*keys).agg(*has)
    return seen.filter(" AND ".join(f"__has{i} = 1" for i in range(len(values)))).select(*keys)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
