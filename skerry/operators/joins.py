"""Joins and set lookups.

No side is broadcast by hand: adaptive execution broadcasts a side when its
measured size allows and splits skewed partitions otherwise. Detail sides are
reduced before the join wherever the result allows it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from skerry.functions.bands import ladder
from skerry.operators.ordering import latest_rows, positions
from skerry.operators.sets import common_keys


def join_inner(left: DataFrame, right: DataFrame, keys: Sequence[str], integer_keys: Sequence[str] = ()) -> DataFrame:
    """Inner equi-join; the named keys are coerced to integers first, unparseable ones match nothing."""
    def coerced(df: DataFrame) -> DataFrame:
        return df.withColumns({k: F.col(k).try_cast("bigint") for k in integer_keys})

    return coerced(left).join(coerced(right), list(keys))


def join_left_fill(left: DataFrame, right: DataFrame, keys: Sequence[str], fills: Mapping[str, object]) -> DataFrame:
    """Left join, unmatched measures take their fill value."""
    return left.join(right, list(keys), "left").fillna(dict(fills))


def join_outer_chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of any number of tables on the same keys."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), frames)


def join_left_dim(fact: DataFrame, dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Every fact row, with dimension attributes where the key is known."""
    return fact.join(dim, key, "left")


def join_latest(dim: DataFrame, fact: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Each dimension row with its latest fact row, if any. The fact side shrinks to one row per key first."""
    return dim.join(latest_rows(fact, keys, order), list(keys), "left")


def align_complete(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Keys present in all inputs with a value in every other column."""
    kept = [df.dropna(subset=[c for c in df.columns if c not in keys]) for df in frames]
    return reduce(lambda a, b: a.join(b, list(keys)), kept)


def enrich_lookup(
    df: DataFrame, lookups: Sequence[tuple[DataFrame, str, Mapping[str, object]]]
) -> DataFrame:
    """Left join each lookup `(table, key, {column: default})`; a default of None leaves NULL."""
    out = df
    for table, key, defaults in lookups:
        out = out.join(table.select(key, *defaults), key, "left")
        fills = {c: v for c, v in defaults.items() if v is not None}
        out = out.fillna(fills) if fills else out
    return out


def filter_known(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key exists in the dimension."""
    return df.join(dim, list(keys), "left_semi")


def find_orphans(detail: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """Detail keys the master lacks, with row counts. Counted before the join."""
    counts = detail.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("orphan_rows"))
    return counts.join(master.select(key), key, "left_anti")


def outside_validity(
    detail: DataFrame, master: DataFrame, key: str, day: str, valid_from: str, valid_to: str
) -> DataFrame:
    """Joined rows dated before the start or after the end of their master's validity."""
    joined = detail.join(master, key)
    return joined.filter((F.col(day) < F.col(valid_from)) | (F.col(day) > F.col(valid_to)))


def rule_violations(detail: DataFrame, master: DataFrame, key: str, rule: Column, detail_text: Column) -> DataFrame:
    """Rows breaking a rule over both tables, with a description."""
    return detail.join(master, key).filter(rule).withColumn("detail", detail_text)


def zip_series(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    slice_by: Column | None = None,
) -> DataFrame:
    """Pair two series of each entity by position, cut to the shorter one."""
    left, right = (positions(df, keys, order, "position", slice_by) for df in (a, b))
    shared = [c for c in b.columns if c in a.columns and c not in keys]
    return left.join(right.drop(*shared), [*keys, "position"])


def attach_baseline(df: DataFrame, group: Sequence[str], col: str, baseline: str, anomaly: str) -> DataFrame:
    """Mean of the group next to every row, and the difference from it."""
    means = df.groupBy(*group).agg(F.avg(col).alias(baseline))
    return df.join(means, list(group)).withColumn(anomaly, F.col(col) - F.col(baseline))


def new_only(files: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Files the manifest does not list."""
    return files.join(manifest.select(key).distinct(), key, "left_anti")


def calendar_gaps(df: DataFrame, day: str, by: Sequence[str] = ()) -> DataFrame:
    """Days between the first and the last one that have no row."""
    days = df.select(*by, F.to_date(day).alias("day")).dropna().distinct()
    span = days.groupBy(*by).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    full = span.select(*by, F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return full.join(days, [*by, "day"], "left_anti")


def missing_dates(df: DataFrame, day: str, by: Sequence[str] = (), first: int = 5) -> DataFrame:
    """Per group: expected days, missing days and the first few missing ones as text."""
    days = df.select(*by, F.to_date(day).alias("day")).dropna().distinct()
    # A group without a `by` column is one group; a constant key keeps one code path.
    keys = list(by) or ["__all"]
    if not by:
        days = days.withColumn("__all", F.lit(0))
    spans = days.groupBy(*keys).agg(
        (F.datediff(F.max("day"), F.min("day")) + 1).alias("expected_days"),
        F.count("*").alias("present_days"),
    )
    gaps = calendar_gaps(days, "day", keys)
    head = Window.partitionBy(*keys).orderBy("day")
    firsts = (
        gaps.withColumn("__n", F.row_number().over(head))
        .filter(F.col("__n") <= first)
        .groupBy(*keys)
        .agg(F.array_join(F.sort_array(F.collect_list(F.date_format("day", "yyyy-MM-dd"))), ",").alias("first_missing"))
    )
    out = spans.join(firsts, keys, "left").select(
        *keys,
        F.col("expected_days").cast("bigint").alias("expected_days"),
        (F.col("expected_days") - F.col("present_days")).alias("missing_days"),
        F.coalesce("first_missing", F.lit("")).alias("first_missing"),
    )
    return out if by else out.drop("__all")


def cross_grid(df: DataFrame, name: str, values: Sequence[object]) -> DataFrame:
    """Every row with every value of a short fixed dimension; an explode, not a join."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def combine_scores(
    a: DataFrame,
    b: DataFrame,
    key: str,
    scores: tuple[str, str],
    weights: tuple[float, float],
    bands: Sequence[tuple[float, str]],
    top: str,
) -> DataFrame:
    """Weighted sum of two scores by key, an absent score counts 0, then banded."""
    first, second = (F.coalesce(F.col(s), F.lit(0.0)) for s in scores)
    joined = a.select(key, scores[0]).join(b.select(key, scores[1]), key, "full")
    scored = joined.withColumn("composite", first * weights[0] + second * weights[1])
    return scored.select(key, "composite", ladder(F.col("composite"), bands, top).alias("category"))


def edges_undirected(df: DataFrame, node: str, neighbours: str) -> DataFrame:
    """Distinct undirected edges `(src, dst)` with src <= dst from neighbour arrays."""
    pairs = df.select(F.col(node).alias("a"), F.explode(neighbours).alias("b"))
    return pairs.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()


def graph_nodes(df: DataFrame, node: str, edges: DataFrame) -> DataFrame:
    """All nodes, including neighbours that have no row of their own."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias(node))
    return df.select(node).unionByName(ends).distinct()


def nodes_of(df: DataFrame, node: str, neighbours: str) -> DataFrame:
    """`graph_nodes` from the neighbour arrays themselves, in the pass that makes them."""
    return df.select(F.explode(F.array_union(F.array(node), F.coalesce(neighbours, F.array()))).alias(node)).distinct()


def ready_slots(frames: Sequence[DataFrame], slot: str) -> DataFrame:
    """Slots every input has."""
    return reduce(lambda a, b: a.join(b, slot), [df.select(slot).distinct() for df in frames])


def inputs_ready(frames: Sequence[DataFrame], slot: str) -> list[DataFrame]:
    """Each input cut to the slots all of them have."""
    ready = ready_slots(frames, slot)
    return [df.join(ready, slot, "left_semi") for df in frames]


def tagged_inputs_ready(df: DataFrame, slot: Sequence[str], tag: str, tags: Sequence[str]) -> DataFrame:
    """`inputs_ready` for inputs that are kinds of rows of one table: rows of the slots that hold every kind.

    One pass finds the slots, reduced before they move, and one keeps the rows; a
    single pass would have to hold all rows of a slot together.
    """
    wanted = df.where(F.col(tag).isin(list(tags)))
    ready = common_keys(wanted, slot, tag, tags)
    return wanted.join(ready.select(*[F.col(k).alias(f"__{k}") for k in slot]), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in slot], "left_semi")
