"""Order-dependent building blocks that survive hot keys.

A window that spans one key puts all rows of that key into one task. Where
only the extreme row is wanted an aggregate does it with a partial step on the
map side; where neighbours are wanted the key is cut into slices of the order
column and only one row per slice crosses the cuts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skerry.workspace import scratch


def latest_key(order: Sequence[Column]) -> Column:
    """One comparable column for `max_by`, never NULL itself; a missing order value counts as the earliest."""
    return F.struct(*[part.alias(f"o{i}{n}") for i, c in enumerate(order) for n, part in enumerate((c.isNotNull(), c))])


def first_key(order: Sequence[Column]) -> Column:
    """The same for `min_by`; a missing order value counts as the last."""
    return F.struct(*[part.alias(f"o{i}{n}") for i, c in enumerate(order) for n, part in enumerate((c.isNull(), c))])


def row_struct(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The whole row with the greatest `order` per key, by aggregation."""
    best = F.max_by(row_struct(df), latest_key(order))
    return df.groupBy(*keys).agg(best.alias("__row")).select("__row.*")


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The whole row with the least `order` per key, by aggregation."""
    best = F.min_by(row_struct(df), first_key(order))
    return df.groupBy(*keys).agg(best.alias("__row")).select("__row.*")


RANGE = "__range"


def range_slices(df: DataFrame, keys: Sequence[str], order: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """`df` dealt by ranges of (keys, order) and stored, with the number of its range in `RANGE`.

    Ranges are as many as shuffle partitions (adaptive execution merges small
    ones) or as stated, so that a key that holds all rows spreads over them. Pass
    `slice_by=F.col(RANGE)` to the operators below: the number never decreases
    with the order inside a key. Stored, because the bounds of ranges are drawn
    from samples and another evaluation might draw others.
    """
    path = scratch(df.sparkSession, "ranges")
    by = [*[F.col(k) for k in keys], *order]
    dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    dealt.withColumn(RANGE, F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.schema(f"{_fields(df)}, {RANGE} int").parquet(path)


HALO = "__halo"


def with_halo(dealt: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int) -> DataFrame:
    """Stored ranges (`range_slices`), each with the `rows` rows that stand before its first one, marked in `HALO`.

    A frame of `rows` rows back can then run in every range of a key alone. Only
    the last rows of ranges are copied, to the ranges that begin within reach,
    however short these are.
    """
    counts = dealt.groupBy(*keys, RANGE).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    last = Window.partitionBy(*keys, RANGE).orderBy(*[c.desc() for c in order])
    tails = dealt.withColumn("__back", F.row_number().over(last)).where(F.col("__back") <= rows)

    def named(df: DataFrame, tag: str, *others: Column) -> DataFrame:
        return df.select(*[F.col(k).alias(f"__{tag}{i}") for i, k in enumerate(keys)], *others)

    ends = named(starts, "s", F.col(RANGE).alias("__from"), (F.col("__start") + F.col("__n")).alias("__end"))
    own = [F.col(k).eqNullSafe(F.col(f"__s{i}")) for i, k in enumerate(keys)] + [F.col(RANGE) == F.col("__from")]
    placed = tails.join(ends, own)
    # A range starting at s takes the rows at positions s - rows + 1 to s; ranges of a key are as many as partitions.
    lists = starts.groupBy(*keys).agg(F.collect_list(F.struct(F.col("__start").alias("s"), F.col(RANGE).alias("r"))).alias("__ranges"))
    targets = named(lists, "t", F.col("__ranges"))
    same = [F.col(k).eqNullSafe(F.col(f"__t{i}")) for i, k in enumerate(keys)] or [F.lit(True)]
    position = F.col("__end") - F.col("__back") + 1
    reach = F.filter("__ranges", lambda x: (x["r"] > F.col("__from")) & (x["s"] >= position) & (x["s"] < position + rows))
    joined = placed.join(targets, same) if keys else placed.withColumn("__ranges", lists.select("__ranges").scalar())
    copies = joined.withColumn("__to", F.explode(reach)).withColumn(RANGE, F.col("__to.r"))
    columns = [F.col(f"`{c}`") for c in dealt.columns]
    return dealt.select(*columns, F.lit(False).alias(HALO)).unionByName(copies.select(*columns, F.lit(True).alias(HALO)))


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _tails(df: DataFrame, keys: Sequence[str], order: Column, col: str, slice_col: str) -> DataFrame:
    """Per key and slice, the last row's value."""
    return df.groupBy(*keys, slice_col).agg(F.max_by(col, order).alias("__tail"))


def previous_value(
    df: DataFrame, keys: Sequence[str], order: str, col: str, out: str, slice_by: Column | None = None
) -> DataFrame:
    """Value of the row before, per key.

    `slice_by` is a function of `order` that never decreases with it (a month
    of a timestamp, a division of an id). With it each window covers one slice
    of one key, and the first row of a slice takes the tail of the slice before.
    """
    if slice_by is None:
        return df.withColumn(out, F.lag(col).over(Window.partitionBy(*keys).orderBy(order)))
    cut = df.withColumn("__slice", slice_by)
    inside = Window.partitionBy(*keys, "__slice").orderBy(order)
    tails = _tails(cut, keys, F.col(order), col, "__slice").withColumn(
        "__before", F.lag("__tail").over(Window.partitionBy(*keys).orderBy("__slice"))
    )
    return (
        cut.withColumn("__n", F.row_number().over(inside))
        .withColumn("__lag", F.lag(col).over(inside))
        .join(tails.drop("__tail"), [*keys, "__slice"])
        .withColumn(out, F.when(F.col("__n") == 1, F.col("__before")).otherwise(F.col("__lag")))
        .drop("__slice", "__n", "__lag", "__before")
    )


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], slice_by: Column | None = None
) -> DataFrame:
    """Fill missing values with the last present one of the key; sliced like `previous_value`."""
    if slice_by is None:
        running = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(running) for c in columns})
    cut = df.withColumn("__slice", slice_by)
    inside = Window.partitionBy(*keys, "__slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    # Aggregates skip NULL orders, so a missing value does not become the tail.
    tails = cut.groupBy(*keys, "__slice").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__tail_{c}") for c in columns]
    )
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(
        *keys, "__slice", *[F.last(f"__tail_{c}", ignorenulls=True).over(before).alias(f"__before_{c}") for c in columns]
    )
    return (
        cut.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns})
        .join(carried, [*keys, "__slice"])
        .withColumns({c: F.coalesce(c, f"__before_{c}") for c in columns})
        .drop("__slice", *[f"__before_{c}" for c in columns])
    )


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, slice_by: Column | None = None
) -> DataFrame:
    """1-based position per key; `slice_by` must never decrease with the first order column."""
    if slice_by is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    cut = df.withColumn("__slice", slice_by)
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "__slice")
        .agg(F.count("*").alias("__n"))
        .select(*keys, "__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    inside = Window.partitionBy(*keys, "__slice").orderBy(*order)
    return (
        cut.withColumn("__rn", F.row_number().over(inside))
        .join(offsets, [*keys, "__slice"])
        .withColumn(out, F.col("__rn") + F.col("__offset"))
        .drop("__slice", "__rn", "__offset")
    )


def values_at_ranks(df: DataFrame, ranks: Mapping[str, Sequence[int]]) -> dict[str, tuple]:
    """The exact values of several columns at the given 1-based ranks among their present values.

    Equal values are counted first, whatever their number; the counts are dealt
    to ranges of (column, value) and stored. Totals per range, as many rows as
    partitions, say which range holds a rank, and only inside a range is there
    an order. One row comes back to the driver. All columns have one type.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("v")) for c in ranks])
    counted = df.select(F.inline(cells)).filter("v IS NOT NULL").groupBy("name", "v").agg(F.count("*").alias("n"))
    path = scratch(df.sparkSession, "ranks")
    counted.repartitionByRange("name", "v").withColumn("part", F.spark_partition_id()).write.parquet(path)
    dealt = df.sparkSession.read.parquet(path)
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("name", "part").agg(F.sum("n").alias("total")).select(
        "name", "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("name", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    seen = dealt.join(offsets, ["name", "part"]).withColumn("seen", F.sum("n").over(inside) + F.col("offset"))
    wanted = [(c, rank) for c, own in ranks.items() for rank in own]
    found = seen.agg(*[
        F.min(F.when((F.col("name") == c) & (F.col("seen") >= rank), F.col("v"))).alias(f"r{i}") for i, (c, rank) in enumerate(wanted)
    ]).first()
    values = iter(found)
    return {c: tuple(next(values) for _ in own) for c, own in ranks.items()}
