"""Operators over ordered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skerry.functions.measures import nan_to_null
from skerry.operators.ordering import (
    HALO,
    RANGE,
    carry_forward,
    first_rows,
    latest_key,
    latest_rows,
    positions,
    previous_value,
    range_slices,
    row_struct,
    values_at_ranks,
    with_halo,
)
from skerry.workspace import pin


def row_number_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Last row per key. An aggregate, so a hot key is reduced before it moves."""
    return latest_rows(df, keys, order)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the declared ingest order."""
    return first_rows(df, keys, order)


def log_returns(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], slice_by: Column | None = None
) -> DataFrame:
    """ln(value / value before) for each series; a row lacking any of them is dropped."""
    out = df
    for c in columns:
        out = previous_value(out, keys, order, c, f"__prev_{c}", slice_by)
    returns = {c: F.ln(F.try_divide(F.col(c), F.col(f"__prev_{c}"))) for c in columns}
    return out.withColumns(returns).drop(*[f"__prev_{c}" for c in columns]).dropna(subset=list(columns))


def pct_change(
    df: DataFrame, keys: Sequence[str], order: str, col: str, out: str = "growth_pct", slice_by: Column | None = None
) -> DataFrame:
    """Percent change to the row before, per key, after missing values are removed."""
    present = df.filter(nan_to_null(F.col(col)).isNotNull())
    lagged = previous_value(present, keys, order, col, "__prev", slice_by)
    change = (F.try_divide(F.col(col), F.col("__prev")) - 1) * 100
    return lagged.withColumn(out, change).drop("__prev")


def rolling_volatility(
    df: DataFrame, order: str, columns: Sequence[str], n: int = 30, periods: int = 252, keys: Sequence[str] = (), ranges: bool = False
) -> DataFrame:
    """Annualized sample deviation of the last `n` values, NULL until there are n.

    One window per key, or one for all rows. With `ranges` the rows are first dealt
    to stored ranges of (keys, order), and each range takes the n - 1 rows before
    it along, so that a series of any length uses all tasks.
    """
    scale = float(periods) ** 0.5

    def over(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
        frame = Window.partitionBy(*parts).orderBy(order).rowsBetween(-(n - 1), 0)
        return rows.withColumns({
            f"{c}_vol": F.when(F.count(c).over(frame) == n, F.stddev_samp(c).over(frame) * scale) for c in columns
        })

    if not ranges:
        return over(df, keys)
    dealt = range_slices(df, keys, [F.col(order)])
    whole = over(with_halo(dealt, keys, [F.col(order)], n - 1), [*keys, RANGE])
    return whole.where(~F.col(HALO)).drop(RANGE, HALO)


def latest_row(df: DataFrame, order: str) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(1)


def forward_fill(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], slice_by: Column | None = None
) -> DataFrame:
    """Carry the last present value forward inside each key."""
    return carry_forward(df, keys, order, columns, slice_by)


def rank_by(df: DataFrame, ranks: dict[str, Sequence[Column]]) -> DataFrame:
    """One 1..n position column per declared order. For grouped, small tables."""
    return df.withColumns({name: F.row_number().over(Window.orderBy(*order)) for name, order in ranks.items()})


def sequence_keys(df: DataFrame, order: Sequence[Column], out: str, slice_by: Column | None = None) -> DataFrame:
    """Dense keys 1..n in the declared order; `slice_by` spreads the numbering of a large table."""
    return positions(df, [], order, out, slice_by)


def burst_clusters(
    df: DataFrame, cell: Sequence[str], ts: str, span_seconds: int = 86_400, min_count: int = 3
) -> DataFrame:
    """Per cell, the first event whose following span holds `min_count` events, and how many it holds.

    Events fall into buckets as long as the span. A bucket with `min_count`
    events always starts a burst, so nothing after the first such bucket
    matters, and of each bucket only its first `min_count` events can decide.
    That keeps the ordered step small however many events a cell has.
    """
    keys = list(cell)
    span = span_seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    timed = df.select(*keys, micros.alias("__t"))
    # A missing cell is a group of its own here as in any grouping, so joins compare null-safe.
    bucketed = timed.withColumn("__bucket", F.floor(F.col("__t") / span))
    heads = (
        bucketed.withColumn("__n", F.row_number().over(Window.partitionBy(*keys, "__bucket").orderBy("__t")))
        .filter(F.col("__n") <= min_count)
    )
    # `min_count` events in one bucket end the search of the cell.
    ends = heads.groupBy(*keys).agg(F.min(F.when(F.col("__n") == min_count, F.col("__bucket"))).alias("__end"))
    same = [F.col(f"h.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys]
    scan = (
        heads.alias("h").join(ends.alias("e"), same)
        .filter(F.col("__end").isNull() | (F.col("__bucket") <= F.col("__end")))
        .select(*[F.col(f"h.{k}") for k in keys], "__t")
    )
    nth = F.lead("__t", min_count - 1).over(Window.partitionBy(*keys).orderBy("__t"))
    starts = (
        scan.withColumn("__nth", nth).filter(F.col("__nth") - F.col("__t") <= span)
        .groupBy(*keys).agg(F.min("__t").alias("__start"))
    )
    match = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    inside = (F.col("__t") >= F.col("__start")) & (F.col("__t") <= F.col("__start") + span)
    return (
        timed.alias("t").join(starts.alias("s"), match).filter(inside)
        .groupBy(*[F.col(f"s.{k}").alias(k) for k in keys], F.col("__start"))
        .agg(F.count("*").alias("count"))
        .select(*keys, F.timestamp_micros("__start").alias("start"), "count")
    )


def moments(df: DataFrame, columns: Sequence[str]) -> Column:
    """Scalar subquery: struct with `<col>_mean` and `<col>_std` (sample) of each column."""
    stats = []
    for c in columns:
        value = nan_to_null(F.col(c))
        stats += [F.avg(value).alias(f"{c}_mean"), F.stddev_samp(value).alias(f"{c}_std")]
    return df.agg(F.struct(*stats).alias("moments")).scalar()


def zscore_outliers(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Rows further than k sample deviations from the mean, with their score."""
    stats = moments(df, [col])
    score = F.try_divide(
        F.abs(nan_to_null(F.col(col)) - stats.getField(f"{col}_mean")), stats.getField(f"{col}_std")
    )
    return df.withColumn("zscore", score).filter(F.col("zscore") > k)


def minmax_scale(df: DataFrame, columns: Sequence[str], suffix: str = "_norm") -> DataFrame:
    """Scale to 0..100; a constant (or empty) column becomes 50 in every row."""
    bounds = df.agg(F.struct(*[
        F.struct(F.min(nan_to_null(F.col(c))).alias("lo"), F.max(nan_to_null(F.col(c))).alias("hi")).alias(c)
        for c in columns
    ]).alias("b")).scalar()
    scaled = {}
    for c in columns:
        lo, hi = bounds.getField(c).getField("lo"), bounds.getField(c).getField("hi")
        scaled[f"{c}{suffix}"] = F.when(
            hi > lo, F.try_divide(nan_to_null(F.col(c)) - lo, hi - lo) * 100
        ).otherwise(F.lit(50.0))
    return df.withColumns(scaled)


def lead_time_stats(df: DataFrame, ts: str, col: str) -> DataFrame:
    """Mean and sample deviation per day number, counted from the first timestamp (day 1)."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    first = df.agg(F.min(micros)).scalar()
    day = (F.floor((micros - first) / 86_400_000_000) + 1).cast("bigint")
    return df.groupBy(day.alias("lead_day")).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))


def lead_time_span(stats: DataFrame) -> DataFrame:
    """Days analysed and the deviation of the first and of the last day."""
    return stats.agg(
        F.count("*").alias("days"),
        F.min_by("std", "lead_day").alias("first_day_std"),
        F.max_by("std", "lead_day").alias("last_day_std"),
    )


def first_half(df: DataFrame, order: str) -> Column:
    """Condition for the first floor(n/2) rows by a unique order column.

    The boundary is an exact rank, found without a task that sorts the whole table.
    """
    n = df.agg(F.count(order)).first()[0]
    if n < 2:
        return F.lit(False)
    (boundary,) = values_at_ranks(df, {order: [n // 2]})[order]
    return F.col(order) <= F.lit(boundary)


def half_shift(df: DataFrame, order: str, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """Per column: means of both halves, their distance and whether it stays within k first-half deviations."""
    halves = df.withColumn("__first", first_half(df, order))
    one = halves.agg(*[half_struct(F.col("__first"), c, k).alias(c) for c in columns])
    return one.select(F.inline(F.array(*columns)))


def half_struct(first: Column, col: str, k: float) -> Column:
    """Aggregate: struct comparing the rows where `first` holds with the others."""
    head, tail = F.avg(F.when(first, F.col(col))), F.avg(F.when(~first, F.col(col)))
    threshold = F.stddev_samp(F.when(first, F.col(col))) * k
    return F.struct(
        F.lit(col).alias("column_name"), head.alias("first_mean"), tail.alias("second_mean"),
        F.abs(tail - head).alias("mean_diff"), threshold.alias("threshold"),
        F.coalesce(F.abs(tail - head) <= threshold, F.lit(False)).alias("stable"),
    )


def sigma_events(df: DataFrame, series: str, col: str, k: float = 2.0) -> DataFrame:
    """Rows whose absolute value is above mean + k deviations of their series, with the deviation."""
    stats = df.groupBy(series).agg(F.avg(col).alias("__mean"), F.stddev_samp(col).alias("__std"))
    size = F.abs(F.col(col))
    return (
        df.join(stats, series).filter(size > F.col("__mean") + k * F.col("__std"))
        .withColumn("std_devs", F.try_divide(size, F.col("__std"))).drop("__mean", "__std")
    )


def largest_events(events: DataFrame, col: str, ties: Sequence[str], n: int = 20) -> DataFrame:
    """The n largest by absolute value, next to the number of all events."""
    total = events.agg(F.count("*")).scalar()
    return events.withColumn("total_events", total).orderBy(F.desc(F.abs(F.col(col))), *ties).limit(n)


def residuals_in_one_pass(df: DataFrame, keys: Sequence[str], order: Sequence[Column], x: str, y: str) -> DataFrame:
    """`residual_rank` against the log model of the same rows, which are read once.

    Each key is reduced to its latest row and its share of the sums of the fit;
    these rows are checkpointed, then added up for the line and ranked by it.
    """
    pin(df.sparkSession)
    lx, ys = F.ln(F.col(x).cast("double")), F.col(y).cast("double")
    usable = lx.isNotNull() & ~F.isnan(lx) & ys.isNotNull() & ~F.isnan(ys)
    sums = {"n": F.lit(1.0), "sx": lx, "sy": ys, "sxx": lx * lx, "sxy": lx * ys}
    present = F.col(x).isNotNull() & F.col(y).isNotNull()
    reduced = df.groupBy(*keys).agg(
        F.max_by(F.when(present, row_struct(df)), F.when(present, latest_key(order))).alias("__row"),
        *[F.coalesce(F.sum(F.when(usable, v)), F.lit(0.0)).alias(f"__{name}") for name, v in sums.items()],
    ).checkpoint()
    n, sx, sy, sxx, sxy = (F.sum(f"__{name}") for name in sums)
    spread = n * sxx - sx * sx
    # A line needs three rows and two places; else it is zero, as in `log_regression`.
    slope = F.coalesce(F.when((n >= 3) & (spread > 1e-9 * n * sxx), (n * sxy - sx * sy) / spread), F.lit(0.0))
    level = F.coalesce(F.when((n >= 3) & (spread > 1e-9 * n * sxx), (sy - slope * sx) / n), F.lit(0.0))
    model = reduced.agg(slope.alias("slope"), level.alias("intercept"))
    return _against(reduced.where("__row IS NOT NULL").select("__row.*"), model, x, y)


def residual_rank(
    df: DataFrame, model: DataFrame, keys: Sequence[str], order: Sequence[Column], x: str, y: str
) -> DataFrame:
    """Latest row per key against a one-row log model: prediction, residual and direction."""
    return _against(latest_rows(df.dropna(subset=[x, y]), keys, order), model, x, y)


def _against(latest: DataFrame, model: DataFrame, x: str, y: str) -> DataFrame:
    fit = model.select(F.struct("slope", "intercept")).scalar()
    predicted = fit.getField("slope") * F.ln(F.col(x)) + fit.getField("intercept")
    return (
        latest.withColumn("predicted", predicted)
        .withColumn("residual", F.col(y) - F.col("predicted"))
        .withColumn("direction", F.when(F.col("residual") < 0, "better").otherwise("worse"))
    )
