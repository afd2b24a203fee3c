"""Grouped and global summaries. All aggregate on the map side before any shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skerry.functions.bands import band_index, exceeds
from skerry.functions.measures import nan_to_null
from skerry.operators.ordering import first_key, latest_key

# Named aggregate functions accepted where an aggregation is a parameter.
AGGREGATES = {
    "count": F.count,
    "sum": F.sum,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "nunique": F.count_distinct,
}


def _rounded(column: Column, how: str, digits: int) -> Column:
    return column if how in ("count", "nunique") else F.round(column, digits)


def summarize_by(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, tuple[str, str]], digits: int = 2
) -> DataFrame:
    """Named aggregates `{name: (column, how)}` per group; rows with a missing key are dropped."""
    exprs = [_rounded(AGGREGATES[how](F.col(c)), how, digits).alias(name) for name, (c, how) in aggs.items()]
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*exprs)


def daily_profile(df: DataFrame, day: str, entity: str, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Per day: distinct entities, mean and sample deviation of each column."""
    exprs = [F.count_distinct(entity).alias("entities")]
    for c in columns:
        exprs += [F.round(F.avg(c), digits).alias(f"{c}_mean"), F.round(F.stddev_samp(c), digits).alias(f"{c}_std")]
    return df.groupBy(F.to_date(day).alias("day")).agg(*exprs)


def crosstab_margins(
    df: DataFrame, row: str, col: str, edges: Sequence[float], labels: Sequence[str], total: str = "All"
) -> DataFrame:
    """Counts of row value by band with totals on both sides; values outside the bands leave the table."""
    banded = df.withColumn("__band", band_index(F.col(col), edges)).filter(F.col("__band").isNotNull())
    cells = [F.count_if(F.col("__band") == i).alias(name) for i, name in enumerate(labels)]
    counted = banded.rollup(row).agg(F.grouping(row).alias("__all"), *cells, F.count("*").alias(total))
    label = F.when(F.col("__all") == 1, F.lit(total)).otherwise(F.col(row))
    return counted.select(label.alias(row), *labels, total)


def value_counts(df: DataFrame, col: str, n: int | None = None, by_value: bool = False) -> DataFrame:
    """Frequencies without missing values, most frequent first (ties by value), or by value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
    ordered = counts.orderBy(col) if by_value else counts.orderBy(F.desc("count"), F.asc(col))
    return ordered.limit(n) if n is not None else ordered


def rollup_ratio(df: DataFrame, key: str, num: str, den: str, digits: int = 1) -> DataFrame:
    """Per group: rows, both sums, the mean of the first and the ratio of the sums."""
    return df.groupBy(key).agg(
        F.count("*").alias("members"),
        F.sum(num).alias(f"total_{num}"),
        F.sum(den).alias(f"total_{den}"),
        F.avg(num).alias(f"avg_{num}"),
        F.round(F.try_divide(F.sum(num), F.sum(den)), digits).alias("ratio"),
    )


def group_size(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def spread_by_time(df: DataFrame, time: str, col: str) -> DataFrame:
    """Least, greatest and mean value over all entities at each time."""
    return df.groupBy(time).agg(
        F.min(col).alias("min_value"), F.max(col).alias("max_value"), F.avg(col).alias("mean_value")
    )


def spread_overall(spread: DataFrame) -> DataFrame:
    """Extremes over the per-time spreads."""
    return spread.agg(
        F.min("min_value").alias("overall_min"),
        F.max("max_value").alias("overall_max"),
        F.max(F.col("max_value") - F.col("min_value")).alias("widest_spread"),
    )


def argmax_by(df: DataFrame, group: Sequence[str], measure: str, label: str, largest: bool = True) -> DataFrame:
    """Label of the extreme measure per group; the first label wins a tie."""
    rank = -F.col(measure) if largest else F.col(measure)
    present = df.filter(nan_to_null(F.col(measure)).isNotNull())
    extreme = F.max(measure) if largest else F.min(measure)
    return present.groupBy(*group).agg(F.min_by(label, F.struct(rank, F.col(label))).alias(label), extreme.alias(measure))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Per key and column, the last value that is present."""
    return df.groupBy(*keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), latest_key(order))).alias(c) for c in columns]
    )


def pivot_first(
    df: DataFrame, index: Sequence[str], col: str, value: str, names: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Long to wide for the given names; the first present value of a cell is taken."""
    cells = [
        F.min_by(value, F.when((F.col(col) == n) & F.col(value).isNotNull(), first_key(order))).alias(n) for n in names
    ]
    return df.groupBy(*index).agg(*cells)


def latest_wide(
    df: DataFrame, index: Sequence[str], col: str, value: str, names: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Long to wide with the latest present value per name: both steps in one aggregate."""
    cells = [
        F.max_by(value, F.when((F.col(col) == n) & F.col(value).isNotNull(), latest_key(order))).alias(n) for n in names
    ]
    return df.groupBy(*index).agg(*cells)


def category_distribution(
    df: DataFrame, entity: str, category: str, domain: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Counts per entity for every category of the domain, zeros included.

    `weight` holds the row counts of an input that was counted before.
    """
    def cell(name: str) -> Column:
        hit = F.col(category) == name
        return F.count_if(hit) if weight is None else F.sum(F.when(hit, F.col(weight)).otherwise(0))

    return df.groupBy(entity).agg(*[cell(c).alias(c) for c in domain])


def exceedance_counts(df: DataFrame, entity: str, limits: Mapping[str, float]) -> DataFrame:
    """Per entity: how often each measure is above its limit, and the rows seen."""
    counts = [F.count_if(exceeds(F.lit(c), F.col(c), {c: limit})).alias(f"{c}_over") for c, limit in limits.items()]
    return df.groupBy(entity).agg(*counts, F.count("*").alias("observations"))


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Several counts of conditions in one pass."""
    return df.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def worst_category(
    df: DataFrame, entity: str, category: str, worst_first: Sequence[str], advice: Mapping[str, str]
) -> DataFrame:
    """Most severe category seen per entity with its advice; the mildest when none is known."""
    order = F.array(*[F.lit(c) for c in worst_first])
    rank = F.nullif(F.array_position(order, F.col(category)), F.lit(0))
    worst = F.get(order, F.coalesce(F.min(rank), F.lit(len(worst_first))).cast("int") - 1)
    texts = F.array(*[F.lit(advice.get(c, "No data available.")) for c in worst_first])
    out = df.groupBy(entity).agg(worst.alias("worst_category"))
    advised = F.get(texts, F.array_position(order, F.col("worst_category")).cast("int") - 1)
    return out.withColumn("advisory", advised)


def histogram_bins(
    df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str], right: bool = True
) -> DataFrame:
    """Counts per bin in edge order, empty bins included; one pass, no join."""
    index = band_index(F.col(col), edges, right)
    counts = df.select(index.alias("__i")).agg(*[F.count_if(F.col("__i") == i).alias(f"b{i}") for i in range(len(labels))])
    rows = [
        F.struct(F.lit(i).alias("bin_no"), F.lit(n).alias("bin"), F.col(f"b{i}").alias("count"))
        for i, n in enumerate(labels)
    ]
    return counts.select(F.inline(F.array(*rows)))


def with_grid(df: DataFrame, lat: str, lon: str, size: float = 10.0) -> DataFrame:
    """Floor both coordinates to a cell."""
    return df.withColumns({
        "lat_bin": (F.floor(F.col(lat) / size) * size).cast("double"),
        "lon_bin": (F.floor(F.col(lon) / size) * size).cast("double"),
    })


def grid_bins(df: DataFrame, lat: str, lon: str, size: float = 10.0) -> DataFrame:
    return group_size(with_grid(df, lat, lon, size), ["lat_bin", "lon_bin"])


def band_depths(df: DataFrame, lat: str, lon: str, depth: str, size: float = 10.0) -> DataFrame:
    """Mean and greatest depth per latitude band."""
    return with_grid(df, lat, lon, size).groupBy("lat_bin").agg(
        F.avg(depth).alias("depth_mean"), F.max(depth).alias("depth_max")
    )


def hourly_cycle(df: DataFrame, ts: str, col: str) -> DataFrame:
    """One row: hours of the lowest and highest mean, weekday and weekend means; 0 where there is no data.

    The rows shrink to at most 48 partial sums before the second step.
    """
    sums = df.filter(F.col(col).isNotNull()).groupBy(
        F.hour(ts).alias("hour"), (F.weekday(F.col(ts)) < 5).alias("weekday")
    ).agg(F.sum(col).alias("s"), F.count("*").alias("n"))
    hours = sums.groupBy("hour").agg((F.sum("s") / F.sum("n")).alias("mean"))
    picks = hours.agg(
        F.coalesce(F.min_by("hour", F.struct("mean", "hour")), F.lit(0)).alias("lowest_hour"),
        F.coalesce(F.min_by("hour", F.struct(-F.col("mean"), F.col("hour"))), F.lit(0)).alias("highest_hour"),
    )

    def share(flag: Column, name: str) -> Column:
        return F.coalesce(F.try_divide(F.sum(F.when(flag, F.col("s"))), F.sum(F.when(flag, F.col("n")))), F.lit(0.0)).alias(name)

    means = sums.agg(share(F.col("weekday"), "weekday_mean"), share(~F.col("weekday"), "weekend_mean"))
    both = means.select(F.struct("*")).scalar()
    return picks.select(
        "*", both.getField("weekday_mean").alias("weekday_mean"), both.getField("weekend_mean").alias("weekend_mean")
    )


def mix_summary(df: DataFrame, key: str, share: str, digits: int = 1) -> DataFrame:
    """Mean and greatest share per component, largest mean first."""
    return df.groupBy(key).agg(
        F.round(F.avg(share), digits).alias("mean_share"), F.round(F.max(share), digits).alias("max_share")
    ).orderBy(F.desc("mean_share"), key)


def period_rollup(df: DataFrame, ts: str, period: str, aggs: Mapping[str, str]) -> DataFrame:
    """Per calendar period (year, quarter, month, day), a different aggregate per column."""
    start = F.date_trunc(period, ts).cast("date")
    return df.groupBy(start.alias("period")).agg(*[AGGREGATES[how](c).alias(f"{c}_{how}") for c, how in aggs.items()])


def extreme_days(df: DataFrame, ts: str, high: str, low: str, hi: float, lo: float) -> DataFrame:
    """Days per year at or above `hi` and at or below `lo`; the row without a year is the total."""
    return (
        df.withColumn("year", F.year(ts)).rollup("year")
        .agg(F.count_if(F.col(high) >= hi).alias("hot_days"), F.count_if(F.col(low) <= lo).alias("cold_days"))
    )


def bounding_box(df: DataFrame, lat: str, lon: str, by: Sequence[str] = ()) -> DataFrame:
    """Extent of the points that have both coordinates."""
    points = df.dropna(subset=[lat, lon])
    return points.groupBy(*by).agg(
        F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"),
        F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"), F.count("*").alias("points"),
    )


def score_summary(df: DataFrame, entity: str, score: str) -> DataFrame:
    """Mean and greatest score per entity, 0 where there is none."""
    return df.groupBy(entity).agg(
        F.coalesce(F.avg(score), F.lit(0.0)).alias("avg_risk"), F.coalesce(F.max(score), F.lit(0.0)).alias("max_risk")
    )


def amplitude_extremes(df: DataFrame, entity: str, label: str, col: str) -> DataFrame:
    """Per entity: range, labels of both extremes (first on ties), ratio where the minimum is positive."""
    lo, hi = F.min(col), F.max(col)
    return df.filter(F.col(col).isNotNull()).groupBy(entity).agg(
        (hi - lo).alias("amplitude"),
        lo.alias("min_value"),
        F.min_by(label, F.struct(F.col(col), F.col(label))).alias("min_label"),
        hi.alias("max_value"),
        F.min_by(label, F.struct(-F.col(col), F.col(label))).alias("max_label"),
        F.when(lo > 0, hi / lo).alias("ratio"),
    )


def source_summary(df: DataFrame, source: str, entity: str) -> DataFrame:
    return df.groupBy(source).agg(F.count("*").alias("rows"), F.count_distinct(entity).alias("entities"))


def summary_table(df: DataFrame, key: str, value: str, valid: str) -> DataFrame:
    """Mean, extremes and count over the rows flagged valid."""
    return df.filter(F.col(valid)).groupBy(key).agg(
        F.avg(value).alias("avg_value"), F.min(value).alias("min_value"),
        F.max(value).alias("max_value"), F.count("*").alias("record_count"),
    )
