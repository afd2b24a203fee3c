"""Correlation, regression, errors and distribution summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skerry.functions.measures import nan_to_null
from skerry.operators.gram import correlation_blocks
from skerry.operators.ordering import values_at_ranks


def finite(value: Column) -> Column:
    """NULL for missing, NaN and infinite values."""
    number = value.cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def exact_medians(df: DataFrame, rows: Mapping[str, int]) -> dict[str, float | None]:
    """Mean of the two middle values per column, given how many values each has."""
    middle = {c: ((n + 1) // 2, n // 2 + 1) for c, n in rows.items() if n}
    found = values_at_ranks(df, middle) if middle else {}
    # Whole numbers are added as such, so that large ones are rounded once.
    return {c: float(sum(found[c]) / 2) if c in found else None for c in rows}


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, sum, mean, min, max, exact median, population deviation.

    The built-in median keeps every distinct value of a column in one task;
    here one shuffle ranks all columns, and only counts and medians reach the driver.
    """
    cleaned = df.select([nan_to_null(F.col(c)).alias(c) for c in columns])
    counts = cleaned.agg(*[F.count(c).alias(c) for c in columns]).first()
    medians = exact_medians(cleaned, {c: counts[c] for c in columns})
    stats = []
    for c in columns:
        stats.append(F.struct(
            F.lit(c).alias("column_name"), F.count(c).alias("count"), F.sum(c).alias("sum"), F.avg(c).alias("mean"),
            F.min(c).alias("min"), F.max(c).alias("max"), F.lit(medians[c]).cast("double").alias("median"),
            F.stddev_pop(c).alias("std"),
        ).alias(c))
    return cleaned.agg(*stats).select(F.inline(F.array(*columns)))


def error_metrics(df: DataFrame, predicted: str, actual: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error, root mean square error, bias and pairs; zeros without pairs."""
    error = nan_to_null(F.col(predicted)) - nan_to_null(F.col(actual))
    return df.withColumn("__e", error).groupBy(*by).agg(
        F.coalesce(F.avg(F.abs("__e")), F.lit(0.0)).alias("mae"),
        F.coalesce(F.sqrt(F.avg(F.col("__e") * F.col("__e"))), F.lit(0.0)).alias("rmse"),
        F.coalesce(F.avg("__e"), F.lit(0.0)).alias("bias"),
        F.count("__e").alias("n"),
    )


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: correlation over the rows that have both values; NULL when either side is constant."""
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def pearson_safe(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """r, t, an approximate p and n over finite pairs; NULL under three pairs or for a constant side."""
    pairs = df.withColumns({"__x": finite(F.col(x)), "__y": finite(F.col(y))})
    both = F.col("__x").isNotNull() & F.col("__y").isNotNull()
    out = pairs.groupBy(*by).agg(F.count_if(both).alias("n"), pearson(F.col("__x"), F.col("__y")).alias("__r"))
    out = out.withColumn("r", F.when(F.col("n") >= 3, F.col("__r")))
    r, n = F.col("r"), F.col("n")
    t = F.when(F.abs(r) < 1, r * F.sqrt(F.try_divide(n - 2, 1 - r * r))).when(r.isNotNull(), 0.0)
    out = out.withColumn("t_stat", t)
    p = F.when(F.abs(r) < 1, 2 * (1 - F.least(F.lit(0.9999), F.try_divide(F.abs("t_stat"), F.sqrt(n))))).when(
        r.isNotNull(), 1.0
    )
    return out.withColumn("p_approx", p).select(*by, "r", "t_stat", "p_approx", "n")


# Up to here all pairs are expressions of one aggregate, with no Python in the plan.
FEW_COLUMNS = 24


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlations of all pairs, long form, both triangles.

    For few columns one aggregate holds the upper triangle, and mirroring happens
    on its single row; many are summed in blocks (`correlation_blocks`).
    """
    if len(columns) > FEW_COLUMNS:
        return correlation_blocks(df, columns)
    pairs = list(combinations(columns, 2))
    values = {c: nan_to_null(F.col(c)) for c in columns}
    one = df.agg(
        *[pearson(values[a], values[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
        *[pearson(values[c], values[c]).alias(f"d{i}") for i, c in enumerate(columns)],
    )

    def cell(a: str, b: str, source: str) -> Column:
        return F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(source).alias("r"))

    cells = [cell(c, c, f"d{i}") for i, c in enumerate(columns)]
    for i, (a, b) in enumerate(pairs):
        cells += [cell(a, b, f"r{i}"), cell(b, a, f"r{i}")]
    return one.select(F.inline(F.array(*cells)))


def linear_trend(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least squares line; zeros for fewer than two points."""
    xs, ys = finite(F.col(x)), finite(F.col(y))
    slope = F.coalesce(F.regr_slope(ys, xs), F.lit(0.0))
    return df.groupBy(*by).agg(
        slope.alias("slope"),
        F.coalesce(F.regr_intercept(ys, xs), F.lit(0.0)).alias("intercept"),
        (slope * 10).alias("trend_per_decade"),
    )


def log_regression(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """y on ln x with R2 and n; zeros for fewer than three rows. Rows with x <= 0 have no logarithm."""
    lx, ys = finite(F.ln(F.col(x).cast("double"))), finite(F.col(y))
    both = lx.isNotNull() & ys.isNotNull()
    out = df.groupBy(*by).agg(
        F.count_if(both).alias("__n"),
        F.regr_slope(ys, lx).alias("__slope"),
        F.regr_intercept(ys, lx).alias("__intercept"),
        F.when(F.stddev_pop(F.when(both, ys)) > 0, F.regr_r2(ys, lx)).alias("__r2"),
    )
    enough = F.col("__n") >= 3

    def kept(name: str) -> Column:
        return F.coalesce(F.when(enough, F.col(name)), F.lit(0.0))

    return out.select(
        *by, kept("__slope").alias("slope"), kept("__intercept").alias("intercept"), kept("__r2").alias("r_squared"),
        F.when(enough, F.col("__n")).otherwise(0).alias("n"),
    )


def magnitude_counts(
    df: DataFrame, magnitude: str, width: float = 0.5, start: float | None = None
) -> DataFrame:
    """Cumulative counts N(m >= bin) for every bin edge below the greatest magnitude.

    The rows are read once into bin counts; the running sum sees bins only.
    """
    m = nan_to_null(F.col(magnitude))
    idx = F.floor(m / width).cast("bigint")
    bins = df.filter(m.isNotNull()).groupBy(idx.alias("idx")).agg(F.count("*").alias("n"), F.max(m).alias("top"))
    first = F.min("idx") if start is None else F.lit(int(start // width)).cast("bigint")
    last = F.ceil(F.max("top") / width).cast("bigint") - 1
    edges = bins.agg(first.alias("lo"), last.alias("hi")).filter("hi >= lo").select(
        F.explode(F.sequence("lo", "hi")).alias("idx")
    )
    # The full join keeps the bin holding the maximum even when its edge is the excluded last one.
    joined = edges.withColumn("is_edge", F.lit(True)).join(bins, "idx", "full")
    above = Window.orderBy(F.desc("idx")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        joined.withColumn("at_least", F.sum(F.coalesce("n", F.lit(0))).over(above))
        .filter("is_edge AND at_least > 0")
        .select((F.col("idx") * width).alias("magnitude_bin"), "at_least")
    )


def b_value(df: DataFrame, magnitude: str, width: float = 0.5, start: float | None = None) -> DataFrame:
    """Slope and intercept of log10 N(m >= bin) over the bins; zeros under two bins."""
    counts = magnitude_counts(df, magnitude, width, start)
    log_n = F.log10("at_least")
    return counts.agg(
        F.coalesce(-F.regr_slope(log_n, F.col("magnitude_bin")), F.lit(0.0)).alias("b_value"),
        F.when(F.count("*") >= 2, F.regr_intercept(log_n, F.col("magnitude_bin"))).otherwise(0.0).alias("a_value"),
        F.count("*").alias("bins"),
    )


def monthly_anomalies(df: DataFrame, ts: str, col: str) -> DataFrame:
    """Per year and month: mean, the month's climatology and the difference.

    Sums and counts per year-month are enough for both means, so the rows are read once.
    """
    cells = df.filter(F.col(col).isNotNull()).groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        F.sum(col).alias("s"), F.count("*").alias("n")
    )
    over_years = Window.partitionBy("month")
    climatology = F.sum("s").over(over_years) / F.sum("n").over(over_years)
    return cells.select("year", "month", (F.col("s") / F.col("n")).alias("mean"), climatology.alias("climatology")).withColumn(
        "anomaly", F.col("mean") - F.col("climatology")
    )


def seasonal_anomaly(df: DataFrame, ts: str, col: str) -> DataFrame:
    """Mean anomaly per year with flags for the warmest and the coldest year."""
    yearly = monthly_anomalies(df, ts, col).groupBy("year").agg(F.avg("anomaly").alias("anomaly"))
    # One row per year: ranking them in one task is fine.
    warm = F.row_number().over(Window.orderBy(F.desc("anomaly"), "year"))
    cold = F.row_number().over(Window.orderBy("anomaly", "year"))
    return yearly.select("year", "anomaly", (warm == 1).alias("is_warmest"), (cold == 1).alias("is_coldest"))
