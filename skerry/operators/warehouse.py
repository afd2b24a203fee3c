"""Dimensional modelling: staging, dimensions, facts, history and layers."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from skerry.functions.measures import row_mean, safe_ratio
from skerry.operators import joins, quality
from skerry.operators.aggregates import latest_wide
from skerry.operators.ranking import sort_nulls_last
from skerry.operators.windows import minmax_scale, sequence_keys

OPEN_END = "9999-12-31"


def stage(df: DataFrame, columns: Mapping[str, tuple[str, str]], required: Sequence[str]) -> DataFrame:
    """Typed and renamed columns `{out: (source, type)}`; rows lacking a required one are dropped."""
    return df.select(
        [F.col(source).try_cast(kind).alias(out) for out, (source, kind) in columns.items()]
    ).dropna(subset=list(required))


def build_dimension(
    df: DataFrame, order: Sequence[Column], key: str, num: str | None = None, den: str | None = None,
    density: str = "density", digits: int = 1, slice_by: Column | None = None,
) -> DataFrame:
    """Dense surrogate keys in the declared order, and a derived density; `slice_by` as for `sequence_keys`."""
    keyed = sequence_keys(df, order, key, slice_by)
    return keyed if num is None else keyed.withColumn(density, safe_ratio(F.col(num), F.col(den), digits))


def build_time_dimension(df: DataFrame, ts: str) -> DataFrame:
    """A row per year between the first and the last one; the key follows from the year."""
    span = df.agg(F.min(F.year(ts)).alias("lo"), F.max(F.year(ts)).alias("hi"))
    years = span.select("lo", F.explode(F.sequence("lo", "hi")).alias("year"))
    return years.select(
        (F.col("year") - F.col("lo") + 1).alias("time_key"),
        "year",
        (F.floor(F.col("year") / 10) * 10).cast("int").alias("decade"),
        (F.col("year") >= 2000).alias("is_21st_century"),
    )


def build_fact(
    facts: DataFrame,
    dims: Sequence[tuple[DataFrame, str, str]],
    optional: Sequence[tuple[DataFrame, str, str, int]],
    value: str,
) -> DataFrame:
    """Natural keys replaced by surrogate keys.

    `dims` are `(dimension, natural key, surrogate key)`: rows unknown to one of
    them, or without a value, are dropped. `optional` adds a key for unknowns.
    """
    out = facts.dropna(subset=[value])
    keys = []
    for dim, natural, surrogate in dims:
        out = out.join(dim.select(natural, surrogate), natural)
        keys.append(surrogate)
    for dim, natural, surrogate, unknown in optional:
        out = out.join(dim.select(natural, surrogate), natural, "left").fillna({surrogate: unknown})
        keys.append(surrogate)
    return out.select(*keys, value)


def mart_summary(
    dim: DataFrame, fact: DataFrame, key: str, keep: Column, order: Sequence[Column], measure: str
) -> DataFrame:
    """Selected dimension rows with their latest fact, best first, unknown last."""
    return sort_nulls_last(joins.join_latest(dim.filter(keep), fact, [key], order), measure, [key])


def composite_index(
    fact: DataFrame, entity: str, item: str, value: str, order: Sequence[Column], items: Sequence[str], digits: int = 1
) -> DataFrame:
    """Mean of the 0..100 scaled latest value of each item, best first.

    The fact shrinks to one row per entity before anything is ranked.
    """
    wide = latest_wide(fact, [entity], item, value, items, order)
    scaled = minmax_scale(wide, items)
    composite = row_mean([F.col(f"{i}_norm") for i in items], digits)
    return scaled.select(entity, composite.alias("composite_score")).orderBy(F.desc("composite_score"), entity)


def scd2_merge(
    current: DataFrame, previous: DataFrame, key: str, tracked: Sequence[str], start: str, change: str
) -> DataFrame:
    """Versions of two snapshots paired by business key.

    Unchanged rows stay open from `start`; a changed one is closed at `change`
    and reopened; new keys open at `change`; vanished keys close there. Two
    missing values count as equal.
    """
    columns = current.columns
    attributes = [c for c in columns if c != key]
    cur = current.select(F.col(key), F.struct(*attributes).alias("__cur"))
    old = previous.select(F.col(key), F.struct(*attributes).alias("__old"))
    both = F.col("__cur").isNotNull() & F.col("__old").isNotNull()
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"__cur.{c}").eqNullSafe(F.col(f"__old.{c}"))

    def version(row: str, valid_from: str, valid_to: str, open_: bool) -> Column:
        return F.struct(
            F.col(row).alias("row"), F.lit(valid_from).cast("date").alias("valid_from"),
            F.lit(valid_to).cast("date").alias("valid_to"), F.lit(open_).alias("is_current"),
        )

    kept = version("__cur", start, OPEN_END, True)
    closed = version("__old", start, change, False)
    opened = version("__cur", change, OPEN_END, True)
    versions = (
        F.when(both & same, F.array(kept))
        .when(both, F.array(closed, opened))
        .when(F.col("__old").isNull(), F.array(opened))
        .otherwise(F.array(closed))
    )
    history = cur.join(old, key, "full").select(key, F.inline(versions))
    ordered = [F.col(key) if c == key else F.col(f"row.{c}").alias(c) for c in columns]
    return history.select(*ordered, "valid_from", "valid_to", "is_current")


def validate_scd(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Checks: current rows exist, no orphan fact keys, ordered ranges, one current row per key."""
    current = F.col("is_current")
    per_key = dim.groupBy(key).agg(
        F.count_if(current).alias("open"), F.count_if(F.col("valid_from") > F.col("valid_to")).alias("bad")
    )
    orphans = joins.find_orphans(fact, dim, key).agg(F.count("*").alias("n")).scalar()

    def rule(good: str, bad: str) -> object:
        return lambda n: quality.outcome(n == 0, quality.text(good), quality.text(bad, n), "critical")

    return quality.run_checks(per_key, [
        quality.Check("scd_has_current", [F.coalesce(F.sum("open"), F.lit(0))], lambda n: quality.outcome(
            n > 0, quality.text("%d current rows", n), F.lit("no current rows"), "critical")),
        quality.Check("no_orphan_keys", [F.coalesce(F.max(orphans), orphans)], rule("all fact keys present", "%d fact keys unknown")),
        quality.Check("date_range_validity", [F.coalesce(F.sum("bad"), F.lit(0))], rule("all ranges valid", "%d invalid ranges")),
        quality.Check("one_current_per_key", [F.count_if(F.col("open") > 1)], rule("at most one each", "%d keys with several")),
    ])


def audit_trail(stages: Mapping[str, DataFrame], changes: DataFrame, schema_version: str) -> DataFrame:
    """One row: rows per stage, closed versions, schema version and time."""
    spark = changes.sparkSession
    counts = [df.agg(F.count("*")).scalar().alias(f"{name}_rows") for name, df in stages.items()]
    closed = changes.agg(F.count_if(~F.col("is_current"))).scalar().alias("scd_changes")
    return spark.range(1).select(
        *counts, closed, F.lit(schema_version).alias("schema_version"), F.current_timestamp().alias("recorded_at")
    )


class ObservedStages:
    """Rows and durations of stages, counted by the stages' own actions.

    `watch` attaches the counts to a DataFrame, `stage` times the action that runs
    it. Nothing is read a second time; asking for the counts of a watched DataFrame
    that no action has run waits for one.
    """

    def __init__(self, spark: SparkSession, schema_version: str) -> None:
        self.spark, self.schema_version = spark, schema_version
        self.seen: dict[str, Observation] = {}
        self.times: dict[str, float] = {}

    def watch(self, name: str, df: DataFrame, **extra: Column) -> DataFrame:
        """`df` with its rows counted as `<name>_rows`, and other aggregates under their own names."""
        self.seen[name] = Observation()
        return df.observe(
            self.seen[name], F.count(F.lit(1)).alias(f"{name}_rows"), *[column.alias(label) for label, column in extra.items()]
        )

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        start = time.monotonic()
        yield
        self.times[name] = time.monotonic() - start

    def counts(self) -> dict[str, int]:
        return {label: value for seen in self.seen.values() for label, value in seen.get.items()}

    def trail(self) -> DataFrame:
        """One row: the counts, schema version and time."""
        values = [F.lit(v).cast("bigint").alias(label) for label, v in self.counts().items()]
        return self.spark.range(1).select(
            *values, F.lit(self.schema_version).alias("schema_version"), F.current_timestamp().alias("recorded_at")
        )

    def runs(self) -> DataFrame:
        """(task, duration, rows) of the timed stages, as `sla_breaches` takes them."""
        rows = [(name, took, self.seen[name].get[f"{name}_rows"] if name in self.seen else None) for name, took in self.times.items()]
        return self.spark.createDataFrame(rows, "task string, duration double, rows bigint")


def medallion(
    raw: DataFrame, doc: str, root: str, schema: str, silver: Mapping[str, Column], required: Sequence[str],
    group: str, gold: Sequence[Column],
) -> DataFrame:
    """Raw documents kept as text, cleaned Parquet, aggregated Parquet; each layer reads the one before."""
    spark = raw.sparkSession
    raw.select(F.col(doc).alias("value")).write.mode("overwrite").text(f"{root}/bronze")
    parsed = spark.read.text(f"{root}/bronze").select(F.from_json("value", schema).alias("d")).select("d.*")
    cleaned = parsed.select([expr.alias(name) for name, expr in silver.items()]).dropna(subset=list(required))
    cleaned.write.mode("overwrite").parquet(f"{root}/silver")
    staged = spark.read.schema(cleaned.schema).parquet(f"{root}/silver")
    staged.groupBy(group).agg(*gold).write.mode("overwrite").parquet(f"{root}/gold")
    return spark.read.parquet(f"{root}/gold")


def layered_integration(
    base: tuple[str, DataFrame], sources: Sequence[tuple[str, DataFrame, str, Mapping[str, object]]], root: str
) -> DataFrame:
    """Every source staged as Parquet, then joined to the base with its defaults."""
    name, df = base
    spark = df.sparkSession

    def staged(label: str, frame: DataFrame) -> DataFrame:
        frame.write.mode("overwrite").parquet(f"{root}/{label}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{label}")

    lookups = [(staged(label, frame), key, defaults) for label, frame, key, defaults in sources]
    return joins.enrich_lookup(staged(name, df), lookups)
