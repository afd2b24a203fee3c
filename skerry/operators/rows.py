"""Row-wise projections, filters, validation and splits. None of these shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from skerry.functions import bands, measures
from skerry.functions.dates import day_text


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select([c for c in columns if c in df.columns])


def harmonize_columns(
    df: DataFrame,
    renames: Mapping[str, str],
    tags: Mapping[str, str] | None = None,
    date_from: str | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """Rename the columns that exist, derive `date` text, add constant and file tags."""
    out = df
    if file_column:
        out = out.withColumn(file_column, F.col("_metadata.file_name"))
    out = out.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    if date_from and date_from in out.columns:
        out = out.withColumn("date", day_text(F.col(date_from)))
    return out.withColumns({k: F.lit(v) for k, v in (tags or {}).items()})


def convert_units(
    df: DataFrame, col: str, source: str, target: str, out: str, digits: int = 1, unit_col: str = "unit"
) -> DataFrame:
    """Converted and rounded measure plus the unit it is now in."""
    return df.withColumns(
        {out: measures.convert_units(F.col(col), source, target, digits), unit_col: F.lit(target)}
    )


def derive_measure(df: DataFrame, formulas: Mapping[str, Column], digits: int = 1) -> DataFrame:
    """Row formulas over several columns, each rounded."""
    return df.withColumns({name: F.round(expr, digits) for name, expr in formulas.items()})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Constant per column for missing (and NaN) values."""
    return df.fillna(dict(defaults))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def classify_ladder(
    df: DataFrame, col: str, steps: Sequence[tuple[float, str]], top: str, out: str, closed: str = "upper"
) -> DataFrame:
    return df.withColumn(out, bands.ladder(F.col(col), steps, top, closed))


def exceeds_threshold(
    df: DataFrame, key: str, value: str, limits: Mapping[str, float] | DataFrame, out: str = "exceeds"
) -> DataFrame:
    """Strict comparison with the limit of the row's key; unknown keys are false.

    Limits come as a small literal map, or as a table `(key, limit)` that is joined.
    """
    if isinstance(limits, DataFrame):
        joined = df.join(limits, key, "left")
        over = measures.nan_to_null(F.col(value)) > F.col("limit")
        return joined.withColumn(out, F.coalesce(over, F.lit(False))).drop("limit")
    return df.withColumn(out, bands.exceeds(F.col(key), F.col(value), limits))


def score_steps(df: DataFrame, col: str, cuts: Sequence[float], scores: Sequence[float], out: str) -> DataFrame:
    return df.withColumn(out, bands.score_steps(F.col(col), cuts, scores))


def score_ratio(
    df: DataFrame, num: str, den: str, out: str, cuts: Sequence[float] = (1.5, 3.0), scores: Sequence[float] = (0, 50, 100)
) -> DataFrame:
    return df.withColumn(out, bands.score_ratio(F.col(num), F.col(den), cuts, scores))


def regex_gated_cast(
    df: DataFrame,
    col: str,
    pattern: str,
    lo: float,
    hi: float,
    number: str = "value_numeric",
    flag: str = "is_valid",
) -> DataFrame:
    """Number where the text matches, and a flag for match and range. Rows are kept."""
    cast = F.when(F.col(col).rlike(pattern), F.col(col).try_cast("double"))
    return df.withColumn(number, cast).withColumn(
        flag, F.coalesce(F.col(number).between(lo, hi), F.lit(False))
    )


def coerced(col: Column, kind: str) -> Column:
    if kind == "date":
        return F.try_to_date(col, "yyyy-MM-dd")
    if kind == "timestamp":
        return F.try_to_timestamp(col)
    if kind == "double":
        return measures.to_number(col)
    return col.try_cast(kind)


def coerce_types(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns; what cannot be parsed becomes NULL."""
    return df.withColumns({c: coerced(F.col(c), kind) for c, kind in spec.items() if c in df.columns})


def coercion_report(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Per column: how many present cells could not be parsed."""
    present = [c for c in spec if c in df.columns]
    counts = df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & coerced(F.col(c), spec[c]).isNull()).alias(c)
            for c in present
        ]
    )
    return counts.unpivot([], present, "column_name", "violations")


def _in_range(ranges: Mapping[str, tuple[float, float]]) -> Column:
    ok = F.lit(True)
    for name, (lo, hi) in ranges.items():
        ok = ok & measures.to_number(F.col(name)).between(lo, hi)
    return ok


def flag_valid(
    df: DataFrame, required: Sequence[str], ranges: Mapping[str, tuple[float, float]], out: str = "is_valid"
) -> DataFrame:
    """True when all required fields are present and the ranged ones are inside, bounds included."""
    absent = [c for c in required if c not in df.columns]
    ok = F.lit(not absent)
    for name in required:
        if name not in absent:
            ok = ok & F.col(name).isNotNull()
    inside = _in_range({k: v for k, v in ranges.items() if k in df.columns})
    return df.withColumn(out, F.coalesce(ok & inside, F.lit(False)))


def split_valid(
    df: DataFrame, required: Sequence[str], ranges: Mapping[str, tuple[float, float]]
) -> tuple[DataFrame, DataFrame]:
    """Valid rows and the rest; together they are the input."""
    flagged = flag_valid(df, required, ranges, "__ok")
    return flagged.filter("__ok").drop("__ok"), flagged.filter("NOT __ok").drop("__ok")


def quarantine_rows(
    df: DataFrame, rules: Mapping[str, Column], source: Column
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows as (source_file, row_data, reason).

    A rule is a condition that makes a row bad; a rule that is NULL does not
    hold, so a missing value alone never condemns a row.
    """
    original = [F.col(f"`{c}`") for c in df.columns]
    # concat_ws skips the rules that do not hold.
    reasons = F.concat_ws("; ", *[F.when(cond, F.lit(reason)) for reason, cond in rules.items()])
    marked = df.withColumn("__reason", reasons)
    good = marked.filter(F.col("__reason") == "").drop("__reason")
    bad = marked.filter(F.col("__reason") != "").select(
        source.alias("source_file"),
        F.to_json(F.struct(*original)).alias("row_data"),
        F.col("__reason").alias("reason"),
    )
    return good, bad


def numeric_fault(col: str) -> Column:
    """Text present where a number belongs."""
    return F.col(col).isNotNull() & measures.to_number(F.col(col)).isNull()


def range_fault(col: str, lo: float, hi: float) -> Column:
    number = measures.to_number(F.col(col))
    return (number < lo) | (number > hi)


def bbox_filter(df: DataFrame, lat: str, lon: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows inside (lat_min, lat_max, lon_min, lon_max), bounds included; a missing coordinate is 0."""
    lat_min, lat_max, lon_min, lon_max = box
    return df.filter(
        F.coalesce(F.col(lat), F.lit(0.0)).between(lat_min, lat_max)
        & F.coalesce(F.col(lon), F.lit(0.0)).between(lon_min, lon_max)
    )


def filter_slot(df: DataFrame, date_col: str, day: date, key_col: str | None = None, key: object = None) -> DataFrame:
    """One day's rows (and one key's). A half-open range keeps the predicate pushable."""
    kind = df.schema[date_col].dataType
    start = datetime(day.year, day.month, day.day)
    lower, upper = (F.lit(t).cast("timestamp_ntz").cast(kind) for t in (start, start + timedelta(days=1)))
    keep = (F.col(date_col) >= lower) & (F.col(date_col) < upper)
    if key_col:
        keep = keep & (F.col(key_col) == F.lit(key))
    return df.filter(keep)


def drop_null_fields(df: DataFrame, out: str = "record") -> DataFrame:
    """Each row as a JSON object without its missing fields."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(out))


def resolve_name(
    df: DataFrame, col: str, lookup: Sequence[tuple[str, str]], out: str = "resolved"
) -> DataFrame:
    """Case-insensitive lookup in a short list; unknown names take its first entry."""
    pairs: list[Column] = []
    for name, value in lookup:
        pairs += [F.lit(name.lower()), F.lit(value)]
    found = F.try_element_at(F.create_map(*pairs), F.lower(col))
    return df.withColumn(out, F.coalesce(found, F.lit(lookup[0][1])))


def gate_routes(df: DataFrame, dataset: Sequence[str], col: str, lo: float, hi: float, out: str = "route") -> DataFrame:
    """Route whole datasets: one missing or out-of-range value sends all rows of a dataset to quarantine.

    `out` is `publish` or `quarantine`. Verdicts are one row per dataset; a
    missing dataset name is a dataset of its own.
    """
    value = measures.nan_to_null(F.col(col))
    route = F.when(F.count_if(value.isNull() | ~value.between(lo, hi)) == 0, "publish").otherwise("quarantine")
    verdicts = df.groupBy(*[F.col(c).alias(f"__gate_{c}") for c in dataset]).agg(route.alias(out))
    same = [F.col(c).eqNullSafe(F.col(f"__gate_{c}")) for c in dataset]
    return df.join(verdicts, same).drop(*[f"__gate_{c}" for c in dataset])


def quality_gate(
    df: DataFrame, dataset: Sequence[str], col: str, lo: float, hi: float
) -> tuple[DataFrame, DataFrame]:
    """The rows to publish and the rows to quarantine, for callers that need two frames."""
    routed = gate_routes(df, dataset, col, lo, hi, "__route")
    return tuple(routed.filter(F.col("__route") == r).drop("__route") for r in ("publish", "quarantine"))


def filter_threshold(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """Rows strictly above a run-time threshold; text that is not a number does not pass."""
    return df.filter(measures.to_number(F.col(col)) > F.lit(threshold))


def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """`UPDATE .. SET .. WHERE`: rows not matched keep their values."""
    return df.withColumns({c: F.when(predicate, v).otherwise(F.col(c)) for c, v in assignments.items()})
