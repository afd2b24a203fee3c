"""Declarative data quality checks.

A check is data: aggregates to compute and a rule that turns their values into
`(passed, details, severity)`. `run_checks` puts the aggregates of all checks
of a table into one pass over it and unfolds the single result row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skerry.functions.measures import nan_to_null, to_number
from skerry.operators import joins, rows, windows

Verdict = tuple[Column, Column, Column]


@dataclass(frozen=True)
class Check:
    """Named aggregates and the rule over their values."""

    name: str
    aggregates: Sequence[Column]
    verdict: Callable[..., Verdict]


def text(template: str, *values: Column) -> Column:
    """Formatted text; a template without values is a constant."""
    return F.format_string(template, *values) if values else F.lit(template)


def outcome(passed: Column, good: Column, bad: Column, severity: str) -> Verdict:
    """Details and severity by verdict; a passed check is informational."""
    return passed, F.when(passed, good).otherwise(bad), F.when(passed, "info").otherwise(severity)


def fixed(name: str, passed: bool, details: str, severity: str) -> Check:
    """A verdict known from the schema alone."""
    return Check(name, [], lambda: (F.lit(passed), F.lit(details), F.lit(severity)))


def run_checks(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """All checks in one aggregate; one row per check (and group)."""
    names = [[f"c{i}_{j}" for j in range(len(c.aggregates))] for i, c in enumerate(checks)]
    measured = [a.alias(n) for c, ns in zip(checks, names) for a, n in zip(c.aggregates, ns)]
    one = df.groupBy(*by).agg(F.count("*").alias("__rows"), *measured)
    results = []
    for check, ns in zip(checks, names):
        passed, details, severity = check.verdict(*[F.col(n) for n in ns])
        results.append(F.struct(
            F.lit(check.name).alias("check_name"), passed.alias("passed"), details.alias("details"),
            severity.alias("severity"),
        ))
    return one.select(*by, F.inline(F.array(*results)))


def schema_check(df: DataFrame, expected: Sequence[str]) -> Check:
    missing = sorted(set(expected) - set(df.columns))
    extra = sorted(set(df.columns) - set(expected))
    if missing:
        return fixed("schema_columns", False, f"missing {missing}, extra {extra}", "critical")
    if extra:
        return fixed("schema_columns", True, f"all required columns present, extra {extra}", "warning")
    return fixed("schema_columns", True, f"all {len(expected)} columns present", "info")


def types_check(df: DataFrame, spec: Mapping[str, str]) -> Check:
    """Cells that cannot be read as their declared type; an absent column is a violation."""
    absent = [c for c in spec if c not in df.columns]
    present = [c for c in spec if c in df.columns]
    typed = {c: rows.coerced(F.col(c), spec[c]) for c in present}
    bad = [F.count_if(F.col(c).isNotNull() & typed[c].isNull()) for c in present]

    def verdict(*counts: Column) -> Verdict:
        parts = [F.lit(f"{c}: column missing") for c in absent]
        parts += [F.when(n > 0, text(f"{c}: %d not {spec[c]}", n)) for c, n in zip(present, counts)]
        found = F.array_compact(F.array(*parts))
        return outcome(F.size(found) == 0, F.lit("all types match"), F.array_join(found, "; "), "critical")

    return Check("column_types", bad, verdict)


def bounds_check(df: DataFrame, col: str, lo: float, hi: float) -> Check:
    """Values outside the inclusive range; missing and non-numeric cells are not violations."""
    name = f"bounds_{col}"
    if col not in df.columns:
        return fixed(name, False, f"column {col} not found", "critical")
    value = to_number(F.col(col)) if dict(df.dtypes)[col] == "string" else nan_to_null(F.col(col))
    return Check(name, [F.count_if((value < lo) | (value > hi))], lambda n: outcome(
        n == 0, text(f"all values within [{lo}, {hi}]"), text(f"%d values outside [{lo}, {hi}]", n), "warning"
    ))


def _is_missing(df: DataFrame, col: str) -> Column:
    missing = F.col(col).isNull()
    return missing | F.isnan(col) if dict(df.dtypes)[col] in ("double", "float") else missing


def nulls_check(df: DataFrame, columns: Sequence[str], max_pct: float) -> Check:
    """Share of missing cells strictly above the limit fails; an empty table passes."""
    present = [c for c in columns if c in df.columns]
    absent = [c for c in columns if c not in df.columns]
    counts = [F.count_if(_is_missing(df, c)) for c in present]

    def verdict(total: Column, *missing: Column) -> Verdict:
        parts = [F.lit(f"{c}: column missing") for c in absent]
        for c, n in zip(present, missing):
            pct = F.coalesce(F.try_divide(n * 100.0, total), F.lit(0.0))
            parts.append(F.when(pct > max_pct, text(f"{c}: %.1f%% null (max {max_pct}%%)", pct)))
        found = F.array_compact(F.array(*parts)) if parts else F.array().cast("array<string>")
        passed = (total == 0) | (F.size(found) == 0)
        good = F.when(total == 0, "empty table, nothing to check").otherwise(
            f"all {len(columns)} columns within {max_pct}% null"
        )
        return outcome(passed, good, F.array_join(found, "; "), "warning")

    return Check("null_check", [F.count("*"), *counts], verdict)


def row_count_check(lo: int, hi: int) -> Check:
    """Too few rows is critical, too many a warning."""

    def verdict(n: Column) -> Verdict:
        passed = n.between(lo, hi)
        details = (
            F.when(n < lo, text(f"only %d rows (minimum {lo})", n))
            .when(n > hi, text(f"%d rows (maximum {hi})", n))
            .otherwise(text(f"%d rows within [{lo}, {hi}]", n))
        )
        return passed, details, F.when(n < lo, "critical").when(n > hi, "warning").otherwise("info")

    return Check("row_count", [F.count("*")], verdict)


def zscore_check(col: str, stats: Column, k: float = 3.0) -> Check:
    """Values beyond k sample deviations; a constant column has none. `stats` comes from `windows.moments`."""
    mean, std = stats.getField(f"{col}_mean"), stats.getField(f"{col}_std")
    score = F.try_divide(F.abs(nan_to_null(F.col(col)) - mean), std)
    return Check(f"zscore_{col}", [F.count_if(score > k)], lambda n: outcome(
        n == 0, text(f"no value beyond {k} deviations"), text(f"%d values beyond {k} deviations", n), "warning"
    ))


def distribution_check(col: str, first: Column, k: float = 1.5) -> Check:
    """Mean shift between the halves of a table beyond k deviations of the first half."""

    def verdict(half: Column) -> Verdict:
        diff, limit = half.getField("mean_diff"), half.getField("threshold")
        details = text("means %.2f and %.2f, shift %.2f, threshold %.2f", half.getField("first_mean"),
                       half.getField("second_mean"), diff, limit)
        return outcome(half.getField("stable"), details, details, "critical")

    return Check(f"distribution_shift_{col}", [windows.half_struct(first, col, k)], verdict)


def check_schema(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    return run_checks(df, [schema_check(df, expected)])


def check_types(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    return run_checks(df, [types_check(df, spec)])


def check_bounds(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    return run_checks(df, [bounds_check(df, col, lo, hi)])


def check_nulls(df: DataFrame, columns: Sequence[str], max_pct: float) -> DataFrame:
    return run_checks(df, [nulls_check(df, columns, max_pct)])


def check_row_count(df: DataFrame, lo: int, hi: int) -> DataFrame:
    return run_checks(df, [row_count_check(lo, hi)])


def check_zscore(df: DataFrame, columns: Sequence[str], k: float = 3.0) -> DataFrame:
    """All columns share one statistics row and one counting pass."""
    stats = windows.moments(df, columns)
    return run_checks(df, [zscore_check(c, stats, k) for c in columns])


def check_distribution(df: DataFrame, order: str, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    marked = df.withColumn("__first", windows.first_half(df, order))
    return run_checks(marked, [distribution_check(c, F.col("__first"), k) for c in columns])


def check_date_coverage(df: DataFrame, day: str, by: Sequence[str] = ()) -> DataFrame:
    """Calendar gaps as a check per group; an absent date column is critical."""
    if day not in df.columns:
        return run_checks(df, [fixed("date_coverage", False, f"column {day} not found", "critical")], by)
    gaps = joins.missing_dates(df, day, by)
    passed = F.col("missing_days") == 0
    good = text("all %d days present", F.col("expected_days"))
    bad = text("%d of %d days missing, first %s", F.col("missing_days"), F.col("expected_days"), F.col("first_missing"))
    ok, details, severity = outcome(passed, good, bad, "warning")
    verdicts = gaps.select(
        *by, F.lit("date_coverage").alias("check_name"), ok.alias("passed"), details.alias("details"),
        severity.alias("severity"),
    )
    if by:
        return verdicts
    # Without a single date there is no calendar to compare with, and that is a finding too.
    nothing = df.agg(F.count(day).alias("n")).filter("n = 0").select(
        F.lit("date_coverage").alias("check_name"), F.lit(False).alias("passed"), F.lit("no dates at all").alias("details"),
        F.lit("critical").alias("severity"),
    )
    return verdicts.filter("passed IS NOT NULL").unionByName(nothing)


def check_reference(detail: DataFrame, master: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct detail keys known to the master over all of them."""
    from skerry.operators.sets import key_difference_summary

    counts = key_difference_summary(detail.dropna(subset=list(keys)), master, keys)
    passed, details, severity = outcome(
        F.col("missing") == 0, text("%d of %d keys matched", F.col("matched"), F.col("total")),
        text("%d of %d keys matched", F.col("matched"), F.col("total")), "warning",
    )
    return counts.select(
        F.lit("referential_integrity").alias("check_name"), passed.alias("passed"), details.alias("details"),
        severity.alias("severity"),
    )


def check_not_null_unique(df: DataFrame, key: str) -> DataFrame:
    """Rows without a key, and keys that occur more than once, from one grouping."""
    counts = df.groupBy(key).agg(F.count("*").alias("__n"))
    missing = F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("__n"))), F.lit(0))
    repeated = F.count_if(F.col(key).isNotNull() & (F.col("__n") > 1))

    def rule(what: str) -> Callable[[Column], Verdict]:
        return lambda n: outcome(n == 0, F.lit("0 failing"), text(f"%d {what}", n), "critical")

    return run_checks(counts, [
        Check(f"not_null_{key}", [missing], rule("rows without a key")),
        Check(f"unique_{key}", [repeated], rule("repeated keys")),
    ])


def check_records(df: DataFrame, max_null_pct: float, min_rows: int) -> DataFrame:
    """Row minimum and share of missing cells over all columns, in one row."""
    cells = F.count("*") * len(df.columns)
    missing = sum((F.count_if(_is_missing(df, c)) for c in df.columns), F.lit(0))
    return df.agg(F.count("*").alias("row_count"), F.coalesce(F.try_divide(missing * 100.0, cells), F.lit(0.0)).alias("__pct")).select(
        "row_count",
        (F.col("row_count") >= min_rows).alias("row_check_passed"),
        F.round("__pct", 2).alias("null_pct"),
        (F.col("__pct") <= max_null_pct).alias("null_check_passed"),
        ((F.col("row_count") >= min_rows) & (F.col("__pct") <= max_null_pct)).alias("all_passed"),
    )


def check_nonempty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: does it have a row? Each test stops at the first one."""
    tests = [
        df.limit(1).agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), (F.col("n") > 0).alias("passed")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, tests)


def require_nonempty(tables: Mapping[str, DataFrame]) -> None:
    """Stop the job when an upstream table has no rows."""
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"empty upstream tables: {', '.join(empty)}")


def check_freshness(listing: DataFrame, expected: DataFrame, now: Column) -> DataFrame:
    """Expected `(path, max_age_s)` against a file listing; missing is critical, old a warning."""
    age = (F.unix_micros(now) - F.unix_micros("modified")) / 1_000_000
    joined = expected.join(listing.select("path", "modified"), "path", "left").withColumn("age_s", age)
    late = F.col("age_s") > F.col("max_age_s")
    missing = F.col("modified").isNull()
    return joined.select(
        "path",
        F.lit("freshness").alias("check_name"),
        (~missing & ~F.coalesce(late, F.lit(False))).alias("passed"),
        F.when(missing, F.lit("file not found"))
        .when(late, text("%.0f s old (max %.0f s)", F.col("age_s"), F.col("max_age_s").cast("double")))
        .otherwise(text("%.0f s old", F.col("age_s"))).alias("details"),
        F.when(missing, "critical").when(late, "warning").otherwise("info").alias("severity"),
    )


def check_files(listing: DataFrame, expected: DataFrame, now: Column) -> DataFrame:
    """Expected `(path, max_age_s, min_size)`: exists, fresh and large enough, per path."""
    joined = expected.join(listing.select("path", "size", "modified"), "path", "left")
    age = (F.unix_micros(now) - F.unix_micros("modified")) / 1_000_000
    return joined.select(
        "path",
        F.col("modified").isNotNull().alias("present"),
        F.coalesce(age <= F.col("max_age_s"), F.lit(False)).alias("fresh"),
        F.coalesce(F.col("size") >= F.col("min_size"), F.lit(False)).alias("size_ok"),
    )


def health(files: DataFrame) -> DataFrame:
    """Issue count over the file flags and the status it means."""
    flags = ["present", "fresh", "size_ok"]
    issues = sum((F.count_if(~F.col(f)) for f in flags), F.lit(0))
    return files.agg(issues.alias("issues"), (F.count("*") * len(flags)).alias("checks")).withColumn(
        "status", F.when(F.col("issues") == 0, "HEALTHY").when(F.col("issues") <= 2, "DEGRADED").otherwise("CRITICAL")
    )


def sla_breaches(runs: DataFrame, task: str, duration: str, limits: DataFrame, default: float = 999.0) -> DataFrame:
    """Runs with their limit `(task, limit_s)` and OK or BREACH; unknown tasks get the default limit."""
    joined = runs.join(limits, task, "left").withColumn("limit_s", F.coalesce("limit_s", F.lit(default)))
    return joined.withColumn("status", F.when(F.col(duration) <= F.col("limit_s"), "OK").otherwise("BREACH"))


def score_report(checks: DataFrame, category: str) -> DataFrame:
    """Totals per category and overall (category NULL): counts, score and verdict."""
    bad = ~F.coalesce(F.col("passed"), F.lit(False))  # a check without a verdict has not passed
    failed = F.count_if(bad)
    return checks.rollup(category).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        failed.alias("failed"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
        F.count_if((F.col("severity") == "critical") & bad).alias("critical"),
        F.round(F.count_if(F.col("passed")) * 100.0 / F.count("*"), 1).alias("score_pct"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("overall"),
    )


def report_lines(checks: DataFrame) -> DataFrame:
    """The checks as text: a header, two lines per check in severity order, the verdict."""
    from skerry.operators.ranking import severity_rank

    failed = ~F.coalesce(F.col("passed"), F.lit(False))
    totals = checks.agg(
        F.count("*").alias("n"), F.count_if(F.col("passed")).alias("ok"), F.count_if(failed).alias("bad"),
        F.count_if(F.col("severity") == "warning").alias("warn"),
        F.count_if((F.col("severity") == "critical") & failed).alias("crit"),
    )

    def line(section: int, body: Column, rank: Column, name: Column, part: int) -> Column:
        return F.struct(
            F.lit(section).alias("section"), rank.alias("rank"), name.alias("name"), F.lit(part).alias("part"),
            body.alias("line"),
        )

    none, zero = F.lit(""), F.lit(0)
    head = totals.select(F.inline(F.array(
        line(0, text("Total checks: %d", F.col("n")), zero, none, 0),
        line(0, text("Passed: %d  |  Failed: %d", F.col("ok"), F.col("bad")), zero, none, 1),
        line(0, text("Warnings: %d  |  Critical: %d", F.col("warn"), F.col("crit")), zero, none, 2),
        line(2, F.concat(F.lit("Overall: "), F.when(F.col("bad") == 0, "PASS").otherwise("FAIL")), zero, none, 0),
    )))
    mark = F.when(F.col("passed"), "PASS").otherwise("FAIL")
    rank, name = severity_rank(F.col("severity")), F.col("check_name")
    body = checks.select(F.inline(F.array(
        line(1, text("[%s] [%s] %s", mark, F.upper("severity"), name), rank, name, 0),
        line(1, F.concat(F.lit("    "), "details"), rank, name, 1),
    )))
    return head.unionByName(body).orderBy("section", "rank", "name", "part").select("section", "name", "part", "line")


# Suggestion by the kind of check that failed.
ADVICE = {
    "bounds": "review out-of-range values",
    "zscore": "investigate outlier values",
    "distribution": "look for a change of the data source",
    "null": "complete the missing values",
    "row_count": "check the delivery of the source",
    "referential": "add the missing master rows or remove the orphans",
}


def recommend(checks: DataFrame) -> DataFrame:
    """A suggestion for every failed check, by the kind its name tells."""
    advice = F.lit("inspect the check")
    for kind, suggestion in ADVICE.items():
        advice = F.when(F.contains(F.col("check_name"), F.lit(kind)), suggestion).otherwise(advice)
    return checks.filter(~F.coalesce(F.col("passed"), F.lit(False))).select("check_name", "severity", advice.alias("suggestion"))
