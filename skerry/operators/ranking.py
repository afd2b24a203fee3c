"""Sorting, limits and preference picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skerry.operators.ordering import first_rows

# Report order of check severities.
SEVERITIES = {"critical": 0, "warning": 1, "info": 2}


def sort_nulls_last(df: DataFrame, col: str, ties: Sequence[str] = ()) -> DataFrame:
    """Descending, missing values at the end."""
    return df.orderBy(F.col(col).desc_nulls_last(), *ties)


def top_k(df: DataFrame, measure: str, k: int, ties: Sequence[str], largest: bool = True) -> DataFrame:
    """The k largest, or the k smallest non-zero rows; ties in the declared order."""
    if largest:
        return df.orderBy(F.col(measure).desc_nulls_last(), *ties).limit(k)
    return df.filter(F.col(measure) != 0).orderBy(F.col(measure).asc_nulls_last(), *ties).limit(k)


def first_match(
    df: DataFrame, term: str, preferred: Column, order: Sequence[Column], why: tuple[str, str]
) -> DataFrame:
    """Per term the first preferred candidate, else the first one, with the reason."""
    ranked = df.withColumn("__other", ~F.coalesce(preferred, F.lit(False)))
    best = first_rows(ranked, [term], [F.col("__other"), *order])
    reason = F.when(F.col("__other"), why[1]).otherwise(why[0])
    return best.withColumn("reason", reason).drop("__other")


def severity_rank(severity: Column) -> Column:
    """Position in the report order; unknown severities come last."""
    rank = F.lit(len(SEVERITIES))
    for name, place in SEVERITIES.items():
        rank = F.when(severity == name, F.lit(place)).otherwise(rank)
    return rank


def order_by_severity(checks: DataFrame) -> DataFrame:
    return checks.orderBy(severity_rank(F.col("severity")), "check_name")


def multi_rank(df: DataFrame, name: str, measures: Sequence[tuple[str, bool]]) -> DataFrame:
    """Long rank table (measure, rank, name); `(column, ascending)` per measure, missing last.

    For grouped tables: each measure ranks all names in one window.
    """
    # Negating turns descending into ascending, so one window serves all measures.
    signed = df.select(name, *[(F.col(c) if up else -F.col(c)).cast("double").alias(c) for c, up in measures])
    long = signed.unpivot([name], [c for c, _ in measures], "measure", "__v")
    order = Window.partitionBy("measure").orderBy(F.col("__v").asc_nulls_last(), name)
    return long.withColumn("rank", F.row_number().over(order)).drop("__v")
