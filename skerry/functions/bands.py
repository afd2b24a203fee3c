"""Threshold ladders, bins and step scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, functions as F

from skerry.functions.measures import nan_to_null


def _chain(value: Column, steps: Sequence[tuple[float, object]], closed: str, top: object) -> Column:
    if closed not in ("upper", "lower"):
        raise ValueError("closed must be 'upper' or 'lower'")
    out = F.when(value.isNull(), F.lit(None))
    for bound, label in steps:
        inside = value <= bound if closed == "upper" else value < bound
        out = out.when(inside, F.lit(label))
    return out.otherwise(F.lit(top))


def ladder(
    value: Column, steps: Sequence[tuple[float, str]], top: str, closed: str = "upper"
) -> Column:
    """First label whose bound holds the value, `top` above the last bound.

    `closed="upper"`: a value equal to a bound belongs to that bound's label;
    `closed="lower"`: it belongs to the next one. Missing stays missing.
    """
    return _chain(nan_to_null(value), steps, closed, top)


def score_steps(
    value: Column,
    cuts: Sequence[float] = (1, 2, 4, 6),
    scores: Sequence[float] = (0, 25, 50, 75, 100),
) -> Column:
    """Step score with lower-inclusive cuts; a missing value scores 0."""
    steps = list(zip(cuts, map(float, scores)))
    return F.coalesce(_chain(nan_to_null(value), steps, "lower", float(scores[-1])), F.lit(0.0))


def score_ratio(
    num: Column,
    den: Column,
    cuts: Sequence[float] = (1.5, 3.0),
    scores: Sequence[float] = (0, 50, 100),
) -> Column:
    """Step score of a ratio; a zero or missing denominator scores 0."""
    return score_steps(F.try_divide(num.cast("double"), den.cast("double")), cuts, scores)


def band_index(value: Column, edges: Sequence[float], right: bool = True) -> Column:
    """0-based bin number for explicit edges, NULL outside them."""
    v = nan_to_null(value)
    out = None
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        inside = (v > lo) & (v <= hi) if right else (v >= lo) & (v < hi)
        out = F.when(inside, F.lit(i)) if out is None else out.when(inside, F.lit(i))
    return out


def band_label(
    value: Column, edges: Sequence[float], labels: Sequence[str], right: bool = True
) -> Column:
    """Bin label for explicit edges; `right` closes bins on the right."""
    return F.get(F.array(*[F.lit(x) for x in labels]), band_index(value, edges, right))


def exceeds(key: Column, value: Column, limits: Mapping[str, float]) -> Column:
    """Strictly above the limit of the row's key; an unknown key never exceeds."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(limits.items())])
    return F.coalesce(nan_to_null(value) > F.try_element_at(table, key), F.lit(False))


def traffic_light(passed: Column, total: Column) -> Column:
    """GREEN when all passed, YELLOW from half (rounded down), else RED."""
    half = F.floor(total / 2)
    return (
        F.when(passed == total, F.lit("GREEN")).when(passed >= half, F.lit("YELLOW")).otherwise(F.lit("RED"))
    )
