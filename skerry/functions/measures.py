"""Numeric column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed values: (multiplier, divisor, offset). A negative offset is applied before scaling.
UNIT_CONVERSIONS = {
    ("C", "F"): (9.0, 5.0, 32.0),
    ("F", "C"): (5.0, 9.0, -32.0),
}


def nan_to_null(value: Column) -> Column:
    """NaN counts as missing everywhere in this library."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL.

    The cast alone would also accept a Java type suffix such as `12d`. The
    text is referred to once, so an expensive expression is computed once.
    """
    marked = F.regexp_replace(text.cast("string"), r"(?<=[0-9.])[dDfF]\s*$", "x")
    return nan_to_null(marked.try_cast("double"))


def convert_units(value: Column, source: str, target: str, digits: int = 1) -> Column:
    """Linear unit conversion rounded to `digits`; equal units only round."""
    if source == target:
        return F.round(value, digits)
    up, down, offset = UNIT_CONVERSIONS[(source, target)]
    shifted = value + offset if offset < 0 else value
    scaled = shifted * up / down
    return F.round(scaled + offset if offset > 0 else scaled, digits)


def safe_ratio(num: Column, den: Column, digits: int = 1, default: float = 0.0) -> Column:
    """Rounded ratio, `default` unless the denominator is positive."""
    return F.when(den > 0, F.round(F.try_divide(num, den), digits)).otherwise(F.lit(default))


def row_mean(columns: Sequence[Column], digits: int | None = None) -> Column:
    """Mean across columns of one row, ignoring missing values."""
    cleaned = [nan_to_null(c) for c in columns]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cleaned), F.lit(0.0))
    present = sum((c.isNotNull().cast("int") for c in cleaned), F.lit(0))
    mean = F.try_divide(total, present)
    return mean if digits is None else F.round(mean, digits)
