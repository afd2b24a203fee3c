"""Text column functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def text_length_flags(text: Column, code: Column) -> dict[str, Column]:
    """Character length (0 when missing) and whether a code is present."""
    return {
        "name_length": F.coalesce(F.char_length(text), F.lit(0)),
        "has_code": code.isNotNull(),
    }


def count_pattern(text: Column, pattern: str) -> Column:
    """Number of matches; missing text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))


def expression_complexity(columns: Sequence[Column], operand: str = r"#\{[^}]+\}") -> Column:
    """Operands plus arithmetic signs over all expressions of a row."""
    parts = [count_pattern(c, operand) + count_pattern(c, "[+*-]") for c in columns]
    return sum(parts[1:], parts[0])


def path_depth(path: Column) -> Column:
    """Slashes minus one, 0 when the path is missing."""
    return F.coalesce(F.char_length(path) - F.char_length(F.replace(path, F.lit("/"), F.lit(""))) - 1, F.lit(0))


def normalize_text(text: Column) -> dict[str, Column]:
    return {
        "upper_text": F.upper(text),
        "lower_text": F.lower(text),
        "trimmed_text": F.trim(text),
        "text_length": F.char_length(text),
    }


def extract_part(text: Column, pattern: str, group: int = 1) -> Column:
    """One regex group, NULL when the text does not match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def hash_key(code: Column, buckets: int = 100_000) -> Column:
    """Surrogate key: first 8 hex digits of the md5 as a number, modulo `buckets`."""
    return F.conv(F.substring(F.md5(code.cast("binary")), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def code_lookup(code: Column, table: Mapping[str, Mapping[str, str]], default: Mapping[str, str]) -> dict[str, Column]:
    """Static attributes of a type code, with a default for unknown codes."""
    out = {}
    for attribute, fallback in default.items():
        pairs = []
        for key, attributes in table.items():
            pairs += [F.lit(key), F.lit(attributes[attribute])]
        out[attribute] = F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(fallback))
    return out
