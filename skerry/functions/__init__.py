"""Column functions: each takes columns and parameters and returns a column."""

from skerry.functions.bands import (
    band_index,
    band_label,
    exceeds,
    ladder,
    score_ratio,
    score_steps,
    traffic_light,
)
from skerry.functions.dates import (
    calendar_parts,
    date_offsets,
    day_text,
    epoch_parts,
    hours_between,
    month_third,
    seconds_to_hours,
)
from skerry.functions.measures import (
    convert_units,
    nan_to_null,
    row_mean,
    safe_ratio,
    to_number,
)
from skerry.functions.nested import array_item, array_length, flatten_columns, nested_field
from skerry.functions.text import (
    code_lookup,
    count_pattern,
    expression_complexity,
    extract_part,
    hash_key,
    normalize_text,
    path_depth,
    text_length_flags,
)

__all__ = [
    "array_item", "array_length", "band_index", "band_label", "calendar_parts", "code_lookup",
    "convert_units", "count_pattern", "date_offsets", "day_text", "epoch_parts", "exceeds",
    "expression_complexity", "extract_part", "flatten_columns", "hash_key", "hours_between",
    "ladder", "month_third", "nan_to_null", "nested_field", "normalize_text", "path_depth",
    "row_mean", "safe_ratio", "score_ratio", "score_steps", "seconds_to_hours",
    "text_length_flags", "to_number", "traffic_light",
]
