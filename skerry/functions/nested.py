"""Functions over arrays, structs and JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def array_length(values: Column) -> Column:
    """Element count, 0 when the array is missing."""
    return F.greatest(F.coalesce(F.size(values), F.lit(0)), F.lit(0))


def array_item(values: Column, index: int, default: object = None) -> Column:
    """0-based element, `default` when the array is too short or missing."""
    item = F.get(values, F.lit(index))
    return item if default is None else F.coalesce(item, F.lit(default))


def nested_field(document: Column, path: str, kind: str = "string", default: object = None) -> Column:
    """Field of a JSON document, `default` when it is not an object or lacks it."""
    found = F.try_variant_get(F.try_parse_json(document), path, kind)
    return found if default is None else F.coalesce(found, F.lit(default))


def flatten_columns(schema: T.StructType, sep: str = "_") -> list[Column]:
    """One column per struct leaf, named `parent<sep>child`. Walks the schema only."""

    def walk(fields: T.StructType, path: list[str]) -> list[Column]:
        leaves: list[Column] = []
        for field in fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                leaves += walk(field.dataType, here)
            else:
                leaves.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))
        return leaves

    return walk(schema, [])
