"""Landed API payloads: documents, envelopes, matrices and arrays to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _array_of(record: str) -> str:
    return f"array<struct<{record}>>"


def explode_records(df: DataFrame, doc: str, envelope: str, record: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of the array under an envelope key; a document without it gives none."""
    parsed = F.from_json(doc, f"struct<`{envelope}`: {_array_of(record)}>").getField(envelope)
    return df.select(*keep, F.inline(parsed))


def envelope_pages(df: DataFrame, doc: str, record: str) -> DataFrame:
    """Pages shaped `[metadata, records]` as (page, pages, records); records may be null."""
    parts = F.from_json(doc, "array<string>")
    meta = F.from_json(F.get(parts, F.lit(0)), "struct<page: int, pages: int>")
    records = F.from_json(F.get(parts, F.lit(1)), _array_of(record))
    return df.select(meta.getField("page").alias("page"), meta.getField("pages").alias("pages"), records.alias("records"))


def page_records(pages: DataFrame) -> DataFrame:
    """Records of all pages up to the end of the set: the first page without records, or the last one announced."""
    ended = F.when(F.col("records").isNull(), F.col("page")).when(F.col("page") >= F.col("pages"), F.col("page") + 1)
    stop = pages.agg(F.min(ended)).scalar()
    kept = pages.withColumn("__stop", stop).filter(F.col("__stop").isNull() | (F.col("page") < F.col("__stop")))
    return kept.select(F.inline("records"))


def page_completeness(pages: DataFrame) -> DataFrame:
    """Pages landed against pages announced."""
    return pages.agg(
        F.count_distinct("page").alias("landed"), F.coalesce(F.max("pages"), F.lit(0)).alias("announced")
    ).withColumn("complete", F.col("landed") == F.col("announced"))


def rows_with_headers(
    df: DataFrame, doc: str, names: Sequence[str], numeric: Mapping[str, str] | None = None
) -> DataFrame:
    """`headers[].name` + `rows[][]` to named string columns; listed ones are coerced.

    Positions come from the document itself, so its column order may vary.
    """
    parsed = df.select(F.from_json(doc, "struct<headers: array<struct<name: string>>, rows: array<array<string>>>").alias("d"))
    cells = parsed.select(F.col("d.headers.name").alias("names"), F.explode("d.rows").alias("row"))
    kinds = numeric or {}

    def cell(name: str) -> Column:
        at = F.array_position(F.col("names"), name).cast("int")
        value = F.get(F.col("row"), at - 1)
        return (value.try_cast(kinds[name]) if name in kinds else value).alias(name)

    return cells.select([cell(n) for n in names])


def parallel_arrays_to_rows(df: DataFrame, container: str, fields: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """`{time: [..], a: [..]}` to one row per index; shorter or missing arrays give NULL."""
    arrays = [
        F.coalesce(F.col(f"{container}.{name}"), F.array().cast(f"array<{kind}>")).alias(name)
        for name, kind in fields.items()
    ]
    zipped = df.select(*keep, *arrays)
    return zipped.select(*keep, F.inline(F.arrays_zip(*fields)))


def split_records(df: DataFrame, col: str, record_sep: str, field_sep: str, fields: Mapping[str, str]) -> DataFrame:
    """Delimited text to rows and named, typed fields; what cannot be cast is NULL."""
    others = [c for c in df.columns if c != col]
    records = df.select(*others, F.explode(F.split(col, f"\\Q{record_sep}\\E")).alias("__record"))
    parts = F.split("__record", f"\\Q{field_sep}\\E")
    return records.select(
        *others, *[F.get(parts, F.lit(i)).try_cast(kind).alias(n) for i, (n, kind) in enumerate(fields.items())]
    )


def flatten_intensity(df: DataFrame, doc: str) -> DataFrame:
    """Slot documents with a nested intensity object; an absent object leaves NULLs."""
    schema = "struct<`from`: string, `to`: string, intensity: struct<forecast: double, actual: double, index: string>>"
    parsed = df.select(F.from_json(doc, schema).alias("d"))
    return parsed.select("d.from", "d.to", "d.intensity.forecast", "d.intensity.actual", "d.intensity.index")


def explode_mix(df: DataFrame, keep: Sequence[str], mix: str) -> DataFrame:
    """One row per array element; an empty or missing array gives none."""
    return df.select(*keep, F.inline(mix))


def flatten_features(df: DataFrame, doc: str, properties: str) -> DataFrame:
    """GeoJSON features to lon, lat, depth and properties.

    The depth is 0 without a third coordinate; a missing geometry gives zeros.
    """
    geometry = "struct<type: string, coordinates: array<double>>"
    parsed = df.select(F.from_json(doc, f"struct<geometry: {geometry}, properties: struct<{properties}>>").alias("f"))

    def coordinate(i: int, name: str) -> Column:
        return F.coalesce(F.get("f.geometry.coordinates", F.lit(i)), F.lit(0.0)).alias(name)

    return parsed.select(coordinate(0, "lon"), coordinate(1, "lat"), coordinate(2, "depth"), "f.properties.*")


def bridge_table(df: DataFrame, key: str, map_col: str) -> DataFrame:
    """Map column to link rows (key, code, and the fields of a struct value or `name`)."""
    links = df.select(key, F.explode(map_col).alias("code", "value"))
    value = links.schema["value"].dataType
    if hasattr(value, "fields"):
        return links.select(key, "code", "value.*")
    return links.select(key, "code", F.col("value").alias("name"))
