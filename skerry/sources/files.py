"""Scans, listings and sinks on any Hadoop file system."""

from __future__ import annotations

import codecs
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from skerry.operators.ordering import latest_rows
from skerry.sources import payloads
from skerry.sources.delimited import csv_by_header  # noqa: F401
from skerry.workspace import hadoop_path, path_exists


def scan_csv(spark: SparkSession, path: str, schema: str, corrupt: str = "_corrupt") -> DataFrame:
    """CSV with a header; ragged or unreadable lines stay, with their text in `corrupt`."""
    return (
        spark.read.schema(f"{schema}, {corrupt} string")
        .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
        .csv(path)
    )


def scan_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Small files that each hold one JSON array, a task each; `json_arrays.scan_json_arrays` splits large ones."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str], schema: str | None = None) -> DataFrame:
    """Only the listed columns reach the reader."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).select(*columns)


def profile(df: DataFrame) -> DataFrame:
    """Per column: rows and missing cells, from one pass."""
    counts = [
        F.struct(F.lit(c).alias("column_name"), F.count("*").alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls")).alias(f"s{i}")
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*counts).select(F.inline(F.array(*[f"s{i}" for i in range(len(counts))])))


def scan_envelope_pages(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Landed pages `[metadata, records]`, one file each, read in parallel."""
    return payloads.envelope_pages(spark.read.text(path, wholetext=True), "value", record)


def discover_files(spark: SparkSession, root: str, suffixes: Sequence[str]) -> DataFrame:
    """Recursive listing: path, name, first folder under the root, format, size and time. Contents are not read."""
    return _listing(spark, root, suffixes).drop("uri")


def _listing(spark: SparkSession, root: str, suffixes: Sequence[str]) -> DataFrame:
    """`discover_files` with `uri`, the path as the rows of other scans state it."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{{{','.join(suffixes)}}}").option("recursiveFileLookup", True)
        .load(root).select("path", "length", "modificationTime", F.col("_metadata.file_path").alias("uri"))
    )
    return _described(listed, root)


def _described(listed: DataFrame, root: str) -> DataFrame:
    bare = root.split(":", 1)[-1].rstrip("/")
    inside = F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:/*", "/"), f"^\\Q/{bare.lstrip('/')}\\E/", "")
    parts = F.split(inside, "/")
    return listed.select(
        "path",
        F.element_at(parts, -1).alias("name"),
        F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).alias("folder"),
        F.element_at(F.split("path", "[.]"), -1).alias("format"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
        "uri",
    )


LENIENT = ["csv", "json", "parquet"]


def scan_lenient(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All CSV, JSON and Parquet files under a root, with `source_path`.

    A line that does not fit the schema stays as a row with its text in
    `corrupt`. A file that cannot be read to its end gives no rows, not even
    those before the fault, and is named by `skipped_files`.
    """
    def reader(fmt: str) -> DataFrame:
        own = schema if fmt == "parquet" else f"{schema}, corrupt string"
        rows = (
            spark.read.schema(own).option("pathGlobFilter", f"*.{fmt}").option("recursiveFileLookup", True)
            .option("ignoreCorruptFiles", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt")
            .option("header", True).format(fmt).load(root).select("*", F.col("_metadata.file_path").alias("source_path"))
        )
        return rows.withColumn("corrupt", F.lit(None).cast("string")) if fmt == "parquet" else rows

    faulty = _faulty(spark, root).select(F.col("uri").alias("source_path"))
    return reader("csv").unionByName(reader("json")).unionByName(reader("parquet")).join(faulty, "source_path", "left_anti")


# Bytes read at a time from files that are looked through.
READ_BYTES = 4 << 20


def read_fault(path: str, size: int) -> str | None:
    """Why a file cannot be read, from all its bytes; None for a readable one, however few rows it has."""
    if size == 0:
        return EMPTY
    system, name = pafs.FileSystem.from_uri(quote(path, safe=":/%"))
    with system.open_input_file(name) as source:
        return _parquet_fault(source) if path.endswith(".parquet") else _text_fault(source)


def _parquet_fault(source: pa.NativeFile) -> str | None:
    try:
        table = pq.ParquetFile(source, page_checksum_verification=True)
    except (pa.ArrowException, OSError) as fault:
        return f"unreadable footer: {str(fault).splitlines()[0][:80]}"
    try:
        for _ in table.iter_batches():
            pass
    except (pa.ArrowException, OSError) as fault:
        return f"unreadable data: {str(fault).splitlines()[0][:80]}"
    return None


def _text_fault(source: pa.NativeFile) -> str | None:
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        while chunk := source.read(READ_BYTES):
            if b"\0" in chunk:
                return "not a text file"
            decoder.decode(chunk)
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return "not UTF-8 text"
    return None


EMPTY = "empty file"


def skipped_files(spark: SparkSession, root: str) -> DataFrame:
    """The files under the root that cannot be read, with a `reason`, files of zero bytes included.

    Each file is read to its end by one task: text for bytes that are none,
    Parquet row group by row group.
    """
    return _faulty(spark, root).drop("uri")


def _faulty(spark: SparkSession, root: str) -> DataFrame:
    listing = _listing(spark, root, LENIENT)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, sizes = batch.column("path").to_pylist(), batch.column("size").to_pylist()
            reasons = pa.array([read_fault(p, s) for p, s in zip(paths, sizes)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, reasons], names=[*batch.schema.names, "reason"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in listing.schema)
    probed = listing.repartition("path").mapInArrow(probe, f"{fields}, reason string").filter("reason IS NOT NULL")
    found = empty_files(spark, root, LENIENT)
    if not found:
        return probed
    rows = spark.createDataFrame(found, "path string, milliseconds long").select(
        "path", F.lit(0).cast("long").alias("length"), F.timestamp_millis("milliseconds").alias("modificationTime"), F.col("path").alias("uri")
    )
    return probed.unionByName(_described(rows, root).withColumn("reason", F.lit(EMPTY)))


def empty_files(spark: SparkSession, root: str, suffixes: Sequence[str]) -> list[tuple[str, int]]:
    """Path and time of change (milliseconds) of files of zero bytes under a folder; Spark's scans list none.

    The file system is listed on the driver, as Spark does for the others.
    """
    fs, target = hadoop_path(spark, root)
    if not fs.exists(target):
        return []
    listed, found = fs.listFiles(target, True), []
    while listed.hasNext():
        status = listed.next()
        if status.getLen() == 0 and (path := status.getPath().toString()).endswith(tuple(f".{s}" for s in suffixes)):
            found.append((path, status.getModificationTime()))
    return found


def load_table(df: DataFrame, table: str, mode: str = "replace", path: str | None = None) -> None:
    """Write a named table stamped with `loaded_at`: replace it, refill it or append to it."""
    stamped = df.withColumn("loaded_at", F.current_timestamp())
    spark = df.sparkSession
    if mode == "refill" and spark.catalog.tableExists(table):
        stamped.write.insertInto(table, overwrite=True)
        return
    writer = stamped.write.mode("append" if mode == "append" else "overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_dataset(df: DataFrame, path: str, fmt: str) -> dict[str, int]:
    """Write csv, json or parquet (anything else means csv); rows and columns written."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode("overwrite")
    if fmt in ("parquet", "json"):
        writer.format(fmt).save(path)
    else:
        writer.option("header", True).csv(path)
    return {"rows": seen.get["rows"], "columns": len(df.columns)}


def append_dataset(df: DataFrame, path: str) -> None:
    """Add rows to a cumulative dataset; what is there is not rewritten."""
    df.write.mode("append").parquet(path)


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of the target not updated, and the latest update per key. Repeating it changes nothing."""
    return merge_latest(target, latest_rows(updates, keys, order), keys)


def merge_latest(target: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Missing key values are equal to each other, so that repeating an update cannot double their rows."""
    renamed = latest.select(*[F.col(k).alias(f"__new_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__new_{k}")) for k in keys]
    return target.join(renamed, same, "left_anti").unionByName(latest)


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions the rows belong to. The rebalance hint splits a hot partition's writers."""
    (
        df.hint("rebalance", F.col(partition)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )


def upsert_partitions(
    updates: DataFrame, path: str, keys: Sequence[str], partition: str, order: Sequence[Column]
) -> None:
    """`merge_upsert` into a partitioned dataset, rewriting the touched partitions only.

    A key must always fall into the same partition. The old rows are joined to
    the touched partition values, which prunes the read at run time.
    """
    spark = updates.sparkSession
    # Used for the partition list, the anti join and the output: computed once.
    latest = latest_rows(updates, keys, order).persist()
    try:
        merged = latest
        if path_exists(spark, path):
            touched = latest.select(F.col(partition).alias("__touched")).distinct()
            stored = spark.read.schema(updates.schema).parquet(path)
            current = stored.join(touched, F.col(partition).eqNullSafe(F.col("__touched")), "left_semi")
            merged = merge_latest(current, latest, keys)
        overwrite_partitions(merged, path, partition)
    finally:
        latest.unpersist()


def backfill_slots(df: DataFrame, path: str, slot: str) -> None:
    """Rewrite the slots present in `df` and no others."""
    overwrite_partitions(df, path, slot)


def features(df: DataFrame, lon: str, lat: str, properties: Sequence[str], depth: str | None = None) -> DataFrame:
    """One GeoJSON Feature per row; rows without both coordinates are dropped."""
    coordinates = [F.col(lon), F.col(lat)] + ([F.col(depth)] if depth else [])
    geometry = F.struct(F.lit("Point").alias("type"), F.array(*coordinates).alias("coordinates"))
    feature = F.struct(
        F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")
    )
    return df.dropna(subset=[lon, lat]).select(F.to_json(feature).alias("value"))


def geometry_features(df: DataFrame, geometry: str, properties: Sequence[str]) -> DataFrame:
    """One GeoJSON Feature per row around a geometry given as JSON text of any type; rows without one are dropped."""
    shape = F.try_parse_json(F.col(geometry))
    feature = F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*properties).alias("properties"))
    return df.filter(shape.isNotNull()).select(F.to_json(feature).alias("value"))


def write_features(df: DataFrame, path: str, lon: str, lat: str, properties: Sequence[str], depth: str | None = None) -> None:
    """Features as text, one to a line, so the output splits and never sits in one task."""
    features(df, lon, lat, properties, depth).write.mode("overwrite").text(path)


def geometry_counts(df: DataFrame, doc: str) -> DataFrame:
    kind = F.coalesce(F.get_json_object(doc, "$.geometry.type"), F.lit("unknown"))
    return df.groupBy(kind.alias("geometry_type")).agg(F.count("*").alias("count"))


def object_store_roundtrip(df: DataFrame, uri: str) -> DataFrame:
    """Write Parquet to a URI, list it, read it back and compare the counts."""
    written = write_dataset(df, uri, "parquet")
    spark = df.sparkSession
    back = spark.read.parquet(uri)
    files = discover_files(spark, uri, ["parquet"]).agg(F.count("*")).scalar()
    return back.agg(F.count("*").alias("rows_read")).select(
        F.lit(written["rows"]).cast("bigint").alias("rows_written"),
        "rows_read",
        F.lit(written["columns"]).alias("columns_written"),
        F.lit(len(back.columns)).alias("columns_read"),
        (files > 0).alias("listed"),
        (F.col("rows_read") == written["rows"]).alias("verified"),
    )


def fields_to_rows(df: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """Records to `(field, value)` rows, values as text."""
    fields = [c for c in df.columns if c not in ids]
    as_text = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in fields])
    return as_text.unpivot(list(ids), fields, "field", "value")


def file_tagged(df: DataFrame, out: str = "source_file") -> DataFrame:
    """Name of the file a scanned row came from."""
    return df.withColumn(out, F.col("_metadata.file_name"))

