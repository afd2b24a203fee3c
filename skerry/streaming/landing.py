"""Files arriving in a landing folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skerry.functions.nested import flatten_columns
from skerry.operators.rows import quarantine_rows
from skerry.sources.delimited import csv_by_header
from skerry.sources.files import EMPTY
from skerry.streaming.runner import read_batches, run_to_end, write_batch
from skerry.workspace import child_names, hadoop_path, make_dirs, path_exists


def stream_new_files(
    spark: SparkSession, landing: str, schema: str, fmt: str, target: str, checkpoint: str,
    options: Mapping[str, str] | None = None,
) -> list[dict]:
    """Append only files not seen before to a cumulative dataset, tagged with their file.

    The checkpoint is the manifest of processed files; the file sink commits
    each batch once, also after a restart.
    """
    stream = (
        spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(landing)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )
    return run_to_end(stream.writeStream.format("parquet").option("path", target), checkpoint)


def file_counts(df: DataFrame) -> DataFrame:
    """Rows per source file: the manifest's figures, counted."""
    return df.groupBy("source_file").agg(F.count("*").alias("rows"))


def text_lines(spark: SparkSession, landing: str, glob: str = "*.csv") -> DataFrame:
    """Stream of text lines with their file, its time and their block; a carriage return stays with its line."""
    return spark.readStream.options(pathGlobFilter=glob, lineSep="\n").text(landing).select(
        "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def _manifest(lines: DataFrame, unusable: DataFrame, fate: str) -> DataFrame:
    """(source_file, modified, status, reason) of the files of a batch: `used`, or `fate` with a reason."""
    seen = lines.groupBy("source_file").agg(F.max("modified").alias("modified"))
    status = F.when(F.col("reason").isNull(), "used").otherwise(fate).alias("status")
    return seen.join(unusable, "source_file", "left").select("source_file", "modified", status, "reason")


MANIFEST = "source_file string, modified timestamp, status string, reason string"


def stream_landing_zone(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    columns: Sequence[str],
    required: Sequence[str],
    transform: Callable[[DataFrame], DataFrame],
    archive: str | None = None,
) -> list[dict]:
    """CSV files to transformed rows (`rows`), unusable files to warnings (`skipped`), each file to `files`.

    Rows whose transformation keeps `source_file` are written file by file, to a
    folder `source=<name>` each. Once their batch has committed, the last one
    included, originals move to `archive`, their time of moving before their name.
    A path is taken once: a later file of the same name is not read.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read once for rows and warnings
        try:
            table, skipped = csv_by_header(batch, columns, required)
            rows = transform(table)
            if "source_file" in rows.columns:
                rows = rows.withColumn("source", F.element_at(F.split("source_file", "/"), -1))
            write_batch(rows, f"{target}/rows", batch_id, ["source"] if "source_file" in rows.columns else [])
            write_batch(skipped, f"{target}/skipped", batch_id)
            write_batch(_manifest(batch, skipped, "skipped"), f"{target}/files", batch_id)
        finally:
            batch.unpersist()

    reports = run_to_end(text_lines(spark, landing).writeStream.foreachBatch(handle), checkpoint)
    if archive:
        move_listed(spark, target, "used", archive)
    return reports


def stream_json_events(
    spark: SparkSession, landing: str, schema: T.StructType, target: str, checkpoint: str, multiline: bool = True
) -> list[dict]:
    """JSON event files flattened into one columnar dataset."""
    stream = spark.readStream.schema(schema).option("multiLine", multiline).json(landing)
    flat = stream.select(flatten_columns(schema))
    return run_to_end(flat.writeStream.format("parquet").option("path", target), checkpoint)


def stream_quarantine(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    columns: Sequence[str],
    required: Sequence[str],
    rules: Mapping[str, Column],
    aside: str | None = None,
    glob: str = "*.csv",
) -> list[dict]:
    """Clean rows, rejected rows with a reason, and files that could not be used (`dead_letters`), from one rule set.

    A file is unusable as a whole, and gives no rows at all, if it is empty, is
    not UTF-8 text in all its bytes, lacks a required column, never closes a
    quoted cell or ends within a record. Once their batch has committed such
    files move to `aside`, beside a text that says why.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Lines are read once for the checks, the records and the manifest, and parsed once for both outputs.
        batch = batch.persist()
        table, unusable = csv_by_header(batch, columns, required, strict=True)
        table = table.persist()
        try:
            good, bad = quarantine_rows(table, rules, F.col("source_file"))
            write_batch(good, f"{target}/clean", batch_id)
            write_batch(bad, f"{target}/rejected", batch_id)
            write_batch(_manifest(batch, unusable, "dead"), f"{target}/files", batch_id)
            listed = spark.read.schema(MANIFEST).parquet(f"{target}/files/batch_id={batch_id}")
            write_batch(listed.where("status = 'dead'").select("source_file", "modified", "reason"), f"{target}/dead_letters", batch_id)
        finally:
            table.unpersist()
            batch.unpersist()

    reports = run_to_end(text_lines(spark, landing, glob).writeStream.foreachBatch(handle), checkpoint)
    _record_empty(spark, f"{landing.rstrip('/')}/{glob}", target)
    if aside:
        move_listed(spark, target, "dead", aside)
    return reports


# Files without bytes are in no batch of the stream: Spark lists none.
NO_BATCH = -1


def _record_empty(spark: SparkSession, pattern: str, target: str) -> None:
    """Dead letters of files of zero bytes, once for each file and time of change."""
    found = empty_matches(spark, pattern)
    if not found:
        return
    listed = spark.createDataFrame(found, "source_file string, milliseconds long").select(
        "source_file", F.timestamp_millis("milliseconds").alias("modified"), F.lit("dead").alias("status"), F.lit(EMPTY).alias("reason")
    )
    listed.write.mode("overwrite").parquet(f"{target}/files/batch_id={NO_BATCH}")
    fresh = listed.select("source_file", "modified", "reason")
    if path_exists(spark, f"{target}/dead_letters"):
        letters = read_batches(spark, f"{target}/dead_letters", "source_file string, modified timestamp, reason string")
        fresh = fresh.join(letters.where(F.col("batch_id") == NO_BATCH), ["source_file", "modified"], "left_anti")
    fresh.write.mode("append").parquet(f"{target}/dead_letters/batch_id={NO_BATCH}")


def empty_matches(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Path and time of change (milliseconds) of files of zero bytes that match a glob pattern.

    The folder is listed once on the driver, as Spark lists the others.
    """
    fs, target = hadoop_path(spark, pattern)
    listed = fs.globStatus(target) or []
    return [(s.getPath().toString(), s.getModificationTime()) for s in listed if s.isFile() and s.getLen() == 0]


def move_listed(spark: SparkSession, target: str, status: str, folder: str) -> int:
    """Move files of a status, of all batches not moved yet, to `folder`/`<time>_<name>`; how many were moved.

    To be called when the stream has ended, so that no batch reads them again. A
    run that was cut short is caught up by the next: what is gone from its place
    was moved before. A reason goes into a text beside the file.
    """
    batches = child_names(spark, f"{target}/files", "batch_id=")
    done = child_names(spark, f"{target}/moved-{status}", "batch_id=") - {f"batch_id={NO_BATCH}"}
    if not batches - done:
        return 0
    make_dirs(spark, folder)
    stamp, moved = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S"), 0
    for name in sorted(batches - done):
        listed = spark.read.schema(MANIFEST).parquet(f"{target}/files/{name}").where(F.col("status") == status)
        with ThreadPoolExecutor(8) as pool:  # renames wait for the file system, not for this machine
            moved += sum(pool.map(lambda r: move_file(spark, r["source_file"], folder, stamp, r["reason"]), listed.toLocalIterator()))
        make_dirs(spark, f"{target}/moved-{status}/{name}")
    return moved


def move_file(spark: SparkSession, path: str, folder: str, stamp: str, reason: str | None = None) -> bool:
    """Move one file, its stamp before its name; False if it is not there any more. Names taken get a number."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(path) if "%" in path else jvm.org.apache.hadoop.fs.Path(path).toUri())
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return False
    number, name = 0, f"{stamp}_{at.getName()}"
    while True:
        goal = jvm.org.apache.hadoop.fs.Path(folder, name if not number else f"{stamp}_{number}_{at.getName()}")
        if not fs.exists(goal) and fs.rename(at, goal):
            break
        number += 1
        if number > 10_000:
            raise OSError(f"cannot move {path} to {folder}")
    if reason:
        out = fs.create(jvm.org.apache.hadoop.fs.Path(goal.getParent(), f"{goal.getName()}.reason"))
        out.write(bytearray(f"file: {at.getName()}\ntimestamp: {stamp}\nreason: {reason}\n".encode()))
        out.close()
    return True
