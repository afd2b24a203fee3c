"""Event streams: windows, bursts, repeats, enrichment and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skerry.operators.joins import enrich_lookup
from skerry.operators.ordering import first_key, row_struct
from skerry.operators.quality import Check, run_checks
from skerry.operators.rows import quality_gate
from skerry.operators.windows import burst_clusters
from skerry.sources.files import upsert_partitions
from skerry.sources.tables import KeyedTable
from skerry.streaming.runner import run_to_end, settings, write_batch
from skerry.streaming.state import ROCKSDB, FirstBurst
from skerry.workspace import path_exists


def stream_upsert(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], partition: str, order: Sequence[Column]
) -> list[dict]:
    """Idempotent load: each batch is merged by key, so a replayed batch changes nothing."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert_partitions(batch, target, keys, partition, order)

    return run_to_end(stream.writeStream.foreachBatch(handle), checkpoint)


def stream_upsert_table(stream: DataFrame, table: KeyedTable, checkpoint: str, order: Sequence[Column]) -> list[dict]:
    """Each batch is one commit of the table; a batch that was committed before is not written again.

    A run that dies before its commit leaves the table as it was.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, order, writer=checkpoint, batch=batch_id)

    return run_to_end(stream.writeStream.foreachBatch(handle), checkpoint)


def window_counts(df: DataFrame, ts: str, span: str, keys: Sequence[str], col: str) -> DataFrame:
    """Per event-time window and key: rows, present values and their sum."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    counted = timed.groupBy(F.window(ts, span), *keys).agg(
        F.count("*").alias("n"), F.count(col).alias("present"), F.sum(col).cast("double").alias("total")
    )
    return counted.select(F.col("window.start").alias("window_start"), *keys, "n", "present", "total")


SUMS = ["n", "present", "total"]


def stream_window_counts(
    stream: DataFrame, ts: str, span: str, keys: Sequence[str], col: str, target: str, checkpoint: str
) -> list[dict]:
    """Counts and means per window and key, kept as sums in a table by day; however late a row comes, it counts.

    Each row remembers the batch that changed it last and its sums before that
    batch, so a replayed batch replaces its own share and adds nothing twice.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        new = window_counts(batch, ts, span, keys, col)
        names = ["window_start", *keys]
        before = {f"old_{c}": F.lit(0).cast(new.schema[c].dataType) for c in SUMS}
        if path_exists(batch.sparkSession, target):
            stored = batch.sparkSession.read.parquet(target)
            again = F.col("batch") == batch_id
            old = stored.select(
                *[F.col(k).alias(f"__{k}") for k in names],
                *[F.when(again, F.col(f"old_{c}")).otherwise(F.col(c)).alias(f"old_{c}") for c in SUMS],
                F.col("day").alias("__day"),
            )
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in names]
            same.append(F.to_date("window_start").eqNullSafe(F.col("__day")))  # prunes the days
            new = new.join(old, same, "left").drop(*[f"__{k}" for k in names], "__day")
            before = {f"old_{c}": F.coalesce(f"old_{c}", F.lit(0).cast(new.schema[c].dataType)) for c in SUMS}
        merged = new.withColumns(before).withColumns(
            {c: F.coalesce(F.col(c), F.lit(0).cast(new.schema[c].dataType)) + F.col(f"old_{c}") for c in SUMS}
        )
        out = merged.withColumns({
            "mean": F.try_divide(F.col("total"), F.col("present")),
            "batch": F.lit(batch_id).cast("bigint"),
            "day": F.to_date("window_start"),
        })
        upsert_partitions(out, target, names, "day", [F.col("batch")])

    return run_to_end(stream.writeStream.foreachBatch(handle), checkpoint)


def stream_burst_alerts(
    stream: DataFrame, cell: Sequence[str], ts: str, root: str, checkpoint: str,
    span_seconds: int = 86_400, min_count: int = 3, parts: int = 32,
) -> list[dict]:
    """First burst per cell, kept current as events arrive.

    Alerts are kept in `parts` partitions, to be chosen for the number of cells;
    a batch rewrites those of its cells, and the number stays for the life of `root`.

    Each batch adds to an event log partitioned by span-long buckets and to
    counts per cell and bucket. Only buckets whose events, together with those
    of the next one, could hold a burst are read back, and only for the cells
    of the batch. Late events are handled like any others.
    """
    spark = stream.sparkSession
    keys = list(cell)
    at = F.col(ts).cast("timestamp")
    number = F.floor(F.unix_seconds(at) / span_seconds)
    log, counts, alerts = f"{root}/log", f"{root}/counts", f"{root}/alerts"

    def same(left: str, right: str) -> list[Column]:
        return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        events = batch.select(*keys, at.alias(ts), number.alias("bucket"))
        events.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{log}/batch_id={batch_id}")
        stored = spark.read.schema(events.schema).parquet(f"{log}/batch_id={batch_id}")
        per_bucket = stored.groupBy(*keys, "bucket").agg(F.count("*").alias("n"))
        write_batch(per_bucket, counts, batch_id)
        touched = spark.read.schema(per_bucket.schema).parquet(f"{counts}/batch_id={batch_id}").select(*keys).distinct()
        total = (
            spark.read.schema(per_bucket.schema).parquet(counts).alias("c").join(touched.alias("t"), same("c", "t"), "left_semi")
            .groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
        )
        ahead = total.withColumn("bucket", F.col("bucket") - 1)
        pairs = total.unionByName(ahead).groupBy(*keys, "bucket").agg(F.sum("n").alias("pair"))
        wanted = (
            pairs.filter(F.col("pair") >= min_count)
            .select(*keys, F.explode(F.array("bucket", F.col("bucket") + 1)).alias("bucket")).distinct()
        )
        near = same("e", "w") + [F.col("e.bucket") == F.col("w.bucket")]
        stored_log = spark.read.schema(events.schema).parquet(log)
        candidates = stored_log.alias("e").join(wanted.alias("w"), near, "left_semi")
        bursts = burst_clusters(candidates, keys, ts, span_seconds, min_count).withColumn(
            "part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
        )
        upsert_partitions(bursts.withColumn("seen", F.lit(batch_id)), alerts, keys, "part", [F.col("seen")])

    return run_to_end(stream.writeStream.foreachBatch(handle), checkpoint)


def stream_burst_state(
    stream: DataFrame, cell: Sequence[str], ts: str, alerts: KeyedTable, checkpoint: str, span_seconds: int = 86_400, min_count: int = 3
) -> list[dict]:
    """`stream_burst_alerts` from state: a batch reads and writes what its own cells remember (`FirstBurst`).

    `alerts` holds the cell, `start` and `count`; its parts change by commits. The
    number of state partitions is that of shuffle partitions when the checkpoint
    is new. Events without a time take no part.
    """
    spark = stream.sparkSession
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    timed = stream.select(*cell, at.alias("__t")).where("__t IS NOT NULL")
    fields = f"{_ddl(timed, cell)}, __start bigint, count bigint"
    found = timed.groupBy(*cell).transformWithStateInPandas(
        FirstBurst(cell, span_seconds * 1_000_000, min_count), fields, "update", "none"
    )
    current = found.select(*cell, F.timestamp_micros("__start").alias("start"), "count")

    def handle(batch: DataFrame, batch_id: int) -> None:
        if alerts.upsert(batch, [F.lit(1)], writer=checkpoint, batch=batch_id) is None:
            # Committed before, but the state of the batch is written while its rows are read.
            batch.write.format("noop").mode("overwrite").save()

    with settings(spark, ROCKSDB):
        return run_to_end(current.writeStream.outputMode("update").foreachBatch(handle), checkpoint)


def stream_dedupe(stream: DataFrame, ts: str, keys: Sequence[str], target: str, checkpoint: str) -> list[dict]:
    """First arrival per key over the whole life of the stream, whatever the event times.

    Inside one batch the earliest event counts. The state store holds the first
    row of each key and the times of the batches that brought its first and its
    last row: a batch looks up its own keys only, however many came before, and a
    key is new if both times are the batch's. A replayed batch keeps its time and
    overwrites its own folder.
    """
    arrival = F.current_timestamp()  # one time per batch
    marked = stream.withColumn("__arrival", arrival)
    first = F.min_by(row_struct(stream), F.struct("__arrival", first_key([F.col(ts)])))
    kept = marked.groupBy(*keys).agg(
        first.alias("__row"), F.min("__arrival").alias("__first"), F.max("__arrival").alias("__last")
    ).select("__row", (F.col("__first") == F.col("__last")).alias("__new"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.where("__new").select("__row.*"), target, batch_id)

    with settings(stream.sparkSession, ROCKSDB):
        return run_to_end(kept.writeStream.outputMode("update").foreachBatch(handle), checkpoint)


def _ddl(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def stream_enrich(
    stream: DataFrame, lookups: Sequence[tuple[DataFrame, str, dict[str, object]]], target: str, checkpoint: str
) -> list[dict]:
    """Reference attributes joined to events as they arrive; unknown keys keep their event."""
    enriched = enrich_lookup(stream, lookups)
    return run_to_end(enriched.writeStream.format("parquet").option("path", target), checkpoint)


def stream_checks(
    stream: DataFrame, checks: Sequence[Check], root: str, checkpoint: str, dataset: Sequence[str], col: str,
    lo: float, hi: float,
) -> list[dict]:
    """Check every batch, append the results, and route whole datasets of the batch by the gate."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read once for the checks and both routes
        try:
            write_batch(run_checks(batch, checks), f"{root}/results", batch_id)
            publish, quarantine = quality_gate(batch, dataset, col, lo, hi)
            write_batch(publish, f"{root}/published", batch_id)
            write_batch(quarantine, f"{root}/quarantined", batch_id)
        finally:
            batch.unpersist()

    return run_to_end(stream.writeStream.foreachBatch(handle), checkpoint)


def read_stream(spark: SparkSession, path: str, schema: str, per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream, optionally a few files at a time."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(path)
