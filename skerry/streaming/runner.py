"""Running a stream over what has arrived, and batch sinks safe to replay."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.readwriter import DataStreamWriter


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the streams started inside; the session gets its own back."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def run_to_end(writer: DataStreamWriter, checkpoint: str, timeout: int | None = None) -> list[dict]:
    """Process everything available, then stop. All progress reports of the run are returned, in order.

    A stream takes as long as it needs unless the caller sets a `timeout` in seconds.
    """
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started, reports = time.monotonic(), {}
    while True:
        ended = query.awaitTermination(1)
        # The query keeps its last reports only, so they are gathered while it runs.
        reports.update({(p["batchId"], p["timestamp"]): p for p in query.recentProgress})
        if ended:
            return [dict(p) if isinstance(p, dict) else p for p in reports.values()]
        if timeout is not None and time.monotonic() - started > timeout:
            query.stop()
            raise TimeoutError(f"stream still running after {timeout} s")


def write_batch(df: DataFrame, root: str, batch_id: int, by: Sequence[str] = ()) -> None:
    """One folder per batch, overwritten when the batch is replayed, so nothing doubles; in it one per value of `by`."""
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{root}/batch_id={batch_id}")


def read_batches(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(root)


def run_rows(spark: SparkSession, task: str, reports: Sequence[dict]) -> DataFrame:
    """(task, batch_id, duration, rows) of the batches of a run, as `sla_breaches` takes them."""
    rows = [(task, r["batchId"], r["batchDuration"] / 1000, r["numInputRows"]) for r in reports if r["numInputRows"]]
    return spark.createDataFrame(rows, "task string, batch_id bigint, duration double, rows bigint")
