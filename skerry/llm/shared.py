"""Small helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from skerry.workspace import scratch

# Rows turned into Python objects at a time inside one Arrow batch, so that a
# batch of very long texts never exists twice in a worker.
SLICE_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identifier and text, nothing else; a NULL text is the empty text."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )


def map_texts(
    docs: DataFrame, make: Callable[[], Callable[[list], list[tuple]]], schema: str, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """One output row per row, from the column `text` in Arrow batches.

    `make` is called once per task and gives a function from a list of texts to
    a list of value tuples. The columns `keep` come first in the output.
    """
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                rows = work(part.column("text").to_pylist())
                columns = [part.column(c) for c in keep] + [pa.array(v, t) for v, t in zip(zip(*rows), types.types)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *types.names])

    return docs.select(*keep, "text").mapInArrow(run, f"{fields}, {schema}")


def map_slices(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """Rows of `df` changed or filtered a few at a time; `make` is called once per task, the columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield work(batch.slice(start, SLICE_ROWS))

    return df.mapInArrow(run, df.schema)


def with_values(part: pa.RecordBatch, name: str, values: list) -> pa.RecordBatch:
    """`part` with other values in one of its columns."""
    at = part.schema.get_field_index(name)
    return part.set_column(at, part.schema.field(at), pa.array(values, part.schema.field(at).type))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: the lineage is cut and the files outlive executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
