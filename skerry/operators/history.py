"""Type 2 history that takes deliveries in any order.

A history row holds one key and its spells: the attributes as delivered, and the
dates of all deliveries that stated them. Ranges are read off the dates, so a late
delivery splits the range it falls into, an early one extends the first, and a
repeated one changes nothing. The table of a key never holds more dates than the
calendar has, whatever the number of deliveries.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from skerry.operators.warehouse import OPEN_END
from skerry.sources.tables import KeyedTable


def history_schema(key: str, attributes: str) -> str:
    """Schema of history rows for a key (`name type`) and attributes (`name type, ...`)."""
    row = ", ".join(f"{name}: {kind}" for name, kind in (a.strip().split(" ", 1) for a in attributes.split(",")))
    return f"{key}, spells array<struct<first: date, row: struct<{row}>, dates: array<date>>>"


def observed(history: DataFrame, key: str) -> DataFrame:
    """(key, on, row): what each delivery stated."""
    spells = history.select(key, F.explode("spells").alias("s"))
    return spells.select(key, F.explode("s.dates").alias("on"), F.col("s.row").alias("row"))


def spells_of(observations: DataFrame, key: str) -> DataFrame:
    """History rows from observations; of several rows of one key and date the greatest counts, in any order."""
    single = observations.groupBy(key, "on").agg(F.max("row").alias("row"))
    by_date = Window.partitionBy(key).orderBy("on")
    changed = F.coalesce(~F.col("row").eqNullSafe(F.lag("row").over(by_date)), F.lit(True)) | (F.row_number().over(by_date) == 1)
    numbered = single.withColumn("changed", changed.cast("int")).withColumn("spell", F.sum("changed").over(by_date))
    spell = F.struct(F.min("on").alias("first"), F.first("row").alias("row"), F.sort_array(F.collect_list("on")).alias("dates"))
    return numbered.groupBy(key, "spell").agg(spell.alias("s")).groupBy(key).agg(F.sort_array(F.collect_list("s")).alias("spells"))


def splice(history: DataFrame, delivery: DataFrame, key: str, on: Column) -> DataFrame:
    """History rows of the delivered keys, with the delivery's rows at the date `on`."""
    known = history.join(delivery.select(key).distinct(), key, "left_semi")
    attributes = history.schema["spells"].dataType.elementType["row"].dataType.names
    stated = delivery.select(key, on.cast("date").alias("on"), F.struct(*[F.col(f"`{a}`") for a in attributes]).alias("row"))
    # Field types of the history, so that a delivery of narrower numbers is no change.
    kind = history.schema["spells"].dataType.elementType["row"].dataType
    return spells_of(observed(known, key).unionByName(stated.withColumn("row", F.col("row").cast(kind))), key).select(history.columns)


def load_delivery(table: KeyedTable, delivery: DataFrame, on: date, full: bool) -> int | None:
    """Commit a delivery with its date; a `full` one also says that all other keys are gone by then.

    Rows without a key are left out. Only parts that hold delivered keys are
    rewritten; a full delivery closes the others by its date alone, which is
    committed with the rows.
    """
    (key,) = table.keys
    rows = delivery.where(F.col(key).isNotNull())
    full_dates = sorted(set(snapshots(table)) | ({on} if full else set()))
    notes = {"full": [d.isoformat() for d in full_dates]}

    # A key's rows are stated as they come and spliced against its own part.
    def make(current: DataFrame, stated: DataFrame) -> DataFrame:
        merged = observed(current.join(stated.select(key), key, "left_semi"), key).unionByName(observed(stated, key))
        return spells_of(merged, key).select(current.columns)

    alone = splice(table.spark.createDataFrame([], table.schema), rows, key, F.lit(on))
    return table.change(alone, make, notes=notes)


def snapshots(table: KeyedTable) -> list[date]:
    """Dates of the full deliveries so far."""
    return [date.fromisoformat(d) for d in table.state()["notes"].get("full", [])]


def versions(history: DataFrame, key: str, tracked: Sequence[str], full: Sequence[date]) -> DataFrame:
    """key, attributes, valid_from, valid_to (exclusive), is_current: ranges of equal tracked attributes.

    Other attributes are those of the range's last delivery. A key that a full
    delivery does not hold is closed at its date; missing values equal each other.
    """
    stated = observed(history, key)
    attributes = stated.schema["row"].dataType.names
    by_date = Window.partitionBy(key).orderBy("on")
    dates = F.array(*[F.lit(d) for d in full]).cast("array<date>")
    absent = F.array_min(F.filter(dates, lambda d: d > F.col("on")))
    ends = F.col("absent").isNotNull() & (F.col("next").isNull() | (F.col("absent") < F.col("next")))
    core = F.struct(*[F.col(f"row.`{c}`") for c in tracked])
    placed = stated.withColumns({"absent": absent, "next": F.lead("on").over(by_date), "core": core}).withColumn("ends", ends)
    starts = (
        F.lag("core").over(by_date).isNull() | ~F.col("core").eqNullSafe(F.lag("core").over(by_date)) | F.lag("ends").over(by_date)
    )
    numbered = placed.withColumn("starts", starts.cast("int")).withColumn("version", F.sum("starts").over(by_date))
    until = F.when(F.col("ends"), F.col("absent")).otherwise(F.coalesce("next", F.lit(OPEN_END).cast("date")))
    ranged = numbered.groupBy(key, "version").agg(
        F.max_by("row", "on").alias("row"), F.min("on").alias("valid_from"), F.max_by(until, "on").alias("valid_to")
    )
    return ranged.select(
        key, *[F.col(f"row.`{a}`").alias(a) for a in attributes], "valid_from", "valid_to",
        (F.col("valid_to") == F.lit(OPEN_END).cast("date")).alias("is_current"),
    )
