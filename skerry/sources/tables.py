"""Parquet tables of keyed rows that change by whole commits.

New files are written first; one small commit file, created exclusively, then
names the folders that make up the table. Until it is there readers see the
former commit, whose files stay until `vacuum`. A commit that was begun and not
finished is not valid JSON and counts as none.

Rows are dealt to parts by the leading bits of their key's hash. A change rewrites
only the parts its keys fall into, and a part that has outgrown `part_rows` is
written as several by more bits, so parts grow in number and not in size.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skerry.operators.ordering import latest_rows
from skerry.sources.files import merge_latest
from skerry.workspace import child_names, delete_path, hadoop_path, make_dirs

PART, DEPTH = "__part", "__depth"
# Names of parts up to this number are a broadcast side of a few megabytes.
BROADCAST_PARTS = 100_000


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since this one read the table."""


def part_name(hashed: Column, depth: Column) -> Column:
    """`<bits>-<leading bits of the hash>`."""
    lead = F.when(depth == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", hashed, (F.lit(64) - depth).cast("int")))
    return F.concat_ws("-", depth.cast("string"), lead.cast("string"))


def children(name: str, depth: int) -> list[str]:
    """The parts of `depth` bits that make up a part."""
    bits, lead = map(int, name.split("-"))
    more = depth - bits
    return [f"{depth}-{(lead << more) + i}" for i in range(1 << more)]


@dataclass(frozen=True)
class KeyedTable:
    """Rows of `schema`; `keys` decide the part, and a key's rows are replaced together."""

    spark: SparkSession
    root: str
    schema: str
    keys: tuple[str, ...]
    part_rows: int = 2_000_000

    def versions(self) -> list[int]:
        """Numbers of the finished commits."""
        return [n for n in self._numbers() if self._commit(n) is not None]

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in child_names(self.spark, f"{self.root}/commits", "") if n.endswith(".json"))

    def _commit(self, number: int) -> dict | None:
        fs, path = hadoop_path(self.spark, f"{self.root}/commits/{number:010d}.json")
        source = fs.open(path)
        try:
            text = bytes(source.readAllBytes()).decode()
        finally:
            source.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def state(self, version: int | None = None) -> dict:
        """Parts with their folder and rows, the last batch of each writer, and notes; of the latest commit or a stated one."""
        for number in reversed(self._numbers()):
            if version in (None, number) and (found := self._commit(number)) is not None:
                return found | {"version": number}
        if version is not None:
            raise ValueError(f"no version {version}")
        return {"version": 0, "parts": {}, "done": {}, "notes": {}}

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.state(version)["parts"])

    def _rows(self, parts: Mapping[str, Sequence]) -> DataFrame:
        paths = [f"{self.root}/data/{folder}/{PART}={name}" for name, (folder, _) in parts.items() if folder]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _placed(self, rows: DataFrame, depths: Mapping[str, int]) -> DataFrame:
        """`rows` with the part their key falls into, and the depth at which it is to be written."""
        hashed = F.xxhash64(*[F.col(f"`{k}`") for k in self.keys])
        names = self.spark.createDataFrame(list(depths.items()), f"{PART} string, {DEPTH} int")
        found = sorted({int(n.split("-")[0]) for n in depths})
        candidates = F.array(*[part_name(hashed, F.lit(d)) for d in found])
        return rows.withColumn(PART, F.explode(candidates)).join(F.broadcast(names) if len(depths) <= BROADCAST_PARTS else names, PART)

    def change(
        self, updates: DataFrame, make: Callable[[DataFrame, DataFrame], DataFrame], writer: str | None = None, batch: int | None = None,
        notes: Mapping[str, object] | None = None,
    ) -> int | None:
        """Replace the rows of keys: `make(current, updates)` gives the new rows of some keys of `updates`.

        `current` holds the rows of the parts that the updates fall into. A
        writer's batch that is committed already changes nothing and gives None.
        """
        state = self.state()
        if writer is not None and batch is not None and state["done"].get(writer, -1) >= batch:
            return None
        updates = updates.persist()  # counted, joined and written; lost blocks are computed again
        try:
            parts = state["parts"] or {"0-0": [None, 0]}
            counts = self._placed(updates, dict.fromkeys(parts, 0)).groupBy(PART).count().collect()
            touched = {r[PART]: parts[r[PART]] for r in counts}
            depths = {r[PART]: self._depth(r[PART], parts[r[PART]][1] + r["count"]) for r in counts}
            current = self._rows(touched)
            merged = merge_latest(current, make(current, updates), list(self.keys))
            written = self._write(merged, depths) if depths else {}
        finally:
            updates.unpersist()
        fresh = {child: written.get(child, [None, 0]) for name, depth in depths.items() for child in children(name, depth)}
        kept = {name: part for name, part in parts.items() if name not in touched}
        done = state["done"] | ({writer: batch} if writer is not None and batch is not None else {})
        return self._publish(state["version"] + 1, {"parts": kept | fresh, "done": done, "notes": state["notes"] | dict(notes or {})})

    def _depth(self, name: str, rows: int) -> int:
        depth = int(name.split("-")[0])
        while rows > self.part_rows and depth < 40:
            depth, rows = depth + 1, rows // 2
        return depth

    def _write(self, rows: DataFrame, depths: Mapping[str, int]) -> dict[str, list]:
        """Rows of the touched parts in a new folder; folder and number of rows of each part written."""
        folder = uuid.uuid4().hex
        hashed = F.xxhash64(*[F.col(f"`{k}`") for k in self.keys])
        dealt = self._placed(rows, depths).withColumn(PART, part_name(hashed, F.col(DEPTH))).drop(DEPTH)
        # The hint splits the writers of a part with many rows and joins those of small ones.
        dealt.hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(f"{self.root}/data/{folder}")
        if not child_names(self.spark, f"{self.root}/data/{folder}", f"{PART}="):
            return {}
        counted = self.spark.read.schema(f"{self.schema}, {PART} string").parquet(f"{self.root}/data/{folder}").groupBy(PART).count()
        return {r[PART]: [folder, r["count"]] for r in counted.collect()}

    def _publish(self, number: int, commit: dict) -> int:
        make_dirs(self.spark, f"{self.root}/commits")
        latest = max(self._numbers(), default=0)
        # An unfinished commit keeps its number; a finished one is another writer's.
        if latest >= number and any(self._commit(n) is not None for n in range(number, latest + 1)):
            raise ConcurrentCommit(f"{self.root} is at version {latest}, read at {number - 1}")
        number = max(number, latest + 1)
        fs, path = hadoop_path(self.spark, f"{self.root}/commits/{number:010d}.json")
        try:
            out = fs.create(path, False)
        except Exception as taken:
            raise ConcurrentCommit(f"version {number} of {self.root} exists") from taken
        out.write(bytearray(json.dumps(commit).encode()))
        out.close()
        return number

    def upsert(self, updates: DataFrame, order: Sequence[Column], writer: str | None = None, batch: int | None = None) -> int | None:
        """The latest update of each key takes the place of the stored row."""
        latest = latest_rows(updates.select(*self._columns()), self.keys, order)
        return self.change(latest, lambda current, new: new, writer, batch)

    def update(self, condition: Column, values: Mapping[str, Column]) -> int | None:
        """Set columns of the rows that meet a condition; only parts that hold such rows are rewritten."""
        hit = self.read().where(condition).withColumns(dict(values)).select(*self._columns())
        return self.change(hit, lambda current, new: new)

    def _columns(self) -> list[str]:
        return [f"`{f.name}`" for f in self.spark.createDataFrame([], self.schema).schema]

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the folders and commits that none of the last `keep` versions needs."""
        numbers = self.versions()
        kept = numbers[-keep:]
        needed = {folder for n in kept for folder, _ in self._commit(n)["parts"].values() if folder}
        gone = sorted(child_names(self.spark, f"{self.root}/data", "") - needed)
        self._forget(n for n in self._numbers() if kept and n < kept[0])
        for folder in gone:
            delete_path(self.spark, f"{self.root}/data/{folder}")
        return gone

    def _forget(self, numbers: Iterable[int]) -> None:
        for n in numbers:
            delete_path(self.spark, f"{self.root}/commits/{n:010d}.json")
