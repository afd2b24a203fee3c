"""What a stream remembers about each cell, kept in the RocksDB state store."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# The store reads and writes single keys, and a batch uploads its changes only.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


class FirstBurst(StatefulProcessor):
    """Of rows (cell, microseconds): the first event of a cell whose following span holds `min_count` events, kept current in any order of arrival.

    Three things are remembered:

    * `alert`: start and count of the burst, and its first `min_count` - 1 times,
      which decide whether an earlier event starts one;
    * `early`: times before the burst by span-long bucket, fewer than `min_count`
      in each, as more would be a burst;
    * `inside`: the times within the burst, added to as they come and read only
      when its start moves.

    What lies behind the burst can never matter and is not kept, so a batch costs
    what its own events touch, whatever came before. Nothing expires: an event
    however late may start an earlier burst.
    """

    def __init__(self, keys: Sequence[str], span: int, min_count: int) -> None:
        self.keys, self.span, self.min_count = list(keys), span, min_count

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.alert = handle.getValueState("alert", "start bigint, count bigint, heads array<bigint>")
        self.early = handle.getMapState("early", "bucket bigint", "times array<bigint>")
        self.inside = handle.getListState("inside", "t bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        before = self._alert()
        for chunk in rows:
            self._absorb(sorted(chunk.iloc[:, -1].tolist()))
        after = self._alert()
        if after and after[:2] != (before or ())[:2]:
            values = {k: [v] for k, v in zip(self.keys, key)}
            yield pd.DataFrame(values | {"__start": [after[0]], "count": [after[1]]})

    def close(self) -> None:
        pass

    def _alert(self) -> tuple[int, int, list[int]] | None:
        if not self.alert.exists():
            return None
        start, count, heads = self.alert.get()
        return int(start), int(count), list(heads)

    def _absorb(self, times: list[int]) -> None:
        alert = self._alert()
        if alert:
            start, count, heads = alert
            first, behind = bisect_left(times, start), bisect_right(times, start + self.span)
            fresh, times = times[first:behind], times[:first]
            if fresh:
                self.inside.appendList([(t,) for t in fresh])
                self.alert.update((start, count + len(fresh), sorted(heads + fresh[: self.min_count])[: self.min_count - 1]))
        if times:
            self._search(times, self._alert())

    def _search(self, times: list[int], alert: tuple[int, int, list[int]] | None) -> None:
        """Add times before the burst, and move the burst if one of them makes an earlier one."""
        touched: dict[int, list[int]] = {}
        for t in times:
            touched.setdefault(t // self.span, []).append(t)
        near = sorted({b for bucket in touched for b in (bucket - 1, bucket, bucket + 1)})
        kept = {b: self._bucket(b) for b in near} if self.early.exists() else dict.fromkeys(near, [])
        held = {b: sorted(own + touched.get(b, [])) for b, own in kept.items()}
        known = [t for own in held.values() for t in own]
        line = known + (alert[2] if alert else [])  # the burst's times follow all early ones
        step = self.min_count - 1
        found = next((t for i, t in enumerate(known) if i + step < len(line) and line[i + step] - t <= self.span), None)
        if found is None:
            for bucket in touched:
                self.early.updateValue((bucket,), (held[bucket],))
            return
        end, last = found + self.span, found // self.span
        # Times that were inside the former burst may lie behind the new one.
        former = [int(t) for (t,) in self.inside.get()] if alert else []
        within = sorted([t for t in known if found <= t <= end] + [t for t in former if t <= end])
        # Early times from the new start on are within the burst, or behind it for good.
        if self.early.exists():
            for bucket in [int(b) for (b,) in self.early.keys()]:
                if bucket > last:
                    self.early.removeKey((bucket,))
        for bucket, own in held.items():
            still = [t for t in own if t < found]
            if bucket <= last and still != kept[bucket]:
                if still:
                    self.early.updateValue((bucket,), (still,))
                else:
                    self.early.removeKey((bucket,))
        self.inside.put([(t,) for t in within])
        self.alert.update((found, len(within), within[: self.min_count - 1]))

    def _bucket(self, bucket: int) -> list[int]:
        found = self.early.getValue((bucket,))
        return [int(t) for t in found[0]] if found is not None else []
