"""Forward fill and first rows per group on a stream, with keyed state.

A row's result is settled once the watermark has passed its time: until then
earlier rows may still arrive.  Rows wait in the state of their group; a timer
takes them out in the order (time, tiebreak).  The results are those of the
batch operators over the rows that were not late; late rows, which lie behind
the watermark when they arrive, are dropped by Spark before the state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_keyed_state(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store: state larger than memory, changes checkpointed."""
    spark.conf.set(STORE, ROCKSDB)


class _Ordered(StatefulProcessor):
    """Rows of one group in the order of their time, each once the watermark has passed it."""

    def __init__(self, schema: StructType, order: str, tiebreak: Sequence[str]):
        self.schema, self.names = schema, schema.fieldNames()
        self.at = [self.names.index(c) for c in (order, *tiebreak)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)

    def place(self, row: Sequence) -> tuple:
        # NULL comes first, as in a Spark window.
        return tuple((row[i] is not None, row[i]) for i in self.at)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        found = [
            tuple(None if v is None or v is pd.NaT or v != v else v for v in row)
            for frame in rows
            for row in frame.astype(object).itertuples(index=False, name=None)
        ]
        found = [
            tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in row) for row in found
        ]
        if found:
            self.waiting.appendList(found)
            self._wake(found)
        return iter(())

    def _wake(self, rows: Sequence[Sequence]) -> None:
        first = min(pd.Timestamp(row[self.at[0]]).value for row in rows) // 1_000_000
        self.handle.registerTimer(first + 1)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1_000_000
        rows = list(self.waiting.get()) if self.waiting.exists() else []
        ready = sorted((r for r in rows if pd.Timestamp(r[self.at[0]]).value <= passed), key=self.place)
        left = [r for r in rows if pd.Timestamp(r[self.at[0]]).value > passed]
        if ready:
            self.waiting.clear()
            if left:
                self.waiting.put(left)
                self._wake(left)
            out = self.settle(ready)
            if out:
                yield pd.DataFrame(out, columns=[*self.names, *self.added]).astype(object)

    def settle(self, rows: list[Sequence]) -> list[tuple]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class _Fill(_Ordered):
    def __init__(self, schema: StructType, order: str, tiebreak: Sequence[str], columns: Sequence[str], suffix: str):
        super().__init__(schema, order, tiebreak)
        self.filled = [self.names.index(c) for c in columns]
        self.carried = StructType([schema[c] for c in columns])
        self.added = [f"{c}{suffix}" for c in columns]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.carry = handle.getValueState("carry", self.carried)

    def settle(self, rows: list[Sequence]) -> list[tuple]:
        last = list(self.carry.get()) if self.carry.exists() else [None] * len(self.filled)
        out = []
        for row in rows:
            last = [row[i] if row[i] is not None else old for i, old in zip(self.filled, last)]
            out.append((*row, *last))
        self.carry.update(tuple(last))
        return out


class _First(_Ordered):
    added = ()

    def __init__(self, schema: StructType, order: str, tiebreak: Sequence[str], n: int):
        super().__init__(schema, order, tiebreak)
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.seen = handle.getValueState("seen", StructType([StructField("n", LongType())]))

    def settle(self, rows: list[Sequence]) -> list[tuple]:
        seen = self.seen.get()[0] if self.seen.exists() else 0
        taken = [tuple(row) for row in rows[: max(0, self.n - seen)]]
        self.seen.update((seen + len(taken),))
        return taken


def fill_stream(
    rows: DataFrame,
    columns: Sequence[str],
    key: str = "vin",
    order: str = "app_timestamp",
    tiebreak: Sequence[str] = (),
    delay: str = "10 minutes",
    suffix: str = "_reference",
) -> DataFrame:
    """Streaming form of ``forward_fill``; ``order`` is a timestamp, rows without it are left out.

    A group keeps the rows of the last ``delay`` and one value a column.
    """
    out = StructType([*rows.schema.fields, *[StructField(f"{c}{suffix}", rows.schema[c].dataType) for c in columns]])
    processor = _Fill(rows.schema, order, list(tiebreak), list(columns), suffix)
    return _ordered(rows, key, order, delay, processor, out)


def first_of_stream(
    rows: DataFrame, n: int, group: str = "family", order: str = "app_timestamp", tiebreak: Sequence[str] = (),
    delay: str = "10 minutes",
) -> DataFrame:
    """Streaming form of ``first_per_group``; a group keeps the rows of the last ``delay`` and a count."""
    return _ordered(rows, group, order, delay, _First(rows.schema, order, list(tiebreak), n), rows.schema)


def _ordered(rows: DataFrame, key: str, order: str, delay: str, processor: _Ordered, out: StructType) -> DataFrame:
    use_keyed_state(rows.sparkSession)
    timed = rows.filter(rows[order].isNotNull()).withWatermark(order, delay)
    return timed.groupBy(key).transformWithStateInPandas(processor, out, "Append", "EventTime")
