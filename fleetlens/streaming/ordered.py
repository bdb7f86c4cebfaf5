"""Keyed streams whose rows are worked on in order of time, whatever order they arrive in.

Rows of a key wait in the state store until the watermark has passed them.  Then
no earlier row can follow, so they are taken in order of time, and what comes
out does not depend on how arrivals were cut into micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Delay of the watermark: how late a row may be.
WATERMARK = "12 hours"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class InOrder(StatefulProcessor):
    """Rows ``columns`` (the first one is the time) of each key in order of time, then of the other columns.

    The state of a key is the rows that the watermark has not passed, at most
    those of the watermark's delay, and the ``memory`` that ``step`` keeps: a
    short list.  One event-time timer per key stands at its earliest waiting row.
    """

    #: What ``step`` keeps of a key, as columns.
    memory: T.StructType

    def __init__(self, rows: T.StructType, key: T.StructType):
        self.rows, self.key = rows, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.rows)
        self.kept = handle.getListState("kept", self.memory)

    def step(self, kept: list[tuple], row: tuple) -> tuple[list[tuple], list[tuple]]:
        """One row on top of what is kept: what is kept now, and what comes out."""
        raise NotImplementedError

    def names(self) -> list[str]:
        """Columns of what comes out, after the key's."""
        raise NotImplementedError

    @staticmethod
    def _ms(when) -> int:
        return int(pd.Timestamp(when).value // 1_000_000)

    def _wake(self, rows: list[tuple]) -> None:
        """Set the timer at the earliest waiting row and no other one."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if rows:
            # the watermark has whole milliseconds: a row within one has been passed with the next
            self.handle.registerTimer(min(self._ms(r[0]) for r in rows) + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if any(k is None for k in key):
            return
        names = self.rows.names
        arrived = [tuple(r) for frame in rows for r in frame[names].astype(object).where(frame[names].notna(), None).itertuples(index=False)]
        arrived = [r for r in arrived if r[0] is not None]
        if not arrived:
            return
        before = next(iter(self.handle.listTimers()), None)
        self.waiting.appendList(arrived)
        first = min(self._ms(r[0]) for r in arrived) + 1
        if before is None or first < before:
            self._wake(arrived)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        order = lambda r: (pd.Timestamp(r[0]), *((x is None, x) for x in r[1:]))
        rows = [tuple(r) for r in self.waiting.get()]
        ready = sorted((r for r in rows if self._ms(r[0]) < passed), key=order)
        later = [r for r in rows if self._ms(r[0]) >= passed]
        kept = [tuple(r) for r in self.kept.get()]
        out: list[tuple] = []
        for row in ready:
            kept, made = self.step(kept, row)
            out += [(*key, *m) for m in made]
        for state, values in ((self.waiting, later), (self.kept, kept)):
            if values:
                state.put(values)
            elif state.exists():
                state.clear()
        self._wake(later)
        if out:
            yield pd.DataFrame(out, columns=[*self.key.names, *self.names()])

    def close(self) -> None:
        pass


def in_order(rows: DataFrame, keys: tuple[str, ...], processor: type[InOrder], columns: tuple[str, ...], out: str, watermark: str = WATERMARK, **settings) -> DataFrame:
    """``out`` (the keys and what ``processor`` gives) for a stream of ``keys`` and ``columns``, the first of which is the time.

    A row later than the watermark is dropped by Spark.  Rows without a key or
    a time are passed over.
    """
    use_state_store(rows.sparkSession)
    timed = rows.select(*keys, *columns).withWatermark(columns[0], watermark)
    kind = lambda names: T.StructType([rows.schema[n] for n in names])
    return timed.groupBy(*keys).transformWithStateInPandas(processor(kind(columns), kind(keys), **settings), out, "append", "eventtime")


def use_state_store(spark: SparkSession) -> None:
    """Keyed state of any kind needs the store that keeps it on disk."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
