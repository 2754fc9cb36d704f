"""Sustained conditions over a stream, with timers: runs are closed, also by silence.

State per label is the windows that may still get company and the run that is open.
A timer fires when the watermark has passed a window: no earlier one can come any more,
so it joins the run or ends it. A second one fires when the watermark has passed the
place of the next window: a label that fell silent has its run closed. Then nothing
is left of the label, so state is bounded by the lateness and by the labels that
are in a bad run right now. Needs the RocksDB state store (``with_state_store``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from casequarry.streaming.streams import LATENESS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_AT = StructType([StructField("at", LongType())])
_BAD = StructType([StructField("bad", BooleanType())])
_RUN = StructType([StructField("first", LongType()), StructField("last", LongType()), StructField("windows", LongType())])


def with_state_store(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


class Runs(StatefulProcessor):
    """Runs of at least ``least`` bad windows, ``step`` milliseconds apart, once they are over."""

    def __init__(self, label: str, start: str, bad: str, step: int, least: int):
        self.label, self.start, self.bad, self.step, self.least = label, start, bad, step, least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", _AT, _BAD)
        self.run = handle.getValueState("run", _RUN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = set(self.handle.listTimers())
        for frame in rows:
            for at, bad in zip(frame[self.start], frame[self.bad]):
                ms = pd.Timestamp(at).value // 1_000_000
                # Of two rows for one window a bad one counts, whatever their order.
                old = self.waiting.getValue((ms,))
                self.waiting.updateValue((ms,), (bool(bad) or bool(old and old[0]),))
                for due in (ms, ms + self.step):
                    if due not in known:
                        self.handle.registerTimer(due)
                        known.add(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        run = self.run.get() if self.run.exists() else None
        out = []

        def close():
            if run and run[2] >= self.least:
                out.append((key[0], pd.Timestamp(run[0], unit="ms"), pd.Timestamp(run[1], unit="ms"), run[2]))

        for at, bad in sorted((k[0], v[0]) for k, v in self.waiting.iterator()):
            if at >= now:
                break
            self.waiting.removeKey((at,))
            if run and (not bad or at != run[1] + self.step):
                close()
                run = None
            if bad:
                run = (run[0], at, run[2] + 1) if run else (at, at, 1)
        if run and run[1] + self.step < now:
            close()
            run = None
        if run:
            self.run.update(tuple(int(x) for x in run))
        else:
            self.run.clear()
        if out:
            yield pd.DataFrame(out, columns=[self.label, "first", "last", "windows"])

    def close(self) -> None:
        pass


def sustained_runs(windows: DataFrame, label: str, start: str, bad: str, step_seconds: int, least: int,
                   lateness: str = LATENESS) -> DataFrame:
    """label, first, last, windows of each run of bad windows, given once when it is over.

    ``windows`` streams one row per label and window, in any order within ``lateness``; later ones are
    dropped. Null labels are one label, a null ``bad`` is false, rows without time are left out.
    """
    kind = windows.schema[label].dataType.simpleString()
    rows = windows.select(label, F.col(start).cast("timestamp").alias(start), F.coalesce(bad, F.lit(False)).alias(bad)).filter(F.col(start).isNotNull())
    return rows.withWatermark(start, lateness).groupBy(label).transformWithStateInPandas(
        statefulProcessor=Runs(label, start, bad, step_seconds * 1000, least),
        outputStructType=f"{label} {kind}, first timestamp, last timestamp, windows long", outputMode="Append", timeMode="EventTime")
