"""Structured Streaming forms: ingest, dedupe, cleaning, upsert, alerts.

Defaults where nothing is specified: ten minutes of lateness. Window functions
of ``operators.monitor`` are used as they are, after ``late``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from casequarry.functions import pii
from casequarry.functions.pii_rules import LEAK, STAGED
from casequarry.operators import monitor
from casequarry.session import cut
from casequarry.sources import sinks

LATENESS = "10 minutes"


def late(stream: DataFrame, at: str, lateness: str = LATENESS) -> DataFrame:
    return stream.withWatermark(at, lateness)


def deduplicated(stream: DataFrame, at: str, keys: Sequence[str] = ("id", "checksum"),
                 lateness: str = LATENESS) -> DataFrame:
    """Repeated change events dropped; state lives as long as the lateness."""
    return late(stream, at, lateness).dropDuplicatesWithinWatermark(list(keys))


def error_rate(stream: DataFrame, at: str, length: str, failed: Column, labels: Sequence[str] = (),
               slide: str | None = None) -> DataFrame:
    return monitor.window_ratio(late(stream, at), at, length, failed, labels, slide)


def outages(stream: DataFrame, at: str, gap: str, labels: Sequence[str]) -> DataFrame:
    """Periods of failure events as session windows."""
    return late(stream, at).groupBy(F.session_window(at, gap), *labels).agg(
        F.count("*").alias("events")).select(
        F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"),
        *labels, "events")


def sustained_alerts(windows: DataFrame, label: str, start: str, bad: str, step_seconds: int,
                     least: int) -> DataFrame:
    """Fires once when a label has been bad for ``least`` windows in a row.

    ``windows`` streams closed windows from the table an append query of
    ``error_rate`` or its like writes: one query takes no grouped state after
    an aggregation. State per label is the last window and the length of the
    run; a batch's windows are walked by time.
    """
    out = StructType([StructField(label, StringType()), StructField("fired_at", TimestampType()),
                      StructField("windows", LongType())])
    state = StructType([StructField("last", LongType()), StructField("run", LongType())])

    def walk(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        last, run = held.get if held.exists else (None, 0)
        fired = []
        rows = pd.concat(list(frames)).sort_values(start)
        for at, is_bad in zip(rows[start], rows[bad]):
            second = int(pd.Timestamp(at).timestamp())
            follows = last is not None and second - last == step_seconds
            run = (run + 1 if follows else 1) if is_bad else 0
            last = second
            if run == least:
                fired.append((key[0], pd.Timestamp(at), run))
        held.update((last, run))
        yield pd.DataFrame(fired, columns=[label, "fired_at", "windows"])

    return (windows.select(label, start, bad).groupBy(label)
            .applyInPandasWithState(walk, out, state, "append", GroupStateTimeout.NoTimeout))


def cleaned(stream: DataFrame, text: str, table: str | None = None) -> DataFrame:
    """Redacted text and a flag for what still looks like personal data. The
    same narrow expressions as in batch."""
    clean = pii.redact(stream, [text], table, rules=STAGED, merge="cover")
    return clean.withColumn("leak", pii.has_pii(F.col(text), LEAK))


def apply_changes(spark: SparkSession, batch: DataFrame, folder: str, key: str, version: str,
                  number: int, buckets: int | None = None) -> None:
    """One micro-batch into a versioned snapshot: clean rows are merged, the
    rest goes to the review queue. Repeating a batch gives the same version,
    so a restart neither loses nor doubles it. The cleaned batch is written once
    and read for both. With ``buckets`` only the buckets with changes are written
    again (read by ``sinks.read_buckets``), else the whole snapshot."""
    batch = cut(batch)
    batch.filter("leak").write.mode("overwrite").parquet(f"{folder}/review/batch={number}")
    rows = batch.filter(~F.col("leak")).drop("leak")
    target = f"{folder}/current"
    if buckets:
        sinks.upsert_buckets(rows, target, key, version, number, buckets)
        return
    newest = sinks.current_version(spark, target)
    if newest is not None and int(newest.rsplit("=", 1)[1]) >= number:
        return
    base = spark.read.parquet(newest) if newest else spark.createDataFrame([], rows.schema)
    sinks.write_version(sinks.upsert(base, rows, key, version), target, number)


def run_changes(stream: DataFrame, folder: str, checkpoint: str, key: str, version: str, text: str,
                at: str, table: str | None = None, buckets: int | None = None, **trigger):
    """Dedupe, clean, split and upsert a stream of change events."""
    spark = stream.sparkSession
    ready = cleaned(deduplicated(stream, at, [key, version]), text, table)
    return (ready.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, number: apply_changes(spark, batch, folder, key, version, number, buckets))
            .trigger(**(trigger or {"availableNow": True})).start())


def zero_result_rate(searches: DataFrame, at: str, length: str, bucket: Column, results: str) -> DataFrame:
    """Share of searches without a result, per window and query-length bucket."""
    return monitor.window_ratio(late(searches.withColumn("bucket", bucket), at), at, length,
                                F.col(results) == 0, ["bucket"])
