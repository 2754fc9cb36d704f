"""Percentiles and distinct counts over time from mergeable sketches.

Events are read once, into one sketch per period and label: a quantile sketch (KLL) per minute, a
distinct-count sketch (HyperLogLog) per day. Longer periods and sliding windows merge
sketches; no event is read twice, a late batch is one more set of rows to merge, and a
sketch has the same size however many events it stands for. Tasks build partial
sketches before the shuffle, so a busy label is no hot key.

Stored sketches are appended with ``append``; rows of one period are merged when read.
Quantiles are off by less than some 1.4 % of ranks at the default size (``KLL``), distinct
counts by some 1 % (``HLL``). ``monitor.window_percentiles`` remains the exact form.

Cases: null values and items are not counted; events without time are left out; a period
without events has no row, so a quiet minute costs nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

KLL = 200
HLL = 14
POINTS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def _period(at: str, length: str):
    return F.window(F.col(at).cast("timestamp"), length).start


def quantile_sketches(events: DataFrame, at: str, value: str, labels: Sequence[str] = (), length: str = "1 minute", k: int = KLL) -> DataFrame:
    """start, labels, n, sketch."""
    rows = events.filter(F.col(at).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return rows.groupBy(_period(at, length).alias("start"), *labels).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, length: str, labels: Sequence[str] = (), k: int = KLL) -> DataFrame:
    """The same for longer periods, from shorter ones."""
    return sketches.groupBy(_period("start", length).alias("start"), *labels).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def percentiles(sketches: DataFrame, points: Mapping[str, float] = POINTS) -> DataFrame:
    """A column for each point in place of the sketch."""
    return sketches.withColumns({name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for name, p in points.items()}).drop("sketch")


def rank_of(sketches: DataFrame, bound: float) -> DataFrame:
    """Share of values up to ``bound``, as for a service objective, in place of the sketch."""
    return sketches.withColumn("share", F.kll_sketch_get_rank_double("sketch", F.lit(float(bound)))).drop("sketch")


def distinct_sketches(events: DataFrame, at: str, item: str, labels: Sequence[str] = (), size: int = HLL) -> DataFrame:
    """day, labels, n, sketch."""
    rows = events.filter(F.col(at).isNotNull() & F.col(item).isNotNull())
    return rows.groupBy(F.to_date(at).alias("day"), *labels).agg(F.count("*").alias("n"), F.hll_sketch_agg(item, size).alias("sketch"))


def sliding_distinct(sketches: DataFrame, days: int, labels: Sequence[str] = ()) -> DataFrame:
    """day (the last of each window of ``days`` days up to the latest day there is), labels, n, users (estimate).

    A day's sketch is one small row in each window that holds it.
    """
    last = sketches.agg(F.max("day")).scalar()
    placed = sketches.withColumn("__in", F.explode(F.sequence(F.col("day"), F.least(F.date_add("day", days - 1), last))))
    return placed.groupBy(F.col("__in").alias("day"), *labels).agg(
        F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("users"))


def append(sketches: DataFrame, folder: str, number: int) -> None:
    """Sketches of one batch; writing a number again replaces it."""
    sketches.write.mode("overwrite").parquet(f"{folder}/batch={number:08d}")


def stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).drop("batch")
