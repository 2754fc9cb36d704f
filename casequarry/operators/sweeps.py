"""Records inside intervals by a sweep over ranges of time.

Both sides are dealt to ranges of time that hold about equally many records, found from the
records' own quantiles. An interval is one row in each range that it reaches, however
long it is: a long one is carried over a border by standing in the next range too. In a
range both sides are sorted once, and an interval's records are one stretch of the
sorted records, so the work is that of sorting and of writing the result. A range that is
still crowded, because very many records have one time, is split by salt, and only its
intervals are repeated.

Cases: ends count as inside; an interval that ends before it starts holds nothing; rows of
null time are left out; equal rows count one by one; without records or intervals there are
no rows; a record in several intervals gives a row for each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructType

RANGE_ROWS = 500_000
MOST_RANGES = 10_000  # bounds the driver holds


def _micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def _bounds(times: DataFrame, rows: int, range_rows: int) -> np.ndarray:
    n = min(MOST_RANGES, -(-rows // range_rows))
    if n < 2:
        return np.zeros(0, np.int64)
    found = times.agg(F.percentile_approx("t", [k / n for k in range(1, n)], 10 * MOST_RANGES)).first()[0]
    return np.unique(np.array(found or [], np.int64))


def _dealt_records(rows: DataFrame, bounds: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            place = np.searchsorted(bounds, batch.column("__t").to_numpy(zero_copy_only=False), "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place.astype(np.int32))], names=[*batch.schema.names, "__part"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields]).add("__part", IntegerType()))


def _dealt_intervals(rows: DataFrame, bounds: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            a, b = (np.searchsorted(bounds, batch.column(c).to_numpy(zero_copy_only=False), "right") for c in ("__a", "__b"))
            sizes = b - a + 1
            at = np.repeat(np.arange(len(a)), sizes)
            part = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + a[at]
            out = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(part.astype(np.int32))], names=[*out.schema.names, "__part"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields]).add("__part", IntegerType()))


def _swept(records: pa.Table, intervals: pa.Table) -> pa.Table:
    order = np.argsort(records.column("__t").to_numpy(), kind="stable")
    times = records.column("__t").to_numpy()[order]
    low = np.searchsorted(times, intervals.column("__a").to_numpy(), "left")
    high = np.searchsorted(times, intervals.column("__b").to_numpy(), "right")
    sizes = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]
    left = records.drop_columns(["__t", "__part", "__salt"]).take(pa.array(order[inside]))
    right = intervals.drop_columns(["__a", "__b", "__part", "__salt"]).take(pa.array(which))
    return pa.Table.from_arrays([*left.columns, *right.columns], names=[*left.column_names, *right.column_names])


def records_in_intervals(records: DataFrame, at: str, intervals: DataFrame, start: str, end: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each record inside an interval, with the interval's columns. Names must not be on both sides."""
    both = set(records.columns) & set(intervals.columns)
    if both:
        raise ValueError(f"{sorted(both)} are columns of records and intervals")
    timed = records.withColumn("__t", _micros(at)).filter("__t is not null")
    spans = intervals.withColumns({"__a": _micros(start), "__b": _micros(end)}).filter("__a <= __b")
    times = timed.select(F.col("__t").alias("t"))
    bounds = _bounds(times, times.count(), range_rows)
    dealt = _dealt_records(timed, bounds)
    # Salts per range, from its count: at most one range for every ``range_rows`` records has any.
    crowded = {r["__part"]: -(-r["n"] // range_rows) for r in dealt.groupBy("__part").agg(F.count("*").alias("n")).filter(
        F.col("n") > 2 * range_rows).collect()}
    salts = F.lit(1)
    for part, n in crowded.items():
        salts = F.when(F.col("__part") == part, F.lit(n)).otherwise(salts)
    left = dealt.withColumn("__salt", F.pmod(F.xxhash64(*records.columns, F.monotonically_increasing_id()), salts).cast("int"))
    right = _dealt_intervals(spans, bounds).withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    schema = StructType([*records.schema.fields, *intervals.schema.fields])
    return left.groupBy("__part", "__salt").cogroup(right.groupBy("__part", "__salt")).applyInArrow(_swept, schema)
