"""Windowed measures over event tables. The functions that only group by
window run unchanged on a stream; the others reduce to window rows first, so
later steps see one row per window and label whatever the event rate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casequarry.skew import exact_percentiles, top_n

# Histogram bounds in seconds or rows.
LATENCY_BOUNDS = [0.1, 0.25, 0.5, 0.75, 1.0, 2.0, 5.0]
RESULT_BOUNDS = [0, 1, 5, 10, 20, 50, 100]


def _window(at: str, length: str, slide: str | None = None) -> Column:
    return F.window(at, length, slide) if slide else F.window(at, length)


def window_counts(events: DataFrame, at: str, length: str, labels: Sequence[str] = (),
                  slide: str | None = None) -> DataFrame:
    """Events per window and label; sliding if ``slide`` is given."""
    return events.groupBy(_window(at, length, slide), *labels).agg(F.count("*").alias("n")).select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), *labels, "n")


def rate(events: DataFrame, at: str, length: str, seconds: float, labels: Sequence[str] = (),
         slide: str | None = None) -> DataFrame:
    return window_counts(events, at, length, labels, slide).withColumn("rate", F.col("n") / F.lit(float(seconds)))


def sliding_rate(events: DataFrame, at: str, length: int, slide: int, labels: Sequence[str] = ()) -> DataFrame:
    """The batch form of a sliding rate: count per slide first, then add up
    whole slides. An event enters one row, not length / slide rows."""
    def slot(c: Column) -> Column:
        return F.floor(F.unix_micros(c.cast("timestamp")) / (slide * 1_000_000))
    steps = length // slide
    small = events.groupBy(slot(F.col(at)).alias("__slot"), *labels).agg(F.count("*").alias("n"))
    spread = small.withColumn("__slot", F.explode(F.sequence(F.col("__slot") - (steps - 1), F.col("__slot"))))
    start = F.timestamp_seconds(F.col("__slot") * slide)
    return spread.groupBy("__slot", *labels).agg(F.sum("n").alias("n")).select(
        start.alias("start"), *labels, "n", (F.col("n") / F.lit(float(length))).alias("rate"))


def window_ratio(events: DataFrame, at: str, length: str, part: Column, labels: Sequence[str] = (),
                 slide: str | None = None) -> DataFrame:
    """Share of events that satisfy ``part`` in each window."""
    return events.groupBy(_window(at, length, slide), *labels).agg(
        F.count("*").alias("n"), F.count_if(part).alias("hits")).select(
        F.col("window.start").alias("start"), *labels, "n", "hits",
        (F.col("hits") / F.col("n")).alias("ratio"))


def window_percentiles(events: DataFrame, at: str, length: str, value: str) -> DataFrame:
    """Exact p50, p95, p99 per window."""
    timed = events.select(_window(at, length).start.alias("start"), value)
    return exact_percentiles(timed, ["start"], value, {"p50": 0.5, "p95": 0.95, "p99": 0.99}, bins=64)


def window_percentiles_approx(events: DataFrame, at: str, length: str, value: str,
                              accuracy: int = 10_000) -> DataFrame:
    """Bounded-memory form, also for streams."""
    points = F.percentile_approx(value, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), accuracy)
    return events.groupBy(_window(at, length)).agg(points.alias("p")).select(
        F.col("window.start").alias("start"), F.get("p", F.lit(0)).alias("p50"),
        F.get("p", F.lit(1)).alias("p95"), F.get("p", F.lit(2)).alias("p99"))


def histogram(events: DataFrame, value: str, bounds: Sequence[float], labels: Sequence[str] = ()) -> DataFrame:
    """Cumulative counts per declared bound, and +Inf. All bounds are counted
    in one pass; an event is never copied."""
    names = [str(float(b)) for b in bounds]
    counts = events.groupBy(*labels).agg(
        *[F.count_if(F.col(value) <= b).alias(f"__b{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("__all"))
    cells = F.array(*[F.struct(F.lit(n).alias("le"), F.col(f"__b{i}").alias("n"))
                      for i, n in enumerate(names)],
                    F.struct(F.lit("+Inf").alias("le"), F.col("__all").alias("n")))
    return counts.select(*labels, F.inline(cells))


def histogram_quantile(buckets: DataFrame, q: float, labels: Sequence[str] = ()) -> DataFrame:
    """Quantile by linear interpolation inside the bucket that holds it; the
    last finite bound if it lies beyond."""
    cells = buckets.withColumn("le", F.when(F.col("le") == "+Inf", float("inf")).otherwise(
        F.expr("try_cast(le as double)")))
    order = Window.partitionBy(*labels).orderBy("le") if labels else Window.orderBy("le")
    whole = Window.partitionBy(*labels) if labels else Window.partitionBy(F.lit(1))
    rows = cells.withColumns({
        "below": F.coalesce(F.lag("n").over(order), F.lit(0)),
        "lower": F.coalesce(F.lag("le").over(order), F.lit(0.0)), "total": F.max("n").over(whole)})
    rank = F.col("total") * q
    hit = rows.filter((F.col("n") >= rank) & ((F.col("below") < rank) | (F.col("lower") == 0.0)))
    first = hit.groupBy(*labels).agg(F.min_by(F.struct("le", "lower", "below", "n", "total"), "le").alias("r"))
    share = F.try_divide(F.col("r.total") * q - F.col("r.below"), F.col("r.n") - F.col("r.below"))
    inside = F.col("r.lower") + (F.col("r.le") - F.col("r.lower")) * F.coalesce(share, F.lit(0.0))
    return first.select(*labels, F.when(F.col("r.le") == float("inf"), F.col("r.lower")).otherwise(inside)
                        .alias("quantile"))


def _join_at_midnight(runs: DataFrame, day: str, start: str, last: str, follows: Column,
                      totals: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Runs found per day, joined where one goes on into the next day.

    Only the first and the last run of a day can, so the step that orders a
    label's whole history sees two rows a day; the others pass by. ``follows``
    tests a row against ``__before``, the end of the run before it.
    """
    daily = Window.partitionBy(*labels, day)
    marked = runs.withColumns({
        "__first": F.row_number().over(daily.orderBy(start)),
        "__left": F.row_number().over(daily.orderBy(F.desc(start)))})
    outer = (F.col("__first") == 1) | (F.col("__left") == 1)
    order = Window.partitionBy(*labels).orderBy(start) if labels else Window.orderBy(start)
    edge = (marked.filter(outer).withColumn("__before", F.lag(last).over(order))
            .withColumn("__run", F.sum(F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1)).over(order)))
    joined = edge.groupBy(*labels, "__run").agg(
        F.min(start).alias(start), F.max(last).alias(last), *[F.sum(t).alias(t) for t in totals])
    kept = [*labels, start, last, *totals]
    return joined.select(*kept).unionByName(marked.filter(~outer).select(*kept))


def sustained(windows: DataFrame, start: str, bad: Column, step_seconds: int, least: int,
              labels: Sequence[str] = ()) -> DataFrame:
    """Runs of at least ``least`` neighbouring bad windows: first and last
    window, and length. Gaps and islands per day, joined at midnight."""
    seconds = F.unix_seconds(F.col(start).cast("timestamp"))
    place = F.row_number().over(Window.partitionBy(*labels, "__day").orderBy(start))
    daily = windows.filter(bad).withColumn("__day", F.to_date(start)).withColumn(
        "__island", F.floor(seconds / step_seconds) - place)
    runs = daily.groupBy(*labels, "__day", "__island").agg(
        F.min(start).alias("first"), F.max(start).alias("last"), F.count("*").alias("windows"))
    gap = (F.unix_seconds(F.col("first").cast("timestamp"))
           - F.unix_seconds(F.col("__before").cast("timestamp")))
    whole = _join_at_midnight(runs, "__day", "first", "last", gap == step_seconds, ["windows"], labels)
    return whole.filter(F.col("windows") >= least)


DAY = 86_400_000_000


def sessions(events: DataFrame, at: str, gap_seconds: int, labels: Sequence[str] = ()) -> DataFrame:
    """Periods of activity whose pauses do not exceed the gap: start, last
    event, count.

    Events are first reduced to one row per label, day and time slot no longer
    than the gap (two events of a slot are always in one period), with
    map-side combine. Periods are then found per day and joined at midnight.
    """
    width = gap_seconds * 1_000_000
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    slots = events.groupBy(*labels, F.floor(micros / DAY).alias("__day"),
                           F.floor(micros / width).alias("__slot")).agg(
        F.min(micros).alias("__from"), F.max(micros).alias("__to"), F.count("*").alias("events"))
    daily = Window.partitionBy(*labels, "__day").orderBy("__slot")
    new = F.col("__from") - F.lag("__to").over(daily) > width
    runs = (slots.withColumn("__new", F.when(F.coalesce(new, F.lit(True)), 1).otherwise(0))
            .withColumn("__session", F.sum("__new").over(daily))
            .groupBy(*labels, "__day", "__session")
            .agg(F.min("__from").alias("__from"), F.max("__to").alias("__to"),
                 F.sum("events").alias("events")))
    whole = _join_at_midnight(runs, "__day", "__from", "__to",
                              F.col("__from") - F.col("__before") <= width, ["events"], labels)
    return whole.select(*labels, F.timestamp_micros("__from").alias("start"),
                        F.timestamp_micros("__to").alias("last"), "events")


def top_per_window(events: DataFrame, at: str, length: str, kind: str, n: int = 10) -> DataFrame:
    """Most frequent values of ``kind`` in each window."""
    counted = window_counts(events, at, length, [kind])
    return top_n(counted, ["start"], [F.desc("n"), F.asc(kind)], n, "rank", [kind]).drop("end")


def processing_rate(events: DataFrame, at: str, minutes: int, floor: float = 200.0) -> DataFrame:
    """Records per minute and whether it is below the floor."""
    return window_counts(events, at, f"{minutes} minutes").select(
        "start", (F.col("n") / F.lit(float(minutes))).alias("per_minute")).withColumn(
        "low", F.col("per_minute") < floor)


def spikes(windows: DataFrame, start: str, value: str, labels: Sequence[str] = (), above: float = 0.10
           ) -> DataFrame:
    """Window rows that exceed the one before by more than ``above``."""
    order = Window.partitionBy(*labels).orderBy(start) if labels else Window.orderBy(start)
    before = F.lag(value).over(order)
    change = F.try_divide(F.col(value) - before, before)
    return windows.withColumn("change", change).filter(F.col("change") > above)


def latest_gauge(samples: DataFrame, label: str, at: str, value: str, floor: float) -> DataFrame:
    """Last value per label against a floor."""
    return samples.groupBy(label).agg(F.max_by(value, F.struct(at, value)).alias("value")).withColumn(
        "low", F.col("value") < floor)
