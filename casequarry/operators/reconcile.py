"""Checksums, lineage, store comparison, recovery and reconciliation reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casequarry.functions import pii
from casequarry.functions import vectors as V
from casequarry.functions.pii_rules import STAGED
from casequarry.operators.sampling import random_rows
from casequarry.session import cut
from casequarry.skew import parted, top_n
from casequarry.sources.sinks import upsert

# Checksum fields, stages and limits.
CHECKSUM_FIELDS = ["Id", "CaseNumber", "CreatedDate", "LastModifiedDate", "Subject", "Description",
                   "Resolution__c"]
STAGES = ["extracted", "pii_removed", "embedding_generated", "weaviate_loaded"]
COMPARED_FIELDS = ["CaseNumber", "Product__c", "Priority", "Status"]


def checksum(columns: Sequence[str] = tuple(CHECKSUM_FIELDS)) -> Column:
    """SHA-256 of a JSON object with sorted keys; nulls are kept."""
    ordered = [F.col(c).cast("string").alias(c) for c in sorted(columns)]
    return F.sha2(F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"}), 256)


def classify(records: DataFrame, lineage: DataFrame, key: str) -> DataFrame:
    """Adds ``change``: new, changed, retry (same version, not completed) or
    unchanged. Both sides carry ``checksum``; lineage has ``status``."""
    known = lineage.select(F.col(key), F.col("checksum").alias("__old"), F.col("status").alias("__status"))
    return records.join(known, key, "left").withColumn(
        "change", F.when(F.col("__old").isNull(), "new").when(F.col("__old") != F.col("checksum"), "changed")
        .when(F.coalesce(F.col("__status"), F.lit("")) != "completed", "retry").otherwise("unchanged")
    ).drop("__old", "__status")


def to_process(records: DataFrame, lineage: DataFrame, key: str) -> DataFrame:
    """Records without a completed run of the same version."""
    done = lineage.filter(F.col("status") == "completed").select(key, "checksum")
    return records.join(done, [key, "checksum"], "left_anti")


def advance(lineage: DataFrame, done: DataFrame, key: str, stage: str, at: Column,
            status: str = "in_progress") -> DataFrame:
    """Lineage after ``stage`` was reached for the keys of ``done``; new keys
    are added."""
    changes = done.select(
        key, F.lit(stage).alias("current_stage"), F.lit(status).alias("status"), "checksum",
        F.lit(0).alias("retry_count"), at.alias("updated_at"))
    return upsert(lineage.select(*changes.columns), changes, key, "updated_at")


def stage_counts(lineage: DataFrame) -> DataFrame:
    return lineage.groupBy("current_stage", "status").agg(F.count("*").alias("n"))


def discrepancies(source: DataFrame, lineage: DataFrame, loaded: DataFrame) -> DataFrame:
    """The three checks of a run: untracked source rows, attrition below 95 %,
    and a lineage that disagrees with the store. One row per finding."""
    reached = lineage.agg(
        F.count("*").alias("tracked"),
        F.count_if((F.col("current_stage") == STAGES[-1]) & (F.col("status") == "completed")).alias("done"))
    counts = reached.withColumn("source", source.agg(F.count("*")).scalar()).withColumn(
        "actual", loaded.agg(F.count("*")).scalar())
    gap = F.col("source") - F.col("tracked")
    rate = F.when(F.col("tracked") > 0, F.col("done") / F.col("tracked")).otherwise(F.lit(0.0))
    off = F.col("done") - F.col("actual")

    def found(name: str, expected: Column, actual: Column, size: Column, severity: Column) -> Column:
        return F.struct(F.lit(name).alias("type"), expected.cast("double").alias("expected"),
                        actual.cast("double").alias("actual"), size.cast("bigint").alias("gap"),
                        severity.alias("severity"))
    findings = F.array_compact(F.array(
        F.when(gap != 0, found("staging_to_lineage_gap", F.col("source"), F.col("tracked"), gap,
                               F.when(gap > 100, "high").otherwise("medium"))),
        F.when(rate < 0.95, found("pipeline_attrition", F.lit(0.95), F.round(rate, 6),
                                  F.col("tracked") - F.col("done"), F.lit("high"))),
        F.when(off != 0, found("weaviate_lineage_mismatch", F.col("done"), F.col("actual"), off,
                               F.when(F.abs(off) > 1000, "critical").otherwise("medium")))))
    return counts.select(F.inline(findings))


def layer_gaps(layers: DataFrame) -> DataFrame:
    """``layers`` has position, layer, n (one row per layer); adds the loss
    against the layer before."""
    before = F.lag("n").over(Window.orderBy("position"))  # as many rows as layers
    return layers.select("position", "layer", "n", F.coalesce(before - F.col("n"), F.lit(0)).alias("gap"),
                         F.coalesce(F.try_divide(F.col("n"), before), F.lit(1.0)).alias("rate"))


def run_summary(run_id: str, run_type: str, start: Column, end: Column, source: DataFrame,
                lineage: DataFrame, loaded: DataFrame, recovered: int = 0) -> DataFrame:
    """One row for the table of runs."""
    found = cut(discrepancies(source, lineage, loaded))  # at most three rows, used twice
    passed = F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.col("current_stage"))
    totals = lineage.agg(F.count("*").alias("staging_count"), F.count_if(passed >= 3).alias("transformed_count"))
    return totals.select(
        F.lit(run_id).alias("run_id"), F.lit(run_type).alias("run_type"), start.alias("start_time"),
        end.alias("end_time"), F.lit("completed").alias("status"),
        source.agg(F.count("*")).scalar().alias("source_count"), "staging_count", "transformed_count",
        loaded.agg(F.count("*")).scalar().alias("weaviate_count"),
        found.agg(F.count("*")).scalar().alias("discrepancies_found"),
        F.lit(recovered).alias("records_recovered"),
        F.coalesce(found.agg(F.to_json(F.collect_list(F.struct("*")))).scalar(), F.lit("[]"))
        .alias("error_details"))


def stuck(lineage: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Records not completed and older than the limit. Sort by created_at to
    read them newest first."""
    limit = F.timestamp_add("HOUR", F.lit(-hours), now)
    return lineage.filter((F.col("status") != "completed") & (F.col("created_at") < limit))


def recovery_routes(records: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Adds ``route``: start over from cleaning, load only, none, or not found
    in staging."""
    rows = max(records.count(), staged.count())
    known = parted(staged.select(key), rows, key).distinct().withColumn("__there", F.lit(True))
    stage = F.col("current_stage")
    return parted(records, rows, key).join(known, key, "left").withColumn(
        "route", F.when(F.col("__there").isNull(), "not_found")
        .when(stage.isin(STAGES[0], STAGES[1]), "reclean")
        .when(stage == STAGES[2], "load_only").otherwise("none")).drop("__there")


def rerun(routed: DataFrame, staged: DataFrame, key: str,
          work: Mapping[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Run each route's flow on its staged rows and enter the result.

    ``work`` maps a route to a function from staged rows to (key, error); it
    does the cleaning, embedding and loading. The returned lineage has what
    happened: loaded and completed, or failed with the error. Rows a flow gives
    no answer for stay as they were.
    """
    rows = staged.count()
    known, dealt = (parted(x, rows, key) for x in (staged, routed))
    done = reduce(DataFrame.unionByName, [
        flow(known.join(dealt.filter(F.col("route") == route).select(key), key, "left_semi")).select(
            key, F.col("error").cast("string").alias("__error"), F.lit(True).alias("__ran"))
        for route, flow in work.items()])
    out = dealt.join(parted(done, rows, key), key, "left")
    loaded = F.col("__ran") & F.col("__error").isNull()
    return out.withColumns({
        "current_stage": F.when(loaded, STAGES[-1]).otherwise(F.col("current_stage")),
        "status": F.when(loaded, "completed").when(F.col("__ran"), "failed").otherwise(F.col("status")),
        "error": F.col("__error")}).drop("__ran", "__error")


def recovery_outcome(after: DataFrame) -> DataFrame:
    """What the lineage says after a re-run: rows tried, rows now completed, and
    rows that are not in staging or failed again."""
    tried = F.col("route").isin("reclean", "load_only")
    return after.agg(
        F.count("*").alias("attempted"),
        F.count_if(tried & (F.col("status") == "completed")).alias("recovered_count"),
        F.count_if((F.col("route") == "not_found") | (tried & (F.col("status") != "completed"))).alias("failed_count"))


def compare_stores(source: DataFrame, stored: DataFrame, key: str, rows: int = 0) -> DataFrame:
    """Per key: MATCH, MISSING, ORPHANED, STALE, SOURCE_NEWER or CORRUPT.

    Source rows carry ``checksum`` (recorded at extraction) and ``recomputed``
    (over the row as it is now); stored rows carry ``checksum``. A recomputed
    value equal to the source's means the store is stale, one equal to the
    store's that the source changed after loading, neither that data is
    corrupt. ``rows``, the number in the larger store if known, decides the number of tasks.
    """
    a = source.select(F.col(key), F.col("checksum").alias("__a"), F.col("recomputed").alias("__r"))
    b = stored.select(F.col(key), F.col("checksum").alias("__b"))
    return parted(a, rows, key).join(parted(b, rows, key), key, "full_outer").select(key, (
        F.when(F.col("__b").isNull(), "MISSING").when(F.col("__a").isNull(), "ORPHANED")
        .when(F.col("__a") == F.col("__b"), "MATCH").when(F.col("__r") == F.col("__a"), "STALE")
        .when(F.col("__r") == F.col("__b"), "SOURCE_NEWER").otherwise("CORRUPT")).alias("outcome"))


def mismatch_level(compared: DataFrame) -> DataFrame:
    """Counts, mismatch rate and alert level: above 5 % critical, above 1 %
    warning."""
    rate = F.avg(F.when(F.col("outcome") == "MATCH", 0.0).otherwise(1.0))
    return compared.agg(F.count("*").alias("total"), rate.alias("mismatch_rate")).withColumn(
        "level", F.when(F.col("mismatch_rate") > 0.05, "critical")
        .when(F.col("mismatch_rate") > 0.01, "warning").otherwise("info"))


def retry_schedule(failed: DataFrame, at: str, most: int = 3) -> DataFrame:
    """Next try after 2^n minutes (n = tries so far, counting this one), up to
    ``most`` tries; then the manual queue."""
    tries = F.col("retry_count") + 1
    wait = F.pow(F.lit(2), tries).cast("int")
    again = F.col("retry_count") < most
    return failed.withColumns({
        "queue": F.when(again, "retry").otherwise("manual"),
        "delay_minutes": F.when(again, wait),
        "next_at": F.when(again, F.timestamp_add("MINUTE", wait, F.col(at)))})


def content_integrity(staged: DataFrame, stored: DataFrame, key: str, text: str,
                      fields: Sequence[str] = tuple(COMPARED_FIELDS), sample: int | None = 1000,
                      seed: int = 42, classes: str = "unicode") -> DataFrame:
    """Compares fields of sampled rows in both stores and looks for e-mail
    addresses left in the stored text. ``sample=None`` takes all rows."""
    rows = staged if sample is None else random_rows(staged, key, sample, seed)
    there = stored.select(F.col(key), F.lit(True).alias("__there"),
                          pii.has_pii(F.col(text), STAGED[:1], classes).alias("__leak"),
                          *[F.col(f).alias(f"__{f}") for f in fields])
    same = reduce(lambda a, b: a & b, [F.col(f).eqNullSafe(F.col(f"__{f}")) for f in fields])
    bad = F.col("__there").isNull() | ~same | F.coalesce(F.col("__leak"), F.lit(False))
    return rows.join(there, key, "left").agg(
        F.count("*").alias("sample_size"), F.count_if(bad).alias("corrupted_count")).withColumn(
        "corruption_rate", F.try_divide("corrupted_count", "sample_size"))


def weekly_issues(count_findings: DataFrame, integrity: DataFrame, vectors: DataFrame, vector: str,
                  size: int, leak_scan: DataFrame) -> DataFrame:
    """(type, n, severity) of everything the weekly deep check found."""
    def issue(df: DataFrame, name: str, n: Column, severity: str, most: int = 0) -> DataFrame:
        return df.select(F.lit(name).alias("type"), n.cast("bigint").alias("n"),
                         F.lit(severity).alias("severity")).filter(F.col("n") > most)
    counted = count_findings.agg(F.count("*").alias("n"))
    wrong = V.success_rate(vectors, vector, size)
    return reduce(DataFrame.unionByName, [
        issue(counted, "count_discrepancy", F.col("n"), "high"),
        issue(integrity, "content_corruption", F.col("corrupted_count"), "high", most=10),
        issue(wrong, "embedding_dimension_error", F.col("wrong_dimensions"), "medium"),
        issue(leak_scan, "pii_leakage", F.col("leaks"), "critical")])


def top_failures(failed: DataFrame, by: str = "error_type", n: int = 10) -> DataFrame:
    return failed.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by).limit(n)


def stage_durations(lineage: DataFrame, times: Sequence[str]) -> DataFrame:
    """Mean seconds between neighbouring stage times."""
    def secs(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp")) / 1e6
    return lineage.agg(*[F.avg(secs(b) - secs(a)).alias(f"{a}_to_{b}")
                         for a, b in zip(times, times[1:])])


def mean_time_to_recovery(failed: DataFrame, failed_at: str, resolved_at: str) -> DataFrame:
    gap = (F.unix_micros(F.col(resolved_at).cast("timestamp"))
           - F.unix_micros(F.col(failed_at).cast("timestamp"))) / 1e6
    return failed.agg(F.count_if(F.col(resolved_at).isNotNull()).alias("resolved"),
                      F.avg(gap).alias("mttr_seconds"))


# Days kept per log; a missing table is kept for ever.
KEEP_DAYS = {"failed_records": 90, "reconciliation_runs": 30}


def retained(df: DataFrame, table: str, at: str, now: Column) -> DataFrame:
    if table not in KEEP_DAYS:
        return df
    return df.filter(F.col(at) >= F.timestamp_add("DAY", F.lit(-KEEP_DAYS[table]), now))


def replay(stored: DataFrame, pending: DataFrame, key: str, version: str) -> DataFrame:
    """Store after an outage: the queued rows, latest version per key."""
    return upsert(stored, pending, key, version)


# Alert rules (metric, comparison, limit, severity).
ALERTS = [("pipeline_completion_rate", "<", 0.95, "high", "HighPipelineAttrition"),
          ("record_gap", ">", 1000.0, "critical", "CriticalRecordGap"),
          ("pii_leak_count", ">", 0.0, "critical", "PIILeakageDetected"),
          ("content_corruption_rate", ">", 0.01, "high", "ContentCorruption")]


def alerts(metrics: DataFrame, rules: Sequence[tuple] = ALERTS) -> DataFrame:
    """Rules that fire for (metric, value) rows."""
    table = metrics.sparkSession.createDataFrame(
        list(rules), "metric string, op string, bound double, severity string, alert string")
    fires = F.when(F.col("op") == "<", F.col("value") < F.col("bound")).otherwise(
        F.col("value") > F.col("bound"))
    return metrics.join(F.broadcast(table), "metric").filter(fires).select(
        "alert", "severity", "metric", "value")


SALTS = 16


def records_in_intervals(records: DataFrame, at: str, intervals: DataFrame, start: str, end: str,
                         hours: int = 1) -> DataFrame:
    """Records inside any interval, with the interval's columns. An interval
    is spread over the hours it touches, so the join is on equal hours and no
    record meets an interval of another hour. A busy hour is ``SALTS`` keys by
    its records' times; the few intervals are repeated for each."""
    width = hours * 3600
    def slot(c: Column) -> Column:
        return F.floor(F.unix_micros(c.cast("timestamp")) / (width * 1_000_000))
    spread = intervals.withColumn("__slot", F.explode(F.sequence(slot(F.col(start)), slot(F.col(end)))))
    spread = spread.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    salt = F.pmod(F.xxhash64(at), F.lit(SALTS)).cast("int")
    return (records.withColumns({"__slot": slot(F.col(at)), "__salt": salt}).join(spread, ["__slot", "__salt"])
            .filter(F.col(at).between(F.col(start), F.col(end))).drop("__slot", "__salt"))


def latest_per_stage(lineage: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` newest records of each stage, for a report."""
    return top_n(lineage, ["current_stage"], [F.desc("created_at"), F.asc(key)], n, "rank", [key])
