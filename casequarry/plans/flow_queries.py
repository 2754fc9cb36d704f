"""Queries that write and read back: exports, staged hand-offs and streams.

They write under the session's checkpoint folder, which on a cluster is the
shared one, and read the given tables in full.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casequarry import schemas as S
from casequarry.functions import vectors as V
from casequarry.functions.pii_rules import STAGED
from casequarry.functions.text import query_length_bucket
from casequarry.operators import assemble as A
from casequarry.operators import monitor as M
from casequarry.operators import quality as Q
from casequarry.operators.compliance import clean_records
from casequarry.plans.pii_queries import SQL_COVER, TOKEN_SQL, sql_hits, with_table
from casequarry.plans.registry import ORACLE, query
from casequarry.plans.text_queries import sql_clean
from casequarry.session import checkpoint_dir, cut
from casequarry.skew import spread
from casequarry.sources import exports, sinks
from casequarry.streaming import alerts
from casequarry.streaming import streams as K

MIN = "yyyy-MM-dd HH:mm:ss"


def work_folder(t) -> str:
    return f"{checkpoint_dir(t.spark).rstrip('/')}/casequarry-{uuid.uuid4().hex}"


def export_cases(t):
    """Orders in the shape of the case export."""
    status = F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "O", "New").otherwise(
        F.col("o_orderstatus"))
    priority = F.when(F.col("o_orderpriority") == "1-URGENT", "Critical").when(
        F.col("o_orderpriority") == "5-LOW", "Low").otherwise(F.col("o_orderpriority"))
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("Id"), F.concat(F.lit("5000"), F.col("o_orderkey").cast("string"))
        .alias("CaseNumber"), F.col("o_custkey").cast("string").alias("AccountId"), status.alias("Status"),
        priority.alias("Priority"), F.lit("order").alias("Subject"), F.lit("text").alias("Description"))


@query("export_round_trip", """
SELECT CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'New' ELSE o_orderstatus END AS status, count(*) AS n,
  count(DISTINCT o_custkey) AS accounts FROM orders GROUP BY 1""")
def export_round_trip(t):
    """Envelope documents written and read back."""
    folder = work_folder(t)
    sinks.write_envelopes(export_cases(t), folder, "Id", 2000)
    back = exports.read_envelopes(t.spark, folder, S.TABLES["case"], lines=True)
    return back.groupBy(F.col("Status").alias("status")).agg(
        F.count("*").alias("n"), F.countDistinct("AccountId").alias("accounts"))


@query("export_quality_issues", """
SELECT 'case' AS "table", 'warning' AS severity, 'status' AS rule, 'case: Unexpected Status values: ' || o_orderstatus AS message,
  count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus
UNION ALL SELECT 'case', 'warning', 'priority', 'case: Unexpected Priority values: ' || o_orderpriority, count(*) FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') GROUP BY o_orderpriority""")
def export_quality_issues(t):
    return Q.quality_issues(export_cases(t), "case")


@query("export_verdicts", """
SELECT 'case' AS "table", 0 AS errors, count(DISTINCT o_orderpriority) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW'))
  + count(DISTINCT o_orderstatus) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS warnings, true AS valid FROM orders
UNION ALL SELECT 'task', 0, 1, true""")
def export_verdicts(t):
    tasks = t.lineitem.select(F.when(F.col("l_linestatus") == "F", "Plan of Action").otherwise("Call").alias("Type"),
                              F.lit("x").alias("Description"), F.col("l_orderkey").cast("string").alias("CaseId"))
    both = Q.quality_issues(export_cases(t), "case").unionByName(Q.quality_issues(tasks, "task"))
    return Q.verdicts(both, ["case", "task"])


@query("task_filter", """
SELECT count(*) AS tasks FROM lineitem WHERE l_linestatus = 'F'""")
def task_filter(t):
    tasks = t.lineitem.select(F.when(F.col("l_linestatus") == "F", "Plan of Action").otherwise("Call").alias("Type"))
    return exports.only_known_tasks(tasks).agg(F.count("*").alias("tasks"))


@query("backfill_periods", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(DISTINCT o_custkey) AS accounts, count(*) AS "rows"
FROM orders GROUP BY 1""")
def backfill_periods(t):
    """The whole history written in one job, one partition per month's first
    day, then read back by partition."""
    folder = work_folder(t)
    sinks.backfill(t.orders, folder, F.trunc("o_orderdate", "month"))
    back = t.spark.read.parquet(folder)
    return back.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.countDistinct("o_custkey").alias("accounts"), F.count("*").alias("rows"))


@query("collection_load", """
SELECT 'vectors' AS part, count(*) AS n FROM embeddings WHERE label <> 3
UNION ALL SELECT 'properties', count(*) FROM embeddings WHERE label <> 3
UNION ALL SELECT 'failed', count(*) FROM embeddings WHERE label = 3""")
def collection_load(t):
    folder = work_folder(t)
    rows = t.embeddings.withColumn("v", F.when(F.col("label") != 3, F.col("embedding"))).drop("embedding")
    sinks.load_batch(rows, folder, "v", "vec_id", 64)
    parts = [t.spark.read.parquet(f"{folder}/{p}").agg(F.count("*").alias("n")).select(F.lit(p).alias("part"), "n")
             for p in ("vectors", "properties", "failed")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Documents and turns as one set of texts, none from a table with rules of its own.
FLOW_TEXTS = """docs AS (SELECT doc_id * 2 AS doc_id, text FROM documents
  UNION ALL SELECT (conv_id * 1000 + turn) * 2 + 1, text FROM conversations)"""


@query("case_flow", f"""
WITH RECURSIVE {FLOW_TEXTS}, {sql_hits([r for r in STAGED if r.table is None])}, {SQL_COVER},
gaps AS (SELECT doc_id, type, start, stop,
  coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS before FROM merged),
built AS (SELECT g.doc_id, string_agg(substr(text, before + 1, start - before) || {TOKEN_SQL}, ''
    ORDER BY start) || substr(any_value(text), max(stop) + 1) AS clean
  FROM gaps g JOIN docs d ON d.doc_id = g.doc_id GROUP BY 1),
k AS (SELECT d.doc_id, coalesce(clean, text) AS text FROM docs d LEFT JOIN built b ON b.doc_id = d.doc_id),
c AS (SELECT conv_id, string_agg({sql_clean('k.text')}, ' | ' ORDER BY turn) AS s FROM conversations
  JOIN k ON k.doc_id = (conv_id * 1000 + turn) * 2 + 1 WHERE k.text <> '' GROUP BY 1),
j AS (SELECT concat_ws(chr(10) || chr(10), 'Case: ' || d.doc_id || ' | ' || source || ' | Status: ' || lang,
  CASE WHEN k.text <> '' THEN 'ISSUE: ' || {sql_clean('k.text')} END, 'COMMENTS: ' || c.s) AS s
  FROM documents d JOIN k ON k.doc_id = d.doc_id * 2 LEFT JOIN c ON c.conv_id = d.doc_id),
x AS (SELECT length(s) > 30000 AS was_truncated, CASE WHEN length(s) > 30000 THEN substr(substr(s, 1, 24000) || chr(10) || chr(10)
  || '[...TRUNCATED...]' || chr(10) || chr(10) || right(s, 6000), 1, 30000) ELSE s END AS s FROM j)
SELECT was_truncated, 'ok' AS outcome, count(*) AS cases, cast(sum(length(s)) AS BIGINT) AS characters,
  cast(sum(('0x' || substr(md5(s), 1, 8))::BIGINT) AS BIGINT) AS text_hash FROM x GROUP BY 1""")
def case_flow(t):
    """The whole flow: assemble, clean, compose, embed, check."""
    raw = t.documents.select("doc_id", F.col("doc_id").cast("string").alias("caseNumber"),
                             F.col("source").alias("subject"), F.col("lang").alias("status"),
                             F.col("text").alias("description"))
    cases = clean_records(raw, ["description"], merge="cover").drop(
        "pii_count", "pii_removed", "pii_types", "field_wise_counts")
    turns = clean_records(t.conversations, ["text"], merge="cover")
    comments = A.Child("casecomments", turns, "conv_id", {"commentBody": F.col("text")}, F.col("turn"))
    texts = A.composite_texts(cases, "doc_id", [comments])
    vectors = V.embed_distinct(texts, "compositeText", V.HashingEmbedder(256), 256)
    checked = sinks.load_check(vectors, "embedding", 256)
    return checked.groupBy("was_truncated", F.coalesce("error", F.lit("ok")).alias("outcome")).agg(
        F.count("*").alias("cases"), F.sum(F.length("compositeText")).alias("characters"),
        F.sum(F.conv(F.left(F.md5("compositeText"), F.lit(8)), 16, 10).cast("bigint")).alias("text_hash"))


# -- streams ----------------------------------------------------------------------

STORE = "spark.sql.streaming.stateStore.providerClass"


def event_stream(t):
    """The events table as a file stream; its times become zoned for the
    watermark."""
    schema = t.events.schema
    stream = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def finished(t, stream, mode: str):
    """Run to the end of the input and read what was written. In complete mode
    every batch holds all windows, so the last one counts."""
    folder = work_folder(t)
    writer = stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").outputMode(mode).trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", f"{folder}/out").start().awaitTermination()
        return t.spark.read.schema(stream.schema).parquet(f"{folder}/out")
    writer.foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(
        f"{folder}/out/batch={number:08d}")).start().awaitTermination()
    rows = t.spark.read.parquet(f"{folder}/out")
    last = rows.agg(F.max("batch")).scalar()
    return rows.filter(F.col("batch") == last).drop("batch")


@query("stream_tumbling_counts", """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_tumbling_counts(t):
    counts = M.window_counts(K.late(event_stream(t), "ts"), "ts", "1 hour", ["event_type"])
    return finished(t, counts, "complete").select(F.date_format("start", MIN).alias("start"), "event_type", "n")


@query("stream_error_rate", """
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n,
  count(*) FILTER (WHERE event_type = 'error') AS hits, round(count(*) FILTER (WHERE event_type = 'error')::DOUBLE / count(*), 6) AS ratio
FROM events GROUP BY 1""")
def stream_error_rate(t):
    ratio = K.error_rate(event_stream(t), "ts", "6 hours", F.col("event_type") == "error")
    return finished(t, ratio, "complete").select(
        F.date_format("start", MIN).alias("start"), "n", "hits", F.round("ratio", 6).alias("ratio"))


@query("stream_dedupe", """
SELECT event_type, count(*) AS n, cast(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1""")
def stream_dedupe(t):
    """Every event is sent twice and kept once."""
    twice = event_stream(t).unionByName(event_stream(t))
    once = K.deduplicated(twice, "ts", ["event_id"], "40 days")
    return finished(t, once, "append").groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("stream_outages", """
WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 7200 * 1000000::BIGINT
  THEN 1 ELSE 0 END AS fresh FROM events WHERE event_type = 'error' WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS events FROM s GROUP BY user_id, g""")
def stream_outages(t):
    errors = event_stream(t).filter(F.col("event_type") == "error")
    periods = K.outages(errors, "ts", "2 hours", ["user_id"])
    return finished(t, periods, "complete").select(
        "user_id", F.date_format("start", MIN).alias("start"), "events")


@query("stream_zero_results", """
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS start, CASE WHEN length(props) < 20 THEN 'short' WHEN length(props) < 50
  THEN 'medium' ELSE 'long' END AS bucket, count(*) AS n, count(*) FILTER (WHERE floor(value) = 0) AS hits FROM events GROUP BY 1, 2""")
def stream_zero_results(t):
    searches = event_stream(t).withColumn("results", F.floor("value"))
    rate = K.zero_result_rate(searches, "ts", "1 day", query_length_bucket(F.col("props")), "results")
    return finished(t, rate, "complete").select(F.date_format("start", "yyyy-MM-dd").alias("start"), "bucket", "n", "hits")


@query("stream_late_rows", """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_late_rows(t):
    """Windows written once they are closed: later events close them, and when
    the first ones come a second time they are too late to count."""
    folder, length = work_folder(t), "1 hour"
    events = t.events.select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    later = events.withColumn("ts", F.col("ts") + F.expr("interval 365 days"))
    for rows in (events, later, events):
        rows.write.mode("append").parquet(f"{folder}/in")
        stream = t.spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        counts = M.window_counts(K.late(stream, "ts"), "ts", length, ["event_type"])
        counts.writeStream.format("parquet").option("path", f"{folder}/out").option(
            "checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(
            availableNow=True).start().awaitTermination()
    last = events.agg(F.max("ts")).scalar()
    closed = t.spark.read.schema(counts.schema).parquet(f"{folder}/out").filter(F.col("start") <= last)
    return closed.select(F.date_format("start", MIN).alias("start"), "event_type", "n")


@query("stream_sustained_alert", """
WITH w AS (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, avg(CASE WHEN value > 20 THEN 1.0::DOUBLE ELSE 0 END) AS r
  FROM events GROUP BY 1, 2),
b AS (SELECT event_type, start, epoch(start) // 3600 - row_number() OVER (PARTITION BY event_type ORDER BY start) AS g FROM w WHERE r > 0.1)
SELECT event_type, strftime(min(start), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(start), '%Y-%m-%d %H:%M:%S') AS last, count(*) AS windows
FROM b GROUP BY event_type, g HAVING count(*) >= 3""")
def stream_sustained_alert(t):
    """Hourly windows arrive in three batches, odd hours before even ones of a batch; all come again, too late to count, with a last sign of
    life long after, so silence closes what is open."""
    folder, spark = work_folder(t), t.spark
    hours = M.window_ratio(t.events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", F.col("value") > 20, ["event_type"])
    hours = cut(hours.select("event_type", "start", (F.col("ratio") > 0.1).alias("bad")))
    part = F.floor(F.dayofmonth("start") / 11)
    late = hours.select("event_type", "start", F.lit(True).alias("bad"))
    end = hours.agg(F.max("start").alias("start")).select(F.lit("none").alias("event_type"), F.date_add("start", 365).cast("timestamp").alias("start"), F.lit(False).alias("bad"))
    keep = spark.conf.get(STORE, None)
    alerts.with_state_store(spark)
    try:
        for rows in (*(hours.filter(part == k).orderBy(F.hour("start") % 2 == 0) for k in range(3)), end, late):
            rows.write.mode("append").parquet(f"{folder}/in")
            stream = spark.readStream.schema(hours.schema).parquet(f"{folder}/in")
            runs = alerts.sustained_runs(stream, "event_type", "start", "bad", 3600, 3, "3 hours")
            runs.writeStream.format("parquet").option("path", f"{folder}/out").option(
                "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(STORE, keep) if keep else spark.conf.unset(STORE)
    return spark.read.schema(runs.schema).parquet(f"{folder}/out").select(
        "event_type", F.date_format("first", MIN).alias("first"), F.date_format("last", MIN).alias("last"), "windows")


@query("stream_clean_upsert", f"SELECT doc_id, md5(text) AS text_md5 FROM ({ORACLE['pii_redacted_cover']})")
def stream_clean_upsert(t):
    """Documents as change events: cleaned, split, merged into a snapshot. What
    snapshot and review queue hold together is compared text by text."""
    folder = work_folder(t)
    rows = with_table(t).select("doc_id", "text", "table", F.lit(1).alias("version"),
                                F.timestamp_seconds(F.col("doc_id") + 1_700_000_000).alias("at"))
    spread(rows).write.parquet(f"{folder}/in")
    stream = t.spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
    K.run_changes(stream, f"{folder}/store", f"{folder}/checkpoint", "doc_id", "version", "text",
                  "at", "table").awaitTermination()
    kept = t.spark.read.parquet(sinks.current_version(t.spark, f"{folder}/store/current"))
    review = t.spark.read.parquet(f"{folder}/store/review")
    return kept.select("doc_id", "text").unionByName(review.select("doc_id", "text")).select(
        "doc_id", F.md5("text").alias("text_md5"))
