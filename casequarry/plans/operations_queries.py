"""Reconciliation and monitoring queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casequarry.functions import text as T
from casequarry.functions.pii_rules import LEAK
from casequarry.operators import compliance as P
from casequarry.operators import digests as D
from casequarry.operators import monitor as M
from casequarry.operators import reconcile as J
from casequarry.operators import sketches as K
from casequarry.operators import sweeps as S
from casequarry.plans.registry import query
from casequarry.session import checkpoint_dir
from casequarry.skew import parted

FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def sum_sql(status: str = "o_orderstatus", alias: str = "") -> str:
    return (f"sha256('{{\"o_custkey\":\"' || {alias}o_custkey || '\",\"o_orderkey\":\"' || {alias}o_orderkey || "
            f"'\",\"o_orderpriority\":\"' || {alias}o_orderpriority || '\",\"o_orderstatus\":\"' || {status} || '\"}}')")


@query("record_checksum", f"SELECT o_orderkey, {sum_sql()} AS checksum FROM orders")
def record_checksum(t):
    return t.orders.select("o_orderkey", J.checksum(FIELDS).alias("checksum"))


def source_rows(t):
    return t.orders.withColumn("checksum", J.checksum(FIELDS))


def damaged(t):
    """A second store: some rows gone, some altered, some that have no source."""
    k = F.col("o_orderkey")
    kept = t.orders.filter(k % 97 != 0).withColumn("o_orderstatus", F.when(
        k % 89 == 0, F.concat(F.lit("x"), "o_orderstatus")).otherwise(F.col("o_orderstatus")))
    lost = t.orders.filter(k % 101 == 0).withColumn("o_orderkey", -k - 1)
    return kept.unionByName(lost).withColumn("checksum", J.checksum(FIELDS))


RECONCILE_SQL = f"""
WITH a AS (SELECT o_orderkey, {sum_sql()} AS c,
  CASE o_orderkey % 3 WHEN 0 THEN {sum_sql()} WHEN 1 THEN {sum_sql("'x' || o_orderstatus")} ELSE 'none' END AS r FROM orders),
b AS (SELECT o_orderkey, {sum_sql("CASE WHEN o_orderkey % 89 = 0 THEN 'x' || o_orderstatus ELSE o_orderstatus END")} AS c
    FROM orders WHERE o_orderkey % 97 <> 0
  UNION ALL SELECT -o_orderkey - 1, 'orphan' FROM orders WHERE o_orderkey % 101 = 0),
o AS (SELECT CASE WHEN b.c IS NULL THEN 'MISSING' WHEN a.c IS NULL THEN 'ORPHANED' WHEN a.c = b.c THEN 'MATCH'
  WHEN a.r = a.c THEN 'STALE' WHEN a.r = b.c THEN 'SOURCE_NEWER' ELSE 'CORRUPT' END AS outcome
  FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT outcome, count(*) AS n FROM o GROUP BY 1"""


@query("checksum_reconcile", RECONCILE_SQL)
def checksum_reconcile(t):
    return J.compare_stores(recomputed(t), damaged(t), "o_orderkey", t.orders.count()).groupBy("outcome").agg(F.count("*").alias("n"))


def recomputed(t):
    k = F.col("o_orderkey") % 3
    source = source_rows(t)
    altered = t.orders.withColumn("o_orderstatus", F.concat(F.lit("x"), "o_orderstatus")).select(
        "o_orderkey", J.checksum(FIELDS).alias("other"))
    rows = t.orders.count()
    return parted(source, rows, "o_orderkey").join(parted(altered, rows, "o_orderkey"), "o_orderkey").withColumn("recomputed", F.when(
        k == 0, F.col("checksum")).when(k == 1, F.col("other")).otherwise("none"))


def stored_digests(t, store, name):
    """Digests as a store keeps them: written, and read again."""
    folder = f"{checkpoint_dir(t.spark)}/digests-{uuid.uuid4().hex}/{name}"
    D.write(D.digests(store, "o_orderkey", depth=3), folder)
    return D.read(t.spark, folder)


@query("digest_reconcile", RECONCILE_SQL)
def digest_reconcile(t):
    """The same outcomes; only rows of differing leaves are joined."""
    source, stored = recomputed(t), damaged(t)
    trees = [stored_digests(t, x, n) for x, n in ((source, "source"), (stored, "stored"))]
    return D.compare(source, stored, "o_orderkey", *trees).groupBy("outcome").agg(F.count("*").alias("n"))


@query("digest_equal_stores", "SELECT o_orderkey, 'MATCH' AS outcome FROM orders")
def digest_equal_stores(t):
    """Equal stores: digests alone decide, no row is joined or shuffled."""
    source = source_rows(t).withColumn("recomputed", F.col("checksum"))
    tree = stored_digests(t, source, "source")
    return D.compare(source, source_rows(t), "o_orderkey", tree, stored_digests(t, source_rows(t), "stored"))


@query("digest_few_changes", """
SELECT CASE WHEN o_custkey = 1 THEN 'STALE' ELSE 'MATCH' END AS outcome, count(*) AS n FROM orders
WHERE o_orderkey >= 0 GROUP BY 1 UNION ALL SELECT 'ORPHANED', count(*) FROM nation""")
def digest_few_changes(t):
    """One customer's orders changed and some rows came: the store's digests follow by what changed, equal leaves are counted only."""
    source = source_rows(t).withColumn("recomputed", F.col("checksum"))
    before = source_rows(t).select("o_orderkey", "o_custkey", "checksum")
    old = before.filter("o_custkey = 1")
    new = old.withColumn("checksum", F.lit("other")).unionByName(t.nation.select(
        (-1 - F.col("n_nationkey")).alias("o_orderkey"), F.lit(0).cast("long").alias("o_custkey"), F.lit("orphan").alias("checksum")))
    stored = before.filter("o_custkey != 1").unionByName(new)
    tree = D.updated(stored_digests(t, before, "before"), old, new, "o_orderkey")
    return D.outcome_counts(source, stored, "o_orderkey", stored_digests(t, source, "source"), tree)


@query("mismatch_level", """
WITH s AS (SELECT count(*) + count(*) FILTER (WHERE o_orderkey % 101 = 0) AS total,
  count(*) FILTER (WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0) AS same FROM orders)
SELECT total, round(1 - same::DOUBLE / total, 6) AS mismatch_rate,
  CASE WHEN 1 - same::DOUBLE / total > 0.05 THEN 'critical' WHEN 1 - same::DOUBLE / total > 0.01 THEN 'warning'
  ELSE 'info' END AS level FROM s""")
def mismatch_level(t):
    source = source_rows(t).withColumn("recomputed", F.col("checksum"))
    return J.mismatch_level(J.compare_stores(source, damaged(t), "o_orderkey")).withColumn(
        "mismatch_rate", F.round("mismatch_rate", 6))


LINEAGE_SQL = """
lineage AS (SELECT o_orderkey, ['extracted', 'pii_removed', 'embedding_generated', 'weaviate_loaded', 'weaviate_loaded']
    [cast(substr(o_orderpriority, 1, 1) AS INTEGER)] AS current_stage,
  CASE WHEN o_orderpriority[1] IN ('4', '5') AND o_orderstatus <> 'P' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'failed'
  ELSE 'in_progress' END AS status, o_orderdate AS created_at FROM orders WHERE o_orderkey % 53 <> 0)"""


def lineage(t):
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    stages = F.array(*[F.lit(s) for s in [*J.STAGES, J.STAGES[-1]]])
    done = (number >= 4) & (F.col("o_orderstatus") != "P")
    return t.orders.filter(F.col("o_orderkey") % 53 != 0).select(
        "o_orderkey", F.element_at(stages, number).alias("current_stage"),
        F.when(done, "completed").when(F.col("o_orderstatus") == "P", "failed").otherwise("in_progress")
        .alias("status"), J.checksum(FIELDS).alias("checksum"), F.col("o_orderdate").alias("created_at"))


@query("change_classes", f"""
WITH {LINEAGE_SQL},
c AS (SELECT CASE WHEN l.o_orderkey IS NULL THEN 'new' WHEN o.o_orderkey % 7 = 0 THEN 'changed'
  WHEN status <> 'completed' THEN 'retry' ELSE 'unchanged' END AS change
  FROM orders o LEFT JOIN lineage l ON l.o_orderkey = o.o_orderkey)
SELECT change, count(*) AS n FROM c GROUP BY 1""")
def change_classes(t):
    now = t.orders.withColumn("o_orderstatus", F.when(
        F.col("o_orderkey") % 7 == 0, "Z").otherwise(F.col("o_orderstatus")))
    records = now.select("o_orderkey", J.checksum(FIELDS).alias("checksum"))
    return J.classify(records, lineage(t), "o_orderkey").groupBy("change").agg(F.count("*").alias("n"))


@query("incremental_work", f"""
WITH {LINEAGE_SQL}
SELECT o.o_orderkey FROM orders o LEFT JOIN lineage l ON l.o_orderkey = o.o_orderkey AND status = 'completed'
WHERE l.o_orderkey IS NULL""")
def incremental_work(t):
    return J.to_process(source_rows(t), lineage(t), "o_orderkey").select("o_orderkey")


@query("lineage_advance", f"""
WITH {LINEAGE_SQL},
u AS (SELECT o_orderkey, current_stage, status FROM lineage WHERE o_orderkey % 10 <> 0
  UNION ALL SELECT o_orderkey, 'weaviate_loaded', 'completed' FROM orders WHERE o_orderkey % 10 = 0)
SELECT current_stage, status, count(*) AS n FROM u GROUP BY 1, 2""")
def lineage_advance(t):
    old = lineage(t).select("o_orderkey", "current_stage", "status", "checksum", F.lit(0).alias("retry_count"),
                            F.col("created_at").alias("updated_at"))
    done = source_rows(t).filter(F.col("o_orderkey") % 10 == 0)
    at = F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")
    return J.stage_counts(J.advance(old, done, "o_orderkey", J.STAGES[-1], at, "completed"))


@query("stage_counts", f"WITH {LINEAGE_SQL} SELECT current_stage, status, count(*) AS n FROM lineage GROUP BY 1, 2")
def stage_counts(t):
    return J.stage_counts(lineage(t))


@query("stage_gap_report", f"""
WITH {LINEAGE_SQL},
c AS (SELECT (SELECT count(*) FROM orders) AS s, count(*) AS tr, count(*) FILTER (WHERE current_stage = 'weaviate_loaded'
  AND status = 'completed') AS d, (SELECT count(*) FROM orders WHERE o_orderkey % 97 <> 0)
  + (SELECT count(*) FROM orders WHERE o_orderkey % 101 = 0) AS a FROM lineage)
SELECT 'staging_to_lineage_gap' AS type, s::DOUBLE AS expected, tr::DOUBLE AS actual, s - tr AS gap,
  CASE WHEN s - tr > 100 THEN 'high' ELSE 'medium' END AS severity FROM c WHERE s <> tr
UNION ALL SELECT 'pipeline_attrition', 0.95, round(d::DOUBLE / tr, 6), tr - d, 'high' FROM c WHERE d::DOUBLE / tr < 0.95
UNION ALL SELECT 'weaviate_lineage_mismatch', d, a, d - a, CASE WHEN abs(d - a) > 1000 THEN 'critical' ELSE 'medium' END
  FROM c WHERE d <> a""")
def stage_gap_report(t):
    return J.discrepancies(t.orders, lineage(t), damaged(t))


@query("layer_gaps", f"""
WITH {LINEAGE_SQL},
l AS (SELECT 1 AS position, 'source' AS layer, count(*) AS n FROM orders
  UNION ALL SELECT 2, 'tracked', count(*) FROM lineage
  UNION ALL SELECT 3, 'loaded', count(*) FROM lineage WHERE status = 'completed')
SELECT position, layer, n, coalesce(lag(n) OVER (ORDER BY position) - n, 0) AS gap,
  round(coalesce(n::DOUBLE / lag(n) OVER (ORDER BY position), 1), 6) AS rate FROM l""")
def layer_gaps(t):
    def layer(i, name, df):
        return df.agg(F.count("*").alias("n")).select(F.lit(i).alias("position"), F.lit(name).alias("layer"), "n")
    rows = lineage(t)
    layers = layer(1, "source", t.orders).unionByName(layer(2, "tracked", rows)).unionByName(
        layer(3, "loaded", rows.filter(F.col("status") == "completed")))
    return J.layer_gaps(layers).withColumn("rate", F.round("rate", 6))


@query("run_summary", f"""
WITH {LINEAGE_SQL}
SELECT 'run-1' AS run_id, (SELECT count(*) FROM orders) AS source_count, count(*) AS staging_count,
  count(*) FILTER (WHERE current_stage IN ('embedding_generated', 'weaviate_loaded')) AS transformed_count,
  (SELECT count(*) FROM orders WHERE o_orderkey % 97 <> 0) + (SELECT count(*) FROM orders WHERE o_orderkey % 101 = 0)
    AS weaviate_count, 3 AS discrepancies_found FROM lineage""")
def run_summary(t):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return J.run_summary("run-1", "daily", at, at, t.orders, lineage(t), damaged(t)).select(
        "run_id", "source_count", "staging_count", "transformed_count", "weaviate_count", "discrepancies_found")


@query("stuck_records", f"""
WITH {LINEAGE_SQL}
SELECT o_orderkey, current_stage FROM lineage WHERE status <> 'completed' AND created_at < TIMESTAMP '1999-12-31 00:00:00'""")
def stuck_records(t):
    now = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    return J.stuck(lineage(t), now).select("o_orderkey", "current_stage")


ROUTE_SQL = f"""{LINEAGE_SQL},
r AS (SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'not_found' WHEN current_stage IN ('extracted', 'pii_removed') THEN 'reclean'
  WHEN current_stage = 'embedding_generated' THEN 'load_only' ELSE 'none' END AS route FROM lineage WHERE status <> 'completed')"""


def routed(t):
    staged = t.orders.filter(F.col("o_orderkey") % 97 != 0)
    return J.recovery_routes(lineage(t).filter(F.col("status") != "completed"), staged, "o_orderkey")


@query("recovery_routes", f"WITH {ROUTE_SQL} SELECT route, count(*) AS n FROM r GROUP BY 1")
def recovery_routes(t):
    return routed(t).groupBy("route").agg(F.count("*").alias("n"))


@query("recovery_outcome", f"""
WITH {ROUTE_SQL.replace("SELECT CASE WHEN o_orderkey % 97", "SELECT o_orderkey, CASE WHEN o_orderkey % 97")},
d AS (SELECT route, CASE WHEN route = 'reclean' THEN o_totalprice >= 50000 ELSE o_orderstatus <> 'P' END AS ok
  FROM r JOIN orders USING (o_orderkey))
SELECT count(*) AS attempted, count(*) FILTER (WHERE route IN ('reclean', 'load_only') AND ok) AS recovered_count,
  count(*) FILTER (WHERE route = 'not_found' OR (route IN ('reclean', 'load_only') AND NOT ok)) AS failed_count FROM d""")
def recovery_outcome(t):
    """Small orders fail the cleaning flow again, pending ones the load."""
    staged = t.orders.filter(F.col("o_orderkey") % 97 != 0)
    work = {"reclean": lambda rows: rows.select("o_orderkey", F.when(F.col("o_totalprice") < 50000, "not clean").alias("error")),
            "load_only": lambda rows: rows.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "not loaded").alias("error"))}
    return J.recovery_outcome(J.rerun(routed(t), staged, "o_orderkey", work))


@query("retry_schedule", """
SELECT o_orderkey, CASE WHEN o_custkey % 5 < 3 THEN 'retry' ELSE 'manual' END AS queue,
  CASE WHEN o_custkey % 5 < 3 THEN strftime(o_orderdate + to_minutes(cast(pow(2, o_custkey % 5 + 1) AS INTEGER)), '%Y-%m-%d %H:%M')
  ELSE 'none' END AS next_at FROM orders WHERE o_orderstatus = 'P'""")
def retry_schedule(t):
    failed = t.orders.filter(F.col("o_orderstatus") == "P").withColumn(
        "retry_count", (F.col("o_custkey") % 5).cast("int"))
    return J.retry_schedule(failed, "o_orderdate").select("o_orderkey", "queue", F.coalesce(
        F.date_format("next_at", "yyyy-MM-dd HH:mm"), F.lit("none")).alias("next_at"))


INTEGRITY_SQL = """
i AS (SELECT d.doc_id, NOT (d.doc_id % 97 = 0 OR d.doc_id % 89 = 0 OR regexp_matches(text,
  '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Z|a-z]{2,}\\b')) AS ok FROM documents d)"""


def integrity(t, sample=None):
    stored = t.documents.filter(F.col("doc_id") % 97 != 0).withColumn(
        "lang", F.when(F.col("doc_id") % 89 == 0, "xx").otherwise(F.col("lang")))
    return J.content_integrity(t.documents.drop("text"), stored, "doc_id", "text", ["lang", "source"], sample,
                               classes="ascii")


@query("content_integrity", f"""
WITH {INTEGRITY_SQL}
SELECT count(*) AS sample_size, count(*) FILTER (WHERE NOT ok) AS corrupted_count,
  round(count(*) FILTER (WHERE NOT ok)::DOUBLE / count(*), 6) AS corruption_rate FROM i""")
def content_integrity(t):
    return integrity(t).withColumn("corruption_rate", F.round("corruption_rate", 6))


@query("weekly_check", f"""
WITH {INTEGRITY_SQL}
SELECT 'count_discrepancy' AS type, 3 AS n, 'high' AS severity
UNION ALL SELECT 'content_corruption', count(*) FILTER (WHERE NOT ok), 'high' FROM i HAVING count(*) FILTER (WHERE NOT ok) > 10
UNION ALL SELECT 'embedding_dimension_error', count(*), 'medium' FROM embeddings WHERE label = 0
UNION ALL SELECT 'pii_leakage', count(*), 'critical' FROM documents WHERE
  {' OR '.join("regexp_matches(text, '" + r.regex + "')" for r in LEAK)}""")
def weekly_check(t):
    short = t.embeddings.withColumn("v", F.when(F.col("label") == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")))
    leaks = P.zero_leak_scan(t.documents, "doc_id", "text", rules=LEAK, classes="ascii")
    return J.weekly_issues(J.discrepancies(t.orders, lineage(t), damaged(t)), integrity(t), short, "v", 64, leaks)


@query("top_failures", """
SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1 ORDER BY n DESC, user_id LIMIT 10""")
def top_failures(t):
    return J.top_failures(t.events.filter(F.col("event_type") == "error"), "user_id")


@query("stage_durations", """
SELECT round(avg(epoch(l_shipdate) - epoch(o_orderdate)), 4) AS created_to_shipped, count(*) AS resolved,
  round(avg(epoch(l_shipdate) - epoch(o_orderdate)), 4) AS mttr_seconds
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def stage_durations(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderdate").alias("created"), F.col("l_shipdate").alias("shipped"))
    both = J.mean_time_to_recovery(rows, "created", "shipped")
    gap = J.stage_durations(rows, ["created", "shipped"])
    return both.select("resolved", F.round("mttr_seconds", 4).alias("mttr_seconds"),
                       F.round(gap.scalar(), 4).alias("created_to_shipped"))


@query("retained_records", """
SELECT count(*) AS kept FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-15' - INTERVAL 90 DAY""")
def retained_records(t):
    now = F.lit("2000-06-15 00:00:00").cast("timestamp_ntz")
    return J.retained(t.orders, "failed_records", "o_orderdate", now).agg(F.count("*").alias("kept"))


@query("queue_replay", """
WITH a AS (SELECT l_orderkey AS k, max(l_linenumber) AS v FROM lineitem GROUP BY 1)
SELECT o_orderkey, greatest(coalesce(v, 0), 0) AS version FROM orders LEFT JOIN a ON k = o_orderkey
UNION ALL SELECT k, v FROM a WHERE k NOT IN (SELECT o_orderkey FROM orders)""")
def queue_replay(t):
    stored = t.orders.select("o_orderkey", F.lit(0).alias("version"))
    pending = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("version"))
    return J.replay(stored, pending, "o_orderkey", "version").select("o_orderkey", "version")


@query("alert_rules", """
WITH m AS (SELECT 'pipeline_completion_rate' AS metric, avg(CASE WHEN o_orderstatus <> 'P' THEN 1.0::DOUBLE ELSE 0 END) AS value
    FROM orders UNION ALL SELECT 'record_gap', count(*) FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT 'pii_leak_count', count(*) FROM documents WHERE contains(text, '@'))
SELECT CASE metric WHEN 'pipeline_completion_rate' THEN 'HighPipelineAttrition' WHEN 'record_gap' THEN 'CriticalRecordGap'
  ELSE 'PIILeakageDetected' END AS alert, CASE metric WHEN 'pipeline_completion_rate' THEN 'high' ELSE 'critical' END AS severity,
  metric, round(value, 6) AS value FROM m WHERE (metric = 'pipeline_completion_rate' AND value < 0.95)
  OR (metric = 'record_gap' AND value > 1000) OR (metric = 'pii_leak_count' AND value > 0)""")
def alert_rules(t):
    failed = F.col("o_orderstatus") == "P"
    both = t.orders.agg(F.avg(F.when(failed, 0.0).otherwise(1.0)).alias("r"),
                        F.count_if(failed).cast("double").alias("g"))
    leaks = t.documents.agg(F.count_if(F.contains("text", F.lit("@"))).cast("double")).scalar()
    rows = both.select(F.inline(F.array(
        F.struct(F.lit("pipeline_completion_rate").alias("metric"), F.col("r").alias("value")),
        F.struct(F.lit("record_gap").alias("metric"), F.col("g").alias("value")),
        F.struct(F.lit("pii_leak_count").alias("metric"), leaks.alias("value")))))
    return J.alerts(rows).withColumn("value", F.round("value", 6))


OUTAGE_SQL = """
e AS (SELECT ts, CASE WHEN lag(ts) OVER (ORDER BY ts) IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts)) > 1800 * 1000000
  THEN 1 ELSE 0 END AS fresh FROM events WHERE event_type = 'error'),
s AS (SELECT ts, sum(fresh) OVER (ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM e),
o AS (SELECT min(ts) AS start, max(ts) AS last, count(*) AS events FROM s GROUP BY g)"""
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def outage_table(t):
    return M.sessions(t.events.filter(F.col("event_type") == "error"), "ts", 1800)


@query("outage_sessions", f"""
WITH {OUTAGE_SQL} SELECT strftime(start, '%Y-%m-%d %H:%M:%S.%f') AS start, strftime(last, '%Y-%m-%d %H:%M:%S.%f') AS last,
  events FROM o""")
def outage_sessions(t):
    return outage_table(t).select(F.date_format("start", STAMP).alias("start"),
                                  F.date_format("last", STAMP).alias("last"), "events")


@query("outage_sessions_by_user", """
WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 7200 * 1000000::BIGINT
  THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS start, count(*) AS events FROM s GROUP BY user_id, g""")
def outage_sessions_by_user(t):
    return M.sessions(t.events, "ts", 7200, ["user_id"]).select(
        "user_id", F.date_format("start", STAMP).alias("start"), "events")


@query("outage_range_join", f"""
WITH {OUTAGE_SQL}
SELECT event_type, count(*) AS n FROM events JOIN o ON ts BETWEEN start AND last WHERE events > 1 GROUP BY 1""")
def outage_range_join(t):
    outages = outage_table(t).filter(F.col("events") > 1).select(
        F.col("start").cast("timestamp_ntz").alias("start"), F.col("last").cast("timestamp_ntz").alias("last"))
    inside = J.records_in_intervals(t.events, "ts", outages, "start", "last")
    return inside.groupBy("event_type").agg(F.count("*").alias("n"))


@query("outage_sweep_join", f"""
WITH {OUTAGE_SQL}
SELECT event_type, count(*) AS n FROM events JOIN o ON ts BETWEEN start AND last WHERE events > 1 GROUP BY 1""")
def outage_sweep_join(t):
    """The same by a sweep over ranges of some 10,000 events; a long outage is a row per range."""
    outages = outage_table(t).filter(F.col("events") > 1).select(
        F.col("start").cast("timestamp_ntz").alias("start"), F.col("last").cast("timestamp_ntz").alias("last"))
    return S.records_in_intervals(t.events, "ts", outages, "start", "last", 10_000).groupBy("event_type").agg(F.count("*").alias("n"))


@query("reprocess_fallback_rows", f"""
WITH {OUTAGE_SQL}
SELECT event_id FROM events JOIN o ON ts BETWEEN start AND last WHERE events > 1 AND event_type = 'purchase'""")
def reprocess_fallback_rows(t):
    """Rows made by the fallback provider during an outage, to embed again."""
    outages = outage_table(t).filter(F.col("events") > 1).select(
        F.col("start").cast("timestamp_ntz").alias("start"), F.col("last").cast("timestamp_ntz").alias("last"))
    fallback = t.events.filter(F.col("event_type") == "purchase")
    return J.records_in_intervals(fallback, "ts", outages, "start", "last").select("event_id")


MIN = "yyyy-MM-dd HH:mm:ss"


@query("sliding_error_rate", """
WITH w AS (SELECT event_type, epoch_us(ts) // 30000000 AS slot FROM events),
x AS (SELECT event_type, slot - i AS s FROM w, (SELECT unnest(range(10)) AS i))
SELECT strftime(make_timestamp(s * 30000000), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n,
  round(count(*) / 300.0::DOUBLE, 6) AS rate FROM x GROUP BY s, event_type""")
def sliding_error_rate(t):
    out = M.sliding_rate(t.events, "ts", 300, 30, ["event_type"])
    return out.select(F.date_format("start", MIN).alias("start"), "event_type", "n", F.round("rate", 6).alias("rate"))


@query("tumbling_counts", """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n
FROM events GROUP BY 1, 2""")
def tumbling_counts(t):
    return M.window_counts(t.events, "ts", "1 hour", ["event_type"]).select(
        F.date_format("start", MIN).alias("start"), "event_type", "n")


@query("window_failure_ratio", """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n,
  count(*) FILTER (WHERE event_type = 'error') AS hits,
  round(count(*) FILTER (WHERE event_type = 'error')::DOUBLE / count(*), 6) AS ratio FROM events GROUP BY 1""")
def window_failure_ratio(t):
    return M.window_ratio(t.events, "ts", "1 hour", F.col("event_type") == "error").select(
        F.date_format("start", MIN).alias("start"), "n", "hits", F.round("ratio", 6).alias("ratio"))


@query("p95_by_window", """
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1""")
def p95_by_window(t):
    return M.window_percentiles(t.events, "ts", "6 hours", "value").select(
        F.date_format("start", MIN).alias("start"), *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


@query("latency_histogram", """
WITH b AS (SELECT unnest([1.0, 5.0, 10.0, 50.0, 100.0])::DOUBLE AS le)
SELECT event_type, cast(le AS VARCHAR) AS le, count(*) FILTER (WHERE value <= le) AS n FROM events, b GROUP BY 1, 2
UNION ALL SELECT event_type, '+Inf', count(*) FROM events GROUP BY 1""")
def latency_histogram(t):
    return M.histogram(t.events, "value", [1, 5, 10, 50, 100], ["event_type"])


@query("histogram_quantile", """
WITH b AS (SELECT unnest([0, 1, 5, 10, 50, 100])::DOUBLE AS lo, unnest([1, 5, 10, 50, 100, 1e18])::DOUBLE AS hi),
c AS (SELECT event_type, lo, hi, CASE WHEN lo > 0 THEN count(*) FILTER (WHERE value <= lo) ELSE 0 END AS below,
  count(*) FILTER (WHERE value <= hi) AS n, count(*) AS total FROM events, b GROUP BY event_type, lo, hi),
f AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY hi) AS i FROM c WHERE n >= total * 0.9::DOUBLE)
SELECT event_type, round(CASE WHEN hi > 1e17 THEN lo ELSE lo + (hi - lo) * (total * 0.9::DOUBLE - below) / (n - below) END, 6)
  AS quantile FROM f WHERE i = 1""")
def histogram_quantile(t):
    cells = M.histogram(t.events, "value", [1, 5, 10, 50, 100], ["event_type"])
    return M.histogram_quantile(cells, 0.9, ["event_type"]).withColumn("quantile", F.round("quantile", 6))


@query("sustained_alert", """
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, avg(CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0 END) AS r
  FROM events GROUP BY 1),
b AS (SELECT start, epoch(start) // 3600 - row_number() OVER (ORDER BY start) AS g FROM w WHERE r > 0.15)
SELECT strftime(min(start), '%Y-%m-%d %H:%M:%S') AS first, strftime(max(start), '%Y-%m-%d %H:%M:%S') AS last, count(*) AS windows
FROM b GROUP BY g HAVING count(*) >= 3""")
def sustained_alert(t):
    hours = M.window_ratio(t.events, "ts", "1 hour", F.col("event_type") == "error")
    runs = M.sustained(hours, "start", F.col("ratio") > 0.15, 3600, 3)
    return runs.select(F.date_format("first", MIN).alias("first"), F.date_format("last", MIN).alias("last"), "windows")


@query("source_error_rate", """
SELECT 'k' || cast(json_extract(props, '$.k') AS INTEGER) % 10 AS source, count(*) AS n,
  count(*) FILTER (WHERE event_type = 'error') AS errors,
  round(count(*) FILTER (WHERE event_type = 'error')::DOUBLE / count(*), 6) AS error_rate FROM events GROUP BY 1""")
def source_error_rate(t):
    k = F.get_json_object("props", "$.k").cast("int") % 10
    bad = F.col("event_type") == "error"
    return t.events.groupBy(F.concat(F.lit("k"), k).alias("source")).agg(
        F.count("*").alias("n"), F.count_if(bad).alias("errors"),
        F.round(F.count_if(bad) / F.count("*"), 6).alias("error_rate"))


@query("top_errors", """
WITH c AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS d, 'k' || cast(json_extract(props, '$.k') AS INTEGER) AS kind, count(*) AS n
  FROM events WHERE event_type = 'error' GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY n DESC, kind) AS rank FROM c)
SELECT strftime(d, '%Y-%m-%d %H:%M:%S') AS start, kind, n, rank FROM r WHERE rank <= 10""")
def top_errors(t):
    rows = t.events.filter(F.col("event_type") == "error").withColumn(
        "kind", F.concat(F.lit("k"), F.get_json_object("props", "$.k")))
    return M.top_per_window(rows, "ts", "1 day", "kind").withColumn("start", F.date_format("start", MIN))


@query("processing_rate", """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, round(count(*) / 60.0::DOUBLE, 6) AS per_minute,
  count(*) / 60.0 < 0.2 AS low FROM events GROUP BY 1""")
def processing_rate(t):
    return M.processing_rate(t.events, "ts", 60, 0.2).select(
        F.date_format("start", MIN).alias("start"), F.round("per_minute", 6).alias("per_minute"), "low")


@query("spike_test", """
WITH d AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS d, event_type, count(*) AS n FROM events GROUP BY 1, 2),
l AS (SELECT *, lag(n) OVER (PARTITION BY event_type ORDER BY d) AS b FROM d)
SELECT strftime(d, '%Y-%m-%d %H:%M:%S') AS start, event_type, n, round((n - b)::DOUBLE / b, 6) AS change FROM l
WHERE (n - b)::DOUBLE / b > 0.10""")
def spike_test(t):
    days = M.window_counts(t.events, "ts", "1 day", ["event_type"])
    return M.spikes(days, "start", "n", ["event_type"]).select(
        F.date_format("start", MIN).alias("start"), "event_type", "n", F.round("change", 6).alias("change"))


@query("zero_result_rate", """
SELECT CASE WHEN length(text) < 20 THEN 'short' WHEN length(text) < 50 THEN 'medium' ELSE 'long' END AS bucket,
  count(*) AS n, count(*) FILTER (WHERE NOT contains(text, 'ouen')) AS hits FROM documents GROUP BY 1""")
def zero_result_rate(t):
    return t.documents.groupBy(T.query_length_bucket(F.col("text")).alias("bucket")).agg(
        F.count("*").alias("n"), F.count_if(~F.contains("text", F.lit("ouen"))).alias("hits"))


@query("latest_gauge", """
WITH m AS (SELECT user_id, max(ts) AS ts FROM events GROUP BY 1)
SELECT e.user_id, max(value) AS value, max(value) < 20 AS low FROM events e JOIN m ON m.user_id = e.user_id AND m.ts = e.ts GROUP BY 1""")
def latest_gauge(t):
    return M.latest_gauge(t.events, "user_id", "ts", "value", 20.0)


# -- mergeable sketches ----------------------------------------------------------------

@query("sketch_percentiles", """
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n,
  unnest([true, true, true]) AS within, unnest(['p50', 'p95', 'p99']) AS point FROM events GROUP BY 1, 2""")
def sketch_percentiles(t):
    """Minutes merged to six hours; each percentile's exact rank must be within 2 % of the wanted one."""
    minutes = K.quantile_sketches(t.events, "ts", "value", ["event_type"])
    folder = f"{checkpoint_dir(t.spark)}/sketches-{uuid.uuid4().hex}"
    K.append(minutes, folder, 0)
    found = K.percentiles(K.merged_quantiles(K.stored(t.spark, folder), "6 hours", ["event_type"]))
    points = F.explode(F.array(*(F.struct(F.lit(n).alias("point"), F.lit(p).alias("p"), F.col(n).alias("q")) for n, p in K.POINTS.items())))
    wide = found.select("start", "event_type", "n", points.alias("x")).select("start", "event_type", "n", "x.*")
    events = t.events.select(F.window("ts", "6 hours").start.alias("start"), "event_type", "value")
    ranks = events.join(wide, ["start", "event_type"]).groupBy("start", "event_type", "n", "point", "p").agg(
        F.count_if(F.col("value") < F.col("q")).alias("below"), F.count_if(F.col("value") <= F.col("q")).alias("upto"), F.count("*").alias("all"))
    # The value's ranks reach from ``below`` to ``upto`` where values repeat.
    near = (F.col("below") <= (F.col("p") + 0.02) * F.col("n") + 1) & (F.col("upto") >= (F.col("p") - 0.02) * F.col("n") - 1)
    return ranks.select(F.date_format("start", MIN).alias("start"), "event_type", "n", (near & (F.col("all") == F.col("n"))).alias("within"), "point")


@query("sketch_weekly_users", """
WITH d AS (SELECT DISTINCT ts::DATE AS day, user_id FROM events),
w AS (SELECT DISTINCT day FROM d),
c AS (SELECT w.day, count(DISTINCT user_id) AS exact FROM w JOIN d ON d.day BETWEEN w.day - 6 AND w.day GROUP BY 1),
n AS (SELECT w.day, count(*) AS n FROM w JOIN events e ON e.ts::DATE BETWEEN w.day - 6 AND w.day WHERE user_id IS NOT NULL GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS day, n, exact, true AS within FROM c JOIN n USING (day)""")
def sketch_weekly_users(t):
    """Distinct users per sliding week from one sketch a day, within 2 % of the exact count."""
    weekly = K.sliding_distinct(K.distinct_sketches(t.events, "ts", "user_id"), 7)
    last = t.events.agg(F.max(F.to_date("ts"))).scalar()
    each = t.events.filter("user_id is not null").select(F.to_date("ts").alias("d"), "user_id").distinct()
    exact = each.select(F.explode(F.sequence(F.col("d"), F.least(F.date_add("d", 6), last))).alias("day"), "user_id").distinct().groupBy("day").agg(
        F.count("*").alias("exact"))
    return weekly.join(exact, "day").select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n", "exact", (
        F.abs(F.col("users") - F.col("exact")) <= F.greatest(0.02 * F.col("exact"), F.lit(1))).alias("within"))
