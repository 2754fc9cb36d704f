"""Source, sink and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casequarry.functions import enrich as E
from casequarry.functions import vectors as V
from casequarry.operators import assemble as A
from casequarry.operators import quality as Q
from casequarry.plans.registry import query
from casequarry.plans.text_queries import dated_cases
from casequarry.sources import exports, sinks


@query("required_nulls", """
SELECT field, nulls, rows FROM (
  SELECT 'o_orderkey' AS field, count(*) FILTER (WHERE o_orderkey IS NULL) AS nulls, count(*) AS rows FROM orders
  UNION ALL SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL), count(*) FROM orders
  UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL), count(*) FROM orders)""")
def required_nulls(t):
    return Q.null_counts(t.orders, ["o_orderkey", "o_custkey", "o_orderstatus"])


@query("dup_keys", """
SELECT l_orderkey, count(*) - 1 AS repeats FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def dup_keys(t):
    return Q.duplicate_keys(t.lineitem, "l_orderkey")


@query("first_per_key", """
SELECT text_sha, doc_id, source FROM (SELECT sha256(text) AS text_sha, doc_id, source,
  row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1""")
def first_per_key(t):
    docs = t.documents.select(F.sha2("text", 256).alias("text_sha"), "doc_id", "source")
    return Q.first_per_key(docs, "text_sha", ["doc_id"])


@query("domain_checks", """
SELECT 'status' AS rule, o_orderstatus AS value, count(*) AS n FROM orders
WHERE NOT coalesce(o_orderstatus IN ('O', 'F'), false) GROUP BY 2
UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders
WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY 2""")
def domain_checks(t):
    status = Q.outside_domain(t.orders, "o_orderstatus", ["O", "F"], True)
    priority = Q.outside_domain(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"], False)
    return status.select(F.lit("status").alias("rule"), F.col("o_orderstatus").alias("value"), "n"
                         ).unionByName(priority.select(
                             F.lit("priority").alias("rule"),
                             F.col("o_orderpriority").alias("value"), "n"))


@query("orphan_children", """
SELECT conv_id, turn FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM labels)""")
def orphan_children(t):
    return Q.orphans(t.conversations, "conv_id", t.labels, "doc_id").select("conv_id", "turn")


@query("account_orphans", """
SELECT count(*) AS cases, count(*) FILTER (WHERE o_custkey NOT IN
  (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) AS without_account FROM orders""")
def account_orphans(t):
    accounts = t.customer.filter(F.col("c_acctbal") >= 0)
    lost = Q.orphans(t.orders, "o_custkey", accounts, "c_custkey").agg(F.count("*"))
    return t.orders.agg(F.count("*").alias("cases")).select(
        "cases", lost.scalar().alias("without_account"))


DOC_FIELDS_SQL = """
f AS (SELECT d.doc_id, d.text, l.quality, p.html, c.text AS reply FROM documents d
  LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN pages p ON p.page_id = d.doc_id
  LEFT JOIN conversations c ON c.conv_id = d.doc_id AND c.turn = 0)"""


def doc_fields(t):
    first = t.conversations.filter(F.col("turn") == 0).select(
        F.col("conv_id").alias("doc_id"), F.col("text").alias("reply"))
    return (t.documents.select("doc_id", "text").join(t.labels, "doc_id", "left")
            .join(t.pages.withColumnRenamed("page_id", "doc_id"), "doc_id", "left")
            .join(first, "doc_id", "left").select("doc_id", "text", "quality", "html", "reply"))


@query("field_completeness", f"""
WITH {DOC_FIELDS_SQL},
r AS (SELECT 'text' AS field, count(text)::DOUBLE / count(*) AS p FROM f
  UNION ALL SELECT 'quality', count(quality)::DOUBLE / count(*) FROM f
  UNION ALL SELECT 'html', count(html)::DOUBLE / count(*) FROM f
  UNION ALL SELECT 'reply', count(reply)::DOUBLE / count(*) FROM f)
SELECT field, round(p, 6) AS populated, CASE WHEN field NOT IN ('text', 'quality') THEN 'INFO'
  WHEN p >= 0.95 THEN 'PASS' ELSE 'FAIL' END AS status FROM r""")
def field_completeness(t):
    return Q.completeness(doc_fields(t), ["text", "quality", "html", "reply"], ["text", "quality"]
                          ).withColumn("populated", F.round("populated", 6))


@query("fields_populated_hist", f"""
WITH {DOC_FIELDS_SQL},
n AS (SELECT (CASE WHEN text <> '' THEN 1 ELSE 0 END) + (CASE WHEN quality IS NOT NULL THEN 1 ELSE 0 END)
  + (CASE WHEN html <> '' THEN 1 ELSE 0 END) + (CASE WHEN reply <> '' THEN 1 ELSE 0 END) AS n FROM f)
SELECT CASE WHEN n <= 1 THEN '1' WHEN n <= 2 THEN '2' WHEN n <= 3 THEN '3' ELSE '+Inf' END AS le,
  CASE WHEN n >= 3 THEN 'pass' ELSE 'warn' END AS status, count(*) AS cases FROM n GROUP BY 1, 2""")
def fields_populated_hist(t):
    return Q.populated_histogram(doc_fields(t), ["text", "quality", "html", "reply"], [1, 2, 3], 3)


@query("error_code_stats", """
SELECT round(avg(CASE WHEN p_brand <> '' THEN 1.0 ELSE 0.0 END), 6) AS present,
  count(DISTINCT code) AS unique_codes FROM (SELECT p_brand,
  unnest(regexp_split_to_array(p_type || ', ' || p_brand, ',\\s*')) AS code FROM part)""")
def error_code_stats(t):
    codes = t.part.select(F.concat_ws(", ", "p_type", "p_brand").alias("codes"))
    return Q.error_code_stats(codes, "codes").withColumn("present", F.round("present", 6))


@query("validation_board", """
WITH m AS (SELECT 'embedding_success' AS metric, avg(CASE WHEN len(embedding) = 64 THEN 1.0 ELSE 0.0 END) AS value
    FROM embeddings
  UNION ALL SELECT 'task_coverage', count(DISTINCT l_orderkey)::DOUBLE / (SELECT count(*) FROM orders)
    FROM lineitem
  UNION ALL SELECT 'pii_leaks', count(*) FILTER (WHERE contains(text, '@'))::DOUBLE FROM documents)
SELECT metric, round(value, 6) AS value, CASE metric WHEN 'embedding_success' THEN
  CASE WHEN value >= 0.99 THEN 'passed' ELSE 'failed' END WHEN 'task_coverage' THEN
  CASE WHEN value >= 0.3 THEN 'passed' ELSE 'warning' END ELSE
  CASE WHEN value <= 0 THEN 'passed' ELSE 'failed' END END AS status FROM m""")
def validation_board(t):
    ok = V.success_rate(t.embeddings, "embedding", 64).select(
        F.lit("embedding_success").alias("metric"), F.col("success_rate").alias("value"))
    cases = t.orders.agg(F.count("*")).scalar()
    cover = t.lineitem.agg(F.countDistinct("l_orderkey").alias("n")).select(
        F.lit("task_coverage").alias("metric"), (F.col("n") / cases).alias("value"))
    leaks = t.documents.agg(F.count_if(F.contains("text", F.lit("@"))).cast("double").alias("value")
                            ).select(F.lit("pii_leaks").alias("metric"), "value")
    rows = ok.unionByName(cover).unionByName(leaks)
    return Q.board(rows).select("metric", F.round("value", 6).alias("value"), "status")


@query("stage_gates", """
WITH c AS (SELECT o_orderkey, o_orderdate, max(l_shipdate) AS closed, o_orderstatus, o_orderpriority
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
g AS (SELECT concat_ws(',', CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'status' END,
    CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 'priority' END) AS extract_errors,
  concat_ws(',', 'productFamily', CASE WHEN closed <= o_orderdate THEN 'resolutionTime' END,
    CASE WHEN o_orderdate > TIMESTAMP '2000-06-15 12:00:00' THEN 'ageInDays' END) AS clean_errors FROM c)
SELECT extract_errors, clean_errors, count(*) AS n FROM g GROUP BY 1, 2""")
def stage_gates(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    rows = dated_cases(t).join(orders, "o_orderkey")
    now = F.to_timestamp(F.lit("2000-06-15 12:00:00"))
    extracted = rows.select(
        F.col("o_orderkey").alias("caseId"), F.col("o_orderkey").alias("caseNumber"),
        F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdDate"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.col("closed").alias("closedDate"), F.col("created").alias("at"))
    first = extracted.withColumn("extract_errors", F.array_join(
        Q.extract_gate(["O", "F"], ["1-URGENT", "2-HIGH"]), ","))
    second = first.withColumns({
        "createdDate": F.col("at"), "productFamily": F.lit("Other"), "category": F.lit("A > B"),
        "quarter": E.quarter_label(F.col("at")), "ageInDays": E.case_age_days(F.col("at"), now)})
    return second.withColumn("clean_errors", F.array_join(Q.clean_gate(), ",")).groupBy(
        "extract_errors", "clean_errors").agg(F.count("*").alias("n"))


@query("incremental_extract", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00'""")
def incremental_extract(t):
    return exports.incremental(t.orders, "o_orderdate", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
                               ).select("o_orderkey", "o_custkey")


@query("date_range_extract", """
SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
  AND o_orderdate < TIMESTAMP '1998-04-01 00:00:00'""")
def date_range_extract(t):
    return exports.date_range(t.orders, "o_orderdate", F.lit("1998-01-01").cast("timestamp_ntz"),
                              F.lit("1998-04-01").cast("timestamp_ntz")).select("o_orderkey")


@query("load_row_checks", """
WITH v AS (SELECT vec_id, CASE label WHEN 0 THEN embedding[1:63] WHEN 1 THEN NULL
  WHEN 2 THEN list_transform(embedding, lambda x: x * 0) ELSE embedding END AS e FROM embeddings),
c AS (SELECT CASE WHEN e IS NULL THEN 'missing vector' WHEN len(e) <> 64 THEN 'wrong dimensions: ' || len(e)
  WHEN list_sum(list_transform(e, lambda x: x::DOUBLE * x)) = 0 THEN 'zero magnitude' ELSE 'ok' END AS outcome FROM v)
SELECT outcome, count(*) AS n FROM c GROUP BY 1""")
def load_row_checks(t):
    v = V.as_double(F.col("embedding"))
    damaged = (F.when(F.col("label") == 0, F.slice(v, 1, 63)).when(F.col("label") == 1, None)
               .when(F.col("label") == 2, F.transform(v, lambda x: x * 0)).otherwise(v))
    checked = sinks.load_check(t.embeddings.withColumn("e", damaged), "e", 64)
    return checked.groupBy(F.coalesce("error", F.lit("ok")).alias("outcome")).agg(
        F.count("*").alias("n"))


@query("load_batch_counts", """
SELECT count(*) FILTER (WHERE label >= 2) AS success, count(*) FILTER (WHERE label < 2) AS failed
FROM embeddings""")
def load_batch_counts(t):
    v = F.when(F.col("label") >= 2, F.col("embedding"))
    return sinks.load_counts(sinks.load_check(t.embeddings.withColumn("e", v), "e", 64))


@query("dead_letters", """
SELECT cast(o_orderkey AS VARCHAR) AS record_id, 'load' AS stage, 'Bad status' AS error_type,
  'Bad status: ' || o_orderstatus AS error_message,
  '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS payload
FROM orders WHERE o_orderstatus = 'P'""")
def dead_letters(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus").withColumn("error", F.when(
        F.col("o_orderstatus") == "P", F.concat(F.lit("Bad status: "), "o_orderstatus")))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return sinks.dead_letters(rows, "o_orderkey", "error", "load", at).select(
        "record_id", "stage", "error_type", "error_message", "payload")


CHANGES_SQL = """
changes AS (SELECT o_orderkey, o_orderstatus, o_totalprice, 1 AS version FROM orders
  UNION ALL SELECT l_orderkey, 'L' || l_linestatus, l_extendedprice, 1 + l_linenumber FROM lineitem)"""


@query("upsert_latest", f"""
WITH {CHANGES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey
  ORDER BY version DESC, o_orderstatus DESC, o_totalprice DESC) AS n FROM changes)
SELECT o_orderkey, version, o_orderstatus FROM r WHERE n = 1""")
def upsert_latest(t):
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(1).alias("version"))
    changes = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.concat(F.lit("L"), "l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"), (F.col("l_linenumber") + 1).alias("version"))
    ordered = lambda df: df.withColumn("v", F.struct("version", "o_orderstatus", "o_totalprice"))
    return sinks.upsert(ordered(base), ordered(changes), "o_orderkey", "v").select(
        "o_orderkey", "version", "o_orderstatus")


@query("delete_by_id", """
SELECT c_custkey, c_acctbal < 0 AS deleted FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def delete_by_id(t):
    idle = t.customer.join(t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    kept = sinks.delete(t.customer, idle, "c_custkey")
    return sinks.mark_deleted(kept, t.customer.filter(F.col("c_acctbal") < 0), "c_custkey").select(
        "c_custkey", "deleted")


@query("collection_stats", """
SELECT count(*) AS objects, count(embedding) AS with_vector, min(len(embedding)) AS min_dims,
  max(len(embedding)) AS max_dims FROM embeddings""")
def collection_stats(t):
    return sinks.collection_stats(t.embeddings, "embedding")


@query("table_summary", """
SELECT 'orders' AS "table", count(*) AS "rows", 6 AS columns FROM orders
UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem
UNION ALL SELECT 'documents', count(*), 5 FROM documents""")
def table_summary(t):
    return exports.summary({"orders": t.orders, "lineitem": t.lineitem, "documents": t.documents})


@query("case_lookup", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (1, 7, 32, 100, 0)")
def case_lookup(t):
    return A.lookup(t.orders, "o_orderkey", 1, 7, 32, 100, 0).select("o_orderkey", "o_custkey")


@query("upsert_equal_versions", """
SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1""")
def upsert_equal_versions(t):
    """All orders of a customer are changes of one version: the last by content stays."""
    rows = t.orders.select("o_custkey", F.lpad(F.col("o_orderkey").cast("string"), 20, "0").alias("k"), F.lit(1).alias("v"))
    return sinks.upsert(rows.limit(0), rows, "o_custkey", "v").select("o_custkey", F.col("k").cast("bigint").alias("o_orderkey"))
