"""Personal-data queries. Rules run with ASCII classes where SQL checks them:
RE2 knows no Unicode word edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from casequarry.functions import pii, table_functions
from casequarry.functions.pii_rules import (
    CONFIDENTIAL_WORDS, FLAT, LEAK, OWN_NAMES, SEQUENTIAL, SIGNATURES, SITES, STAGED, TOKENS, Rule)
from casequarry.operators import compliance as P
from casequarry.plans.registry import query
from casequarry.plans.text_queries import sql_clean

ASCII = "ascii"
TABLE_SQL = "CASE doc_id % 3 WHEN 0 THEN 'emailmessage' WHEN 1 THEN 'workorder' ELSE 'case' END"


def with_table(t):
    kind = F.pmod(F.col("doc_id"), F.lit(3))
    return t.documents.withColumn("table", F.when(kind == 0, "emailmessage").when(
        kind == 1, "workorder").otherwise("case"))


def re2(rule: Rule) -> str:
    return ("(?i)" if rule.ignore_case else "") + rule.regex.replace("'", "''")


def sql_hits(rules, source: str = "docs") -> str:
    """SQL for (doc_id, rule_no, type, confidence, stage, occ, hit, start, stop)."""
    parts = []
    for number, rule in enumerate(rules):
        gate = f" AND \"table\" = '{rule.table}'" if rule.table else ""
        parts.append(
            f"SELECT doc_id, {number} AS rule_no, '{rule.type}' AS type, {rule.confidence}::DOUBLE AS confidence, "
            f"'{rule.stage}' AS stage, regexp_extract_all(text, '{re2(rule)}') AS m, "
            f"regexp_split_to_array(text, '{re2(rule)}') AS g FROM {source} "
            f"WHERE regexp_matches(text, '{re2(rule)}'){gate}")
    union = " UNION ALL ".join(parts)
    return f"""
raw AS ({union}),
hits AS (SELECT doc_id, rule_no, type, confidence, stage, i AS occ, m[i] AS hit,
  cast(list_sum(list_transform(g[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS start
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM raw)),
ranked AS (SELECT *, start + length(hit) AS stop,
  row_number() OVER (PARTITION BY doc_id ORDER BY start, rule_no, occ) AS n FROM hits)"""


# Walks each text's hits by start and keeps the stronger of two that overlap.
SQL_MERGE = """
walk AS (
  SELECT doc_id, n, type, confidence, stage, start, stop, NULL::VARCHAR AS out_type,
    NULL::VARCHAR AS out_stage, NULL::DOUBLE AS out_conf, NULL::BIGINT AS out_start,
    NULL::BIGINT AS out_stop FROM ranked WHERE n = 1
  UNION ALL
  SELECT r.doc_id, r.n,
    CASE WHEN keep THEN w.type ELSE r.type END, CASE WHEN keep THEN w.confidence ELSE r.confidence END,
    CASE WHEN keep THEN w.stage ELSE r.stage END, CASE WHEN keep THEN w.start ELSE r.start END,
    CASE WHEN keep THEN w.stop ELSE r.stop END,
    CASE WHEN r.start >= w.stop THEN w.type END, CASE WHEN r.start >= w.stop THEN w.stage END,
    CASE WHEN r.start >= w.stop THEN w.confidence END, CASE WHEN r.start >= w.stop THEN w.start END,
    CASE WHEN r.start >= w.stop THEN w.stop END
  FROM walk w JOIN ranked r ON r.doc_id = w.doc_id AND r.n = w.n + 1,
  LATERAL (SELECT r.start < w.stop AND NOT (r.confidence > w.confidence OR
    (r.confidence = w.confidence AND r.stop - r.start > w.stop - w.start)) AS keep)),
merged AS (
  SELECT doc_id, out_type AS type, out_stage AS stage, out_conf AS confidence,
    out_start AS start, out_stop AS stop FROM walk WHERE out_start IS NOT NULL
  UNION ALL
  SELECT doc_id, type, stage, confidence, start, stop FROM walk
  QUALIFY n = max(n) OVER (PARTITION BY doc_id))"""

# The safe merge: an overlap grows the span and keeps the better label.
SQL_COVER = SQL_MERGE.replace(
    "CASE WHEN keep THEN w.start ELSE r.start END,",
    "CASE WHEN r.start < w.stop THEN w.start ELSE r.start END,").replace(
    "CASE WHEN keep THEN w.stop ELSE r.stop END,",
    "CASE WHEN r.start < w.stop THEN greatest(w.stop, r.stop) ELSE r.stop END,")

DOCS_SQL = f"docs AS (SELECT *, {TABLE_SQL} AS \"table\" FROM documents)"
TOKEN_SQL = "CASE type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TOKENS.items()) + " ELSE '[REDACTED]' END"


@query("pii_counts_by_type", f"""
WITH {DOCS_SQL}, {sql_hits(STAGED)}
SELECT type, stage, count(*) AS hits, count(DISTINCT doc_id) AS texts FROM ranked GROUP BY 1, 2""")
def pii_counts_by_type(t):
    found = with_table(t).select("doc_id", F.explode(pii.all_spans(
        F.col("text"), F.col("table"), classes=ASCII)).alias("s"))
    return (found.groupBy(F.col("s.type").alias("type"), F.col("s.stage").alias("stage"), "doc_id")
            .agg(F.count("*").alias("n")).groupBy("type", "stage")
            .agg(F.sum("n").alias("hits"), F.count("*").alias("texts")))


@query("pii_merged_spans", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_MERGE}
SELECT doc_id, type, stage, confidence, start, stop AS "end" FROM merged""")
def pii_merged_spans(t):
    return pii.detection_rows(with_table(t), "doc_id", "text", "table", classes=ASCII).drop("text")


@query("pii_redacted_ascii", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_MERGE},
gaps AS (SELECT doc_id, type, start, stop,
  coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS before FROM merged),
built AS (SELECT g.doc_id, string_agg(substr(text, before + 1, start - before) || {TOKEN_SQL}, ''
    ORDER BY start) || substr(any_value(text), max(stop) + 1) AS clean, count(*) AS n
  FROM gaps g JOIN documents d ON d.doc_id = g.doc_id GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS pii_count, coalesce(n, 0) > 0 AS pii_removed,
  md5(coalesce(clean, text)) AS text_md5
FROM documents d LEFT JOIN built b ON b.doc_id = d.doc_id""")
def pii_redacted_ascii(t):
    return P.clean_records(with_table(t), ["text"], "table", classes=ASCII).select(
        "doc_id", F.col("pii_count"), "pii_removed", F.md5("text").alias("text_md5"))


# The SQL's classes are ASCII. No hit in these tables touches a letter outside
# ASCII, so it must agree; tests compare such texts with Python.
@query("pii_redacted_docs", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_MERGE},
gaps AS (SELECT doc_id, type, start, stop,
  coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS before FROM merged),
built AS (SELECT g.doc_id, string_agg(substr(text, before + 1, start - before) || {TOKEN_SQL}, ''
    ORDER BY start) || substr(any_value(text), max(stop) + 1) AS clean, count(*) AS n
  FROM gaps g JOIN documents d ON d.doc_id = g.doc_id GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS pii_count, coalesce(n, 0) > 0 AS pii_removed, coalesce(clean, text) AS text
FROM documents d LEFT JOIN built b ON b.doc_id = d.doc_id""")
def pii_redacted_docs(t):
    """Unicode classes, as in Python."""
    return P.clean_records(with_table(t), ["text"], "table").select(
        "doc_id", "pii_count", "pii_removed", "text")


@query("pii_redacted_cover", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_COVER},
gaps AS (SELECT doc_id, type, start, stop,
  coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS before FROM merged),
built AS (SELECT g.doc_id, string_agg(substr(text, before + 1, start - before) || {TOKEN_SQL}, ''
    ORDER BY start) || substr(any_value(text), max(stop) + 1) AS clean, count(*) AS n
  FROM gaps g JOIN documents d ON d.doc_id = g.doc_id GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS pii_count, coalesce(n, 0) > 0 AS pii_removed, coalesce(clean, text) AS text
FROM documents d LEFT JOIN built b ON b.doc_id = d.doc_id""")
def pii_redacted_cover(t):
    """Leak-safe merge: everything detected is covered."""
    return P.clean_records(with_table(t), ["text"], "table", merge="cover").select(
        "doc_id", "pii_count", "pii_removed", "text")


@query("pii_cover_ascii", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_COVER},
gaps AS (SELECT doc_id, type, start, stop,
  coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS before FROM merged),
built AS (SELECT g.doc_id, string_agg(substr(text, before + 1, start - before) || {TOKEN_SQL}, ''
    ORDER BY start) || substr(any_value(text), max(stop) + 1) AS clean, count(*) AS n
  FROM gaps g JOIN documents d ON d.doc_id = g.doc_id GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS pii_count, md5(coalesce(clean, text)) AS text_md5
FROM documents d LEFT JOIN built b ON b.doc_id = d.doc_id""")
def pii_cover_ascii(t):
    return P.clean_records(with_table(t), ["text"], "table", merge="cover", classes=ASCII).select(
        "doc_id", "pii_count", F.md5("text").alias("text_md5"))


@query("pii_report", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_MERGE},
r AS (SELECT doc_id, count(*) AS n, avg(confidence) AS c, count(DISTINCT type) AS k FROM merged GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS total, round(coalesce(c, 0), 6) AS avg_confidence,
  coalesce(k, 0) AS types, coalesce(n, 0) > 0 AS has_pii
FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id""")
def pii_report(t):
    found = pii.detect(with_table(t), "text", "table", classes=ASCII)
    return found.withColumn("r", pii.report(F.col("pii"), F.col("table"))).select(
        "doc_id", F.col("r.total_pii_count").alias("total"),
        F.round("r.avg_confidence", 6).alias("avg_confidence"),
        F.size("r.pii_by_type").alias("types"), "r.has_pii")


FLAT_SQL = f"WITH docs AS (SELECT * FROM documents), {sql_hits(FLAT)}"


@query("pii_flat_spans", f"""
{FLAT_SQL} SELECT doc_id, type, hit AS value, start, stop AS "end" FROM ranked""")
def pii_flat_spans(t):
    spans = pii.all_spans(F.col("text"), rules=FLAT, classes=ASCII)
    return t.documents.select("doc_id", F.explode(spans).alias("s")).select(
        "doc_id", "s.type", F.col("s.text").alias("value"), "s.start", "s.end")


def sql_any(rules, column: str = "text") -> str:
    return "(" + " OR ".join(f"regexp_matches({column}, '{re2(r)}')" for r in rules) + ")"


@query("pii_has_any", f"SELECT doc_id, {sql_any(FLAT)} AS has_pii FROM documents")
def pii_has_any(t):
    return t.documents.select("doc_id", pii.has_pii(F.col("text"), FLAT, ASCII).alias("has_pii"))


@query("pii_leak_gate", f"""
SELECT CASE WHEN {sql_any(LEAK)} THEN 'review' ELSE 'clean' END AS route, count(*) AS n,
  cast(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1""")
def pii_leak_gate(t):
    clean, review = P.leak_split(t.documents, "text", classes=ASCII)
    both = clean.withColumn("route", F.lit("clean")).unionByName(
        review.withColumn("route", F.lit("review")))
    return both.groupBy("route").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("pii_zero_leak_scan", f"""
SELECT count(*) AS scanned, count(*) FILTER (WHERE {sql_any(LEAK)}) AS leaks,
  CASE WHEN count(*) FILTER (WHERE {sql_any(LEAK)}) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM documents""")
def pii_zero_leak_scan(t):
    return P.zero_leak_scan(t.documents, "doc_id", "text", rules=LEAK, classes=ASCII)


@query("pii_zero_leak_sample", f"""
SELECT count(*) AS scanned, count(*) FILTER (WHERE {sql_any(LEAK)}) AS leaks,
  CASE WHEN count(*) FILTER (WHERE {sql_any(LEAK)}) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM (SELECT * FROM documents ORDER BY md5(doc_id || ':42'), doc_id LIMIT 500)""")
def pii_zero_leak_sample(t):
    return P.zero_leak_scan(t.documents, "doc_id", "text", 500, rules=LEAK, classes=ASCII)


def sql_sequence(rules, text: str = "text") -> tuple[str, str, str]:
    """CTEs that apply rules one after the other; returns (ctes, last, count columns)."""
    ctes, last, counts = [], "seq0", []
    for i, rule in enumerate(rules, 1):
        token = (rule.token or "").replace("$1", "\\1")
        counts.append(f"hits_{rule.type}")
        ctes.append(
            f"seq{i} AS (SELECT * REPLACE (regexp_replace(text, '{re2(rule)}', '{token}', 'g') AS text), "
            f"len(regexp_extract_all(text, '{re2(rule)}')) AS hits_{rule.type} FROM {last})")
        last = f"seq{i}"
    return ", ".join(ctes), last, ", ".join(counts)


ALL_STEPS = [*SEQUENTIAL, *SIGNATURES, *OWN_NAMES]
_CTES, _LAST, _COUNTS = sql_sequence(ALL_STEPS)


@query("pii_sequential_redact", f"""
WITH seq0 AS (SELECT doc_id, CASE WHEN contains(text, '<') AND contains(text, '>')
  THEN {sql_clean('text')} ELSE text END AS text FROM documents), {_CTES}
SELECT doc_id, md5(text) AS text_md5, {_COUNTS} FROM {_LAST}""")
def pii_sequential_redact(t):
    out = P.remove_in_sequence(t.documents.select("doc_id", "text"), "text", "EmailMessage",
                               classes=ASCII)
    return out.withColumn("text_md5", F.md5("text")).drop("text")


_CTES2, _LAST2, _COUNTS2 = sql_sequence([*SEQUENTIAL, *SITES, *OWN_NAMES])


@query("pii_sequential_sites", f"""
WITH seq0 AS (SELECT doc_id, CASE WHEN contains(text, '<') AND contains(text, '>')
  THEN {sql_clean('text')} ELSE text END AS text FROM documents), {_CTES2}
SELECT doc_id, md5(text) AS text_md5, {_COUNTS2} FROM {_LAST2}""")
def pii_sequential_sites(t):
    out = P.remove_in_sequence(t.documents.select("doc_id", "text"), "text", "WorkOrder",
                               classes=ASCII)
    return out.withColumn("text_md5", F.md5("text")).drop("text")


_CTES3, _LAST3, _COUNTS3 = sql_sequence(P.BY_FIELD)


@query("pii_by_field_redact", f"""
WITH seq0 AS (SELECT doc_id, text FROM documents), {_CTES3}
SELECT doc_id, md5(text) AS text_md5, {_COUNTS3} FROM {_LAST3}""")
def pii_by_field_redact(t):
    out = P.remove_by_field(t.documents.select("doc_id", "text"), "text", "onsite_action",
                            classes=ASCII)
    return out.withColumn("text_md5", F.md5("text")).drop("text")


@query("pii_table_risk", """
SELECT role, CASE role WHEN 'user' THEN 'CRITICAL' WHEN 'assistant' THEN 'HIGH' ELSE 'LOW' END AS risk,
  role <> 'system' AS high_risk, count(*) AS n FROM conversations GROUP BY 1, 2, 3""")
def pii_table_risk(t):
    table = F.when(F.col("role") == "user", "EmailMessage").when(
        F.col("role") == "assistant", "WorkOrder").otherwise("Task")
    return t.conversations.groupBy(
        "role", P.table_risk(table).alias("risk"),
        P.is_high_risk(table, F.lit("description")).alias("high_risk")).agg(F.count("*").alias("n"))


KEYWORDS = "|".join(CONFIDENTIAL_WORDS)


@query("sensitivity_class", f"""
WITH s AS (SELECT doc_id, {sql_any(STAGED[:8])} AS pii,
  regexp_matches(lower(source || ' ' || text), '{KEYWORDS}') AS word FROM documents),
c AS (SELECT doc_id, pii, CASE WHEN word THEN 'CONFIDENTIAL' WHEN pii THEN 'RESTRICTED'
  ELSE 'INTERNAL' END AS classification,
  CASE WHEN pii THEN 'RESTRICTED' WHEN word THEN 'CONFIDENTIAL' ELSE 'INTERNAL' END AS strict FROM s)
SELECT classification AS data_classification, strict,
  CASE WHEN pii THEN 'removed' ELSE 'none_detected' END AS pii_status,
  classification IN ('CONFIDENTIAL', 'RESTRICTED') AS encryption_required,
  CASE WHEN classification = 'RESTRICTED' THEN 2555 ELSE 3650 END AS retention_period_days,
  count(*) AS n FROM c GROUP BY ALL""")
def sensitivity_class(t):
    subject, text = F.col("source"), F.col("text")
    flagged = t.documents.withColumn("pii", pii.has_pii(text, STAGED[:8], ASCII)).select(
        "pii", P.sensitivity(subject, text, F.col("pii")).alias("c"),
        P.sensitivity(subject, text, F.col("pii"), strict=True).alias("strict"))
    labels = P.data_labels(F.col("c"), F.col("pii"), "data-team", ["GDPR"])
    kept = ["data_classification", "pii_status", "encryption_required", "retention_period_days"]
    return flagged.groupBy("strict", *[labels[k].alias(k) for k in kept]).agg(F.count("*").alias("n"))


AUDIT_SQL = f"""audit AS (SELECT d.doc_id, coalesce(n, 0) AS n, types,
  TIMESTAMP '2024-01-01 00:00:00' + to_hours(d.doc_id % 720) AS processed_at
  FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n, list_sort(list_distinct(list(type))) AS types
    FROM merged GROUP BY 1) m ON m.doc_id = d.doc_id)"""
PERIOD = "processed_at BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'"


def audit_table(t):
    cleaned = P.clean_records(with_table(t), ["text"], "table", classes=ASCII)
    at = F.timestamp_add("HOUR", F.pmod("doc_id", F.lit(720)).cast("int"),
                         F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return P.audit_rows(cleaned, "doc_id", "doc_id", at)


@query("pii_audit_rows", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_MERGE}, {AUDIT_SQL}
SELECT cast(doc_id AS VARCHAR) AS case_id, strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at,
  n AS pii_detected_count, coalesce(array_to_string(types, ','), '') AS pii_types, n AS text_count,
  CASE WHEN n > 0 THEN 'pii_removed' ELSE 'none' END AS compliance_flags FROM audit""")
def pii_audit_rows(t):
    return audit_table(t).select(
        "case_id", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at"),
        "pii_detected_count", F.array_join("pii_types", ",").alias("pii_types"),
        F.coalesce(F.col("field_wise_counts")["text"], F.lit(0)).alias("text_count"),
        "compliance_flags")


@query("pii_compliance_report", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_MERGE}, {AUDIT_SQL},
p AS (SELECT * FROM audit WHERE {PERIOD})
SELECT 'total_records' AS item, count(*) AS value FROM p
UNION ALL SELECT 'total_pii_detected', cast(sum(n) AS BIGINT) FROM p
UNION ALL SELECT 'records_with_pii', count(*) FILTER (WHERE n > 0) FROM p
UNION ALL SELECT 'type:' || type, count(*) FROM (SELECT unnest(types) AS type FROM p) GROUP BY 1""")
def pii_compliance_report(t):
    return P.compliance_report(audit_table(t), F.lit("2024-01-05 00:00:00").cast("timestamp"),
                               F.lit("2024-01-25 00:00:00").cast("timestamp"))


@query("pii_detection_statistics", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_MERGE},
n AS (SELECT d.doc_id, "table", count(m.doc_id) AS n FROM docs d LEFT JOIN merged m ON m.doc_id = d.doc_id
  GROUP BY 1, 2)
SELECT "table", count(*) AS "rows", round(avg(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END), 6) AS share_with_pii,
  round(avg(n), 6) AS mean_per_row FROM n GROUP BY 1""")
def pii_detection_statistics(t):
    found = pii.detect(with_table(t), "text", "table", classes=ASCII)
    return P.detection_statistics(found, "table", "pii").select(
        "table", "rows", F.round("share_with_pii", 6).alias("share_with_pii"),
        F.round("mean_per_row", 6).alias("mean_per_row"))


@query("pii_type_shares", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_MERGE}
SELECT type, count(*) AS hits, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share
FROM merged GROUP BY 1""")
def pii_type_shares(t):
    found = pii.detect(with_table(t), "text", "table", classes=ASCII)
    return P.type_shares(found, "pii").withColumn("share", F.round("share", 6))


@query("pii_detection_rates", f"""
WITH f AS (SELECT d.doc_id, {sql_any(FLAT)} AS found, toxic = 1 AS labelled
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
SELECT count(*) AS texts, round(avg(CASE WHEN labelled THEN CASE WHEN found THEN 1.0 ELSE 0.0 END END), 6)
  AS detection_rate,
  round(avg(CASE WHEN NOT labelled THEN CASE WHEN found THEN 1.0 ELSE 0.0 END END), 6)
  AS false_positive_rate FROM f""")
def pii_detection_rates(t):
    """The toxic label stands in for a personal-data label."""
    rows = t.documents.join(t.labels, "doc_id")
    rates = P.detection_rates(rows, pii.has_pii(F.col("text"), FLAT, ASCII), F.col("toxic") == 1)
    return rates.select("texts", F.round("detection_rate", 6).alias("detection_rate"),
                        F.round("false_positive_rate", 6).alias("false_positive_rate"))


@query("pii_failure_gate", f"""
SELECT round(avg(CASE WHEN text IS NULL OR text = '' THEN 1.0 ELSE 0.0 END), 6) AS failure_rate
FROM documents""")
def pii_failure_gate(t):
    return P.failure_gate(t.documents, F.col("text").isNull() | (F.col("text") == "")).select(
        F.round("failure_rate", 6).alias("failure_rate"))


NAMES_SQL = r"""names AS (SELECT DISTINCT lower(w) AS w FROM (SELECT unnest(regexp_extract_all(text,
    '[A-Z][a-z]+')) AS w FROM benchmark)),
c AS (SELECT doc_id, regexp_extract_all(text, '\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)+') AS m,
  string_split_regex(text, '\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)+') AS g FROM documents),
e AS (SELECT doc_id, i, m[i] AS person, g[i] AS gap,
  list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS pos
  FROM (SELECT doc_id, m, g, unnest(range(1, len(g) + 1)) AS i FROM c)),
k AS (SELECT *, person IS NOT NULL
  AND NOT regexp_matches(lower(person), 'proliant|synergy|aruba|gen10|ilo|simplivity|primera|nimble|apollo|hpe')
  AND lower(split_part(person, ' ', 1)) IN (SELECT w FROM names) AS known FROM e)"""


def given_names(t):
    return t.benchmark.select(F.explode(F.regexp_extract_all(
        "text", F.lit("[A-Z][a-z]+"), F.lit(0))).alias("given"))


@query("person_names", f"""
WITH {NAMES_SQL}
SELECT doc_id, person, pos::BIGINT AS start, (pos + length(person))::BIGINT AS "end" FROM k WHERE known""")
def person_names(t):
    return P.person_names(t.documents, "doc_id", "text", given_names(t), "given", ASCII).drop("span")


@query("pii_redacted_names", f"""
WITH {NAMES_SQL}
SELECT doc_id, md5(string_agg(gap || CASE WHEN known THEN '[NAME_REDACTED]' ELSE coalesce(person, '') END, '' ORDER BY i)) AS text_md5
FROM k GROUP BY doc_id""")
def pii_redacted_names(t):
    return P.redact_names(t.documents, "doc_id", "text", given_names(t), "given", classes=ASCII).select(
        "doc_id", F.md5("text").alias("text_md5"))


@query("pii_deobfuscated", r"""
WITH c AS (SELECT item_id, regexp_replace(regexp_replace(regexp_replace(
  replace(replace(text, '@', ' [at] '), '.', '[.]'), '(?i)\s?[\[(]at[\])]\s?', '@', 'g'),
  '(?i)\s?[\[(]dot[\])]\s?', '.', 'g'), '\[\.\]', '.', 'g') AS plain FROM benchmark)
SELECT item_id, plain FROM c""")
def pii_deobfuscated(t):
    hidden = F.replace(F.replace("text", F.lit("@"), F.lit(" [at] ")), F.lit("."), F.lit("[.]"))
    return t.benchmark.select("item_id", pii.deobfuscate(hidden).alias("plain"))


@query("pii_table_function", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_MERGE}
SELECT doc_id, type, stage, confidence, start, stop AS "end" FROM merged""")
def pii_table_function(t):
    """Detections by a SQL table function and LATERAL, in plain SQL text."""
    name = table_functions.register(t.spark, "pii_detections_ascii", classes=ASCII)
    return t.spark.sql(f'''SELECT doc_id, d.type, d.stage, d.confidence, d.start, d.`end`
        FROM {{docs}}, LATERAL {name}(text, `table`) d''', docs=with_table(t))


@query("pii_table_function_types", f"""
WITH RECURSIVE {DOCS_SQL}, {sql_hits(STAGED)}, {SQL_MERGE},
c AS (SELECT doc_id, type, count(*) AS n, min(start) AS first FROM merged GROUP BY 1, 2)
SELECT lang, type, sum(n)::BIGINT AS hits, count(*) AS texts, min(first) AS earliest
FROM c JOIN documents USING (doc_id) GROUP BY 1, 2""")
def pii_table_function_types(t):
    """The table function inside a correlated subquery that groups per text."""
    name = table_functions.register(t.spark, "pii_detections_ascii", classes=ASCII)
    return t.spark.sql(f'''SELECT lang, type, sum(n) AS hits, count(*) AS texts, min(first) AS earliest
        FROM (SELECT doc_id, lang, d.type, count(*) AS n, min(d.start) AS first
              FROM {{docs}}, LATERAL {name}(text, `table`) d GROUP BY doc_id, lang, d.type)
        GROUP BY lang, type''', docs=with_table(t))
