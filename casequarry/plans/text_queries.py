"""Text, assembly and enrichment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casequarry.functions import enrich as E
from casequarry.functions import text as T
from casequarry.operators import assemble as A
from casequarry.plans.registry import query

WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def sql_clean(expr: str) -> str:
    out = f"regexp_replace({expr}, '<[^>]+>', '', 'g')"
    for entity, char in T.ENTITIES:
        out = f"replace({out}, '{entity}', '{char}')"
    return f"trim(regexp_replace({out}, '{WS}', ' ', 'g'))"


@query("html_clean_pages", f"""
SELECT page_id, {sql_clean('html')} AS clean_text FROM pages""")
def html_clean_pages(t):
    return t.pages.select("page_id", T.clean_html(F.col("html")).alias("clean_text"))


@query("html_clean_if_tagged", f"""
SELECT doc_id, CASE WHEN contains(text, '<') AND contains(text, '>') THEN {sql_clean('text')}
       ELSE text END AS clean_text FROM documents""")
def html_clean_if_tagged(t):
    return t.documents.select("doc_id", T.clean_html_if_tagged(F.col("text")).alias("clean_text"))


# The named entities that occur in the pages, the ampersand last.
UNESCAPED = "html"
for _name, _char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("nbsp", "\u00a0")):
    UNESCAPED = f"replace({UNESCAPED}, '&{_name};', '{_char}')"
UNESCAPED = f"regexp_replace({UNESCAPED}, '&amp;?', '&', 'g')"


@query("html_unescape_pages", f"""
SELECT page_id, trim(regexp_replace(regexp_replace({UNESCAPED}, '<[^>]+>', '', 'g'), '{WS}', ' ', 'g'))
  AS clean_text FROM pages""")
def html_unescape_pages(t):
    return t.pages.select("page_id", T.clean_html_unescaped(F.col("html")).alias("clean_text"))


@query("unicode_normalized_docs", """
SELECT doc_id, md5(nfc_normalize(text)) AS text_md5 FROM documents""")
def unicode_normalized_docs(t):
    return t.documents.select("doc_id", F.md5(T.normalize_unicode(F.col("text"))).alias("text_md5"))


@query("standardized_values", """
SELECT c_custkey, nullif(upper(trim(c_mktsegment)), '') AS segment,
       nullif(lower(trim(c_name)), '') AS name FROM customer""")
def standardized_values(t):
    return t.customer.select(
        "c_custkey", T.standardize(F.col("c_mktsegment"), "upper").alias("segment"),
        T.standardize(F.col("c_name"), "lower").alias("name"))


@query("smart_truncate_docs", """
SELECT doc_id, length(cut) AS kept, md5(cut) AS text_md5 FROM (
  SELECT doc_id, CASE WHEN length(text) > 30000 THEN
    substr(substr(text, 1, 24000) || chr(10) || chr(10) || '[...TRUNCATED...]' || chr(10) || chr(10)
           || right(text, 6000), 1, 30000) ELSE text END AS cut FROM documents)""")
def smart_truncate_docs(t):
    return t.documents.withColumn("cut", T.smart_truncate(F.col("text"))).select(
        "doc_id", F.length("cut").alias("kept"), F.md5("cut").alias("text_md5"))


@query("head_truncate_docs", """
SELECT doc_id, md5(CASE WHEN length(text) > 30000 THEN substr(text, 1, 30000) || chr(10) || chr(10)
       || '[... TRUNCATED DUE TO LENGTH ...]' ELSE text END) AS text_md5 FROM documents""")
def head_truncate_docs(t):
    return t.documents.select("doc_id", F.md5(T.head_truncate(F.col("text"))).alias("text_md5"))


@query("section_truncate_docs", """
WITH p AS (SELECT doc_id, chr(10) AS nl, '=== ISSUE ===' || chr(10) || substr(text, 1, 2000) AS iss,
    '=== ENGINEER COMMENTS ===' || chr(10) || text AS com, '=== WORK ORDERS ===' || chr(10) || reverse(text) AS wo,
    '=== RESOLUTION ===' || chr(10) || right(text, 2000) AS res FROM documents),
a AS (SELECT *, iss || nl || com || nl || wo || nl || res AS whole, iss || nl || nl || res AS kept,
  nl || nl || '[... TROUBLESHOOTING STEPS AND COMMENTS TRUNCATED ...]' AS marker FROM p),
b AS (SELECT *, CASE WHEN length(kept) + length(com) < 30000 THEN kept || nl || nl || com END AS one FROM a),
c AS (SELECT doc_id, CASE WHEN length(whole) <= 30000 THEN whole WHEN one IS NULL THEN kept || marker
  WHEN length(one) + length(wo) < 30000 THEN one || nl || nl || wo ELSE one || marker END AS cut FROM b)
SELECT doc_id, length(cut) AS kept, md5(cut) AS text_md5 FROM c""")
def section_truncate_docs(t):
    sectioned = F.concat(F.lit("=== ISSUE ===\n"), F.left("text", F.lit(2000)),
                         F.lit("\n=== ENGINEER COMMENTS ===\n"), F.col("text"),
                         F.lit("\n=== WORK ORDERS ===\n"), F.reverse("text"),
                         F.lit("\n=== RESOLUTION ===\n"), F.right("text", F.lit(2000)))
    return t.documents.withColumn("cut", T.section_truncate(sectioned)).select(
        "doc_id", F.length("cut").alias("kept"), F.md5("cut").alias("text_md5"))


@query("text_dedup_sha", """
SELECT sha256(text) AS text_sha, min(doc_id) AS first_doc, count(*) AS copies
FROM documents GROUP BY 1""")
def text_dedup_sha(t):
    return (t.documents.select(T.text_key(F.col("text")).alias("text_sha"), "doc_id")
            .groupBy("text_sha")
            .agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies")))


@query("query_simplify", rf"""
SELECT item_id, trim(regexp_replace(lower(regexp_replace(regexp_replace(text,
  '(Gen\d+|DL\d+|ML\d+|BL\d+)', '', 'g'), '[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}\s]', ' ', 'g')),
  '{WS}', ' ', 'g')) AS user_query FROM benchmark""")
def query_simplify(t):
    return t.benchmark.select("item_id", T.simplify_to_user_query(F.col("text")).alias("user_query"))


@query("highlights_top3", """
WITH q AS (SELECT list_filter(string_split('the entre Haben information password', ' '), lambda w: w <> '') AS words),
f AS (
  SELECT doc_id, list_transform(list_filter(words, lambda w: contains(lower(text), lower(w))), lambda w:
    '...' || substr(text, greatest(0, strpos(lower(text), lower(w)) - 1 - 50) + 1,
      strpos(lower(text), lower(w)) - 1 + 100 - greatest(0, strpos(lower(text), lower(w)) - 1 - 50)) || '...') AS a,
    list_transform(list_filter(words, lambda w: contains(lower(source), lower(w))), lambda w:
    '...' || substr(source, greatest(0, strpos(lower(source), lower(w)) - 1 - 50) + 1,
      strpos(lower(source), lower(w)) - 1 + 100 - greatest(0, strpos(lower(source), lower(w)) - 1 - 50)) || '...') AS b
  FROM documents, q)
SELECT doc_id, array_to_string(list_slice(list_concat(a, b), 1, 3), ' # ') AS snippets FROM f""")
def highlights_top3(t):
    words = F.lit("the entre Haben information password")
    return t.documents.select("doc_id", F.array_join(
        T.highlights(words, [F.col("text"), F.col("source")]), " # ").alias("snippets"))


@query("token_counts", r"""
SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda x: x <> ''))
  AS tokens FROM documents""")
def token_counts(t):
    return t.documents.select("doc_id", F.size(T.tokens(F.col("text"))).alias("tokens"))


@query("text_classes", """
SELECT CASE WHEN length(text) < 200 THEN 'simple' WHEN length(text) < 800 THEN 'moderate'
       ELSE 'complex' END AS length_class,
  CASE WHEN length(text) < 20 THEN 'short' WHEN length(text) < 50 THEN 'medium' ELSE 'long' END
    AS query_bucket,
  length(trim(text)) >= 3 AS valid_query, count(*) AS n,
  cast(sum(least(length(text), 50)) AS BIGINT) AS limit_sum
FROM documents GROUP BY 1, 2, 3""")
def text_classes(t):
    c = F.col("text")
    return (t.documents.groupBy(T.length_class(c).alias("length_class"),
                                T.query_length_bucket(c).alias("query_bucket"),
                                T.query_is_valid(c).alias("valid_query"))
            .agg(F.count("*").alias("n"),
                 F.sum(T.effective_limit(F.length(c))).alias("limit_sum")))


@query("preview_docs", """
SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END
  AS preview FROM documents""")
def preview_docs(t):
    return t.documents.select("doc_id", T.preview(F.col("text")).alias("preview"))


# -- enrichment ---------------------------------------------------------------

# Part names have no product families of their own; these rules give them some.
PART_FAMILIES = [("small.*", "Small goods"), ("red.*", "Red goods"), (".*ring", "Rings"),
                 (".*widget.*", "Widgets"), (".*bolt.*", "Bolts")]


def sql_family(column: str) -> str:
    tests = " ".join(f"WHEN regexp_matches({column}, '(?i){p}') THEN '{n}'" for p, n in PART_FAMILIES)
    return (f"CASE WHEN {column} IS NULL OR {column} = '' THEN 'Unknown' {tests} ELSE 'Other' END")


@query("product_family", f"SELECT p_partkey, {sql_family('p_name')} AS product_family FROM part")
def product_family(t):
    return t.part.select("p_partkey", E.product_family(F.col("p_name"), PART_FAMILIES)
                         .alias("product_family"))


@query("category_hierarchy", """
WITH s AS (SELECT p_partkey, string_split(CASE p_size % 4 WHEN 0 THEN 'hw - ' WHEN 1 THEN 'SW-'
    WHEN 2 THEN '' ELSE 'XYZ - ' END || p_type || ' - ' || p_brand || ' - ' || p_name, '-') AS parts
  FROM part),
m AS (SELECT p_partkey, coalesce(map {'HW': 'Hardware', 'SW': 'Software', 'NW': 'Networking',
    'FW': 'Firmware', 'OS': 'Operating System', 'APP': 'Application', 'SEC': 'Security'}
    [upper(trim(parts[1]))], trim(parts[1])) AS l1, trim(parts[2]) AS l2, trim(parts[3]) AS l3 FROM s)
SELECT p_partkey, l1 AS level1, l2 AS level2, l3 AS level3, concat_ws(' > ', l1, l2, l3) AS path
FROM m""")
def category_hierarchy(t):
    kind = F.col("p_size") % 4
    raw = F.concat(F.when(kind == 0, "hw - ").when(kind == 1, "SW-").when(kind == 2, "")
                   .otherwise("XYZ - "), "p_type", F.lit(" - "), "p_brand", F.lit(" - "), "p_name")
    level = E.category_levels(raw)
    return t.part.select("p_partkey", level.alias("l")).select("p_partkey", "l.*")


CASES_SQL = """
cases AS (SELECT o_orderkey, o_orderdate AS created, max(l_shipdate) AS closed
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def dated_cases(t):
    """Orders as cases: created = order date, closed = last ship date."""
    closed = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("closed"))
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").alias("created"))
    return orders.join(closed, orders["o_orderkey"] == closed["l_orderkey"], "left").drop("l_orderkey")


@query("resolution_buckets", f"""
WITH {CASES_SQL},
h AS (SELECT o_orderkey, created, closed, (epoch(closed) - epoch(created)) / 3600 AS hours FROM cases)
SELECT CASE WHEN created IS NULL THEN 'Unknown' WHEN closed IS NULL THEN 'Open'
  WHEN hours < 0 THEN 'Invalid' WHEN hours < 4 THEN '0-4 hours' WHEN hours < 24 THEN '4-24 hours'
  WHEN hours < 168 THEN '1-7 days' ELSE '>7 days' END AS bucket,
  CASE WHEN closed IS NULL THEN 'none' WHEN hours <= 4 THEN '0-4h' WHEN hours <= 24 THEN '4-24h'
  WHEN hours <= 168 THEN '1-7d' ELSE '>7d' END AS bucket_closed,
  count(*) AS n, round(coalesce(avg(CASE WHEN hours >= 0 THEN round(hours, 2) END), -1), 4) AS avg_hours
FROM h GROUP BY 1, 2""")
def resolution_buckets(t):
    created, closed = F.col("created"), F.col("closed")
    return (dated_cases(t).groupBy(
        E.resolution_bucket(created, closed).alias("bucket"),
        F.coalesce(E.resolution_bucket_closed(created, closed), F.lit("none")).alias("bucket_closed"))
        .agg(F.count("*").alias("n"), F.round(F.coalesce(
            F.avg(E.resolution_hours(created, closed)), F.lit(-1.0)), 4).alias("avg_hours")))


@query("temporal_meta", """
SELECT 'Q' || quarter(o_orderdate) || ' ' || year(o_orderdate) AS quarter,
  year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS n
FROM orders GROUP BY 1, 2, 3""")
def temporal_meta(t):
    created = F.col("o_orderdate")
    return t.orders.groupBy(E.quarter_label(created).alias("quarter"), F.year(created).alias("year"),
                            F.month(created).alias("month")).agg(F.count("*").alias("n"))


NOW = "2000-06-15 12:00:00"


@query("case_age", f"""
SELECT o_orderkey, coalesce(CASE WHEN epoch(TIMESTAMP '{NOW}') >= epoch(o_orderdate) THEN
  cast(floor((epoch(TIMESTAMP '{NOW}') - epoch(o_orderdate)) / 86400) AS INTEGER) END, -1) AS age_days
FROM orders""")
def case_age(t):
    age = E.case_age_days(F.col("o_orderdate"), F.to_timestamp(F.lit(NOW)))
    return t.orders.select("o_orderkey", F.coalesce(age, F.lit(-1)).alias("age_days"))


@query("case_enrichment", f"""
WITH {CASES_SQL},
h AS (SELECT o_orderkey, created, closed, (epoch(closed) - epoch(created)) / 3600 AS hours,
  epoch(TIMESTAMP '{NOW}') - epoch(created) AS age FROM cases),
e AS (SELECT h.o_orderkey, o_orderstatus AS status, CASE WHEN o_orderpriority = '1-URGENT' THEN ''
  ELSE 'SW - ' || o_orderpriority END AS raw, created, closed, hours, age
  FROM h JOIN orders o ON o.o_orderkey = h.o_orderkey),
f AS (SELECT o_orderkey AS case_id, CASE WHEN raw = '' THEN 'Uncategorized' ELSE
    'Software > ' || concat_ws(' > ', trim(string_split(raw, '-')[2]), trim(string_split(raw, '-')[3]))
    END AS category,
  CASE WHEN closed IS NULL THEN 'Open' WHEN hours < 0 THEN 'Invalid' WHEN hours < 4 THEN '0-4 hours'
  WHEN hours < 24 THEN '4-24 hours' WHEN hours < 168 THEN '1-7 days' ELSE '>7 days' END AS bucket,
  'Q' || quarter(created) || ' ' || year(created) AS quarter, age, status, created FROM e)
SELECT case_id, category, bucket, quarter, status, o_orderpriority AS priority, 'ring' AS product, 'Other' AS family,
  year(created)::INTEGER AS year, month(created)::INTEGER AS month,
  CASE WHEN age >= 0 THEN floor(age / 86400)::BIGINT END AS age_days, concat_ws('; ',
  CASE WHEN category = 'Uncategorized' THEN 'Category is uncategorized' END,
  CASE WHEN age < 0 THEN 'Invalid creation date' END,
  CASE WHEN bucket = 'Invalid' THEN 'Invalid date range: ClosedDate before CreatedDate' END)
  AS warnings FROM f JOIN orders ON o_orderkey = case_id""")
def case_enrichment(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    none = F.lit(None).cast("string")
    cases = dated_cases(t).join(orders, "o_orderkey").select(
        F.col("o_orderkey").cast("string").alias("caseNumber"), F.col("o_orderkey").alias("caseId"),
        F.lit("ring").alias("product"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"), none.alias("errorCodes"),
        none.alias("issueType"), none.alias("resolutionCode"), none.alias("rootCause"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(
            F.concat(F.lit("SW - "), "o_orderpriority")).alias("category"),
        F.col("created").alias("createdDate"), F.col("closed").alias("closedDate"))
    rich = E.enrich(cases, F.to_timestamp(F.lit(NOW)))
    return rich.select(
        F.col("caseId").alias("case_id"), "category", F.col("resolutionTimeBucket").alias("bucket"),
        "quarter", "status", "priority", "product", F.col("productFamily").alias("family"), "year", "month",
        F.col("ageInDays").cast("bigint").alias("age_days"), F.array_join(E.enrichment_warnings(
            F.col("productFamily"), F.col("category"), F.col("ageInDays"),
            F.col("resolutionTimeBucket")), "; ").alias("warnings"))


@query("category_variants", """
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'HW' ELSE 'NET' END || ' - ' || p_type || ' - ' || p_brand
  || ' - ' || CASE WHEN p_size % 3 = 0 THEN 'SW' ELSE p_name END AS c, p_size FROM part)
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'Hardware' ELSE 'NET' END || ' > '
    || array_to_string(list_transform(string_split(c, '-')[2:], lambda x: trim(x)), ' > ') AS full_path,
  array_to_string(list_transform(string_split(c, ' - '), lambda x: CASE x WHEN 'HW' THEN 'Hardware' WHEN 'SW' THEN 'Software'
    WHEN 'NET' THEN 'Network' WHEN 'STOR' THEN 'Storage' ELSE x END), ' > ') AS mapped_path FROM p""")
def category_variants(t):
    raw = F.concat_ws(" - ", F.when(F.col("p_size") % 2 == 0, "HW").otherwise("NET"), "p_type", "p_brand",
                      F.when(F.col("p_size") % 3 == 0, "SW").otherwise(F.col("p_name")))
    return t.part.select("p_partkey", E.category_full_path(raw).alias("full_path"),
                         E.category_path_every_level(raw).alias("mapped_path"))


@query("category_drilldown", """
SELECT p_type AS level1, count(*) AS n,
  count(*) FILTER (WHERE p_type || ' > ' || p_brand || ' > ' || p_name LIKE 'PROMO > Brand#2 > %'
    OR p_type || ' > ' || p_brand || ' > ' || p_name = 'PROMO > Brand#2') AS below_brand
FROM part GROUP BY 1""")
def category_drilldown(t):
    path = F.concat_ws(" > ", "p_type", "p_brand", "p_name")
    return t.part.groupBy(F.col("p_type").alias("level1")).agg(
        F.count("*").alias("n"),
        F.count_if(E.in_category(path, "PROMO > Brand#2")).alias("below_brand"))


# -- assembly -----------------------------------------------------------------

def order_children(t):
    rows = t.lineitem
    return [A.Child("tasks", rows.filter(F.col("l_linestatus") == "O"), "l_orderkey",
                    {"partkey": F.col("l_partkey")}, F.col("l_linenumber"), F.col("l_partkey")),
            A.Child("workorders", rows.filter(F.col("l_linestatus") == "F"), "l_orderkey",
                    {"partkey": F.col("l_partkey"), "qty": F.col("l_quantity").cast("int")},
                    F.col("l_linenumber"),
                    F.concat_ws(":", F.col("l_partkey").cast("string"),
                                F.col("l_quantity").cast("int").cast("string")))]


@query("child_assembly", """
WITH a AS (SELECT l_orderkey, string_agg(l_partkey, ',' ORDER BY l_linenumber,
             l_partkey::VARCHAR) AS tasks, count(*) AS n
           FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
b AS (SELECT l_orderkey, string_agg(l_partkey || ':' || cast(l_quantity AS INTEGER), ','
        ORDER BY l_linenumber, l_partkey || ':' || cast(l_quantity AS INTEGER)) AS workorders, count(*) AS n
      FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT o_orderkey, coalesce(tasks, '') AS tasks, coalesce(workorders, '') AS workorders,
  coalesce(a.n, 0) AS tasks_count, coalesce(b.n, 0) AS workorders_count
FROM orders LEFT JOIN a ON a.l_orderkey = o_orderkey LEFT JOIN b ON b.l_orderkey = o_orderkey""")
def child_assembly(t):
    cases = A.assemble(t.orders.select("o_orderkey"), "o_orderkey", order_children(t))
    return cases.select(
        "o_orderkey", F.array_join(F.transform("tasks", lambda r: r["partkey"].cast("string")), ",")
        .alias("tasks"),
        F.array_join(F.transform("workorders", lambda r: F.concat_ws(
            ":", r["partkey"].cast("string"), r["qty"].cast("string"))), ",").alias("workorders"),
        "tasks_count", "workorders_count")


@query("latest3_children", """
SELECT l_orderkey, rank, l_linenumber FROM (
  SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) AS rank FROM lineitem)
WHERE rank <= 3""")
def latest3_children(t):
    return A.latest_children(t.lineitem, "l_orderkey", "l_shipdate", 3,
                             ["l_linenumber", "l_partkey", "l_suppkey"]
                             ).select("l_orderkey", "rank", "l_linenumber")


@query("child_counts", """
SELECT o_orderkey, count(l_orderkey) FILTER (WHERE l_linestatus = 'O') AS tasks_count,
  count(l_orderkey) FILTER (WHERE l_linestatus = 'F') AS workorders_count
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def child_counts(t):
    return A.child_counts(t.orders, "o_orderkey", order_children(t))


@query("join_coverage", """
WITH c AS (SELECT o_orderkey, count(l_orderkey) FILTER (WHERE l_linestatus = 'O') AS a,
  count(l_orderkey) FILTER (WHERE l_linestatus = 'F') AS b
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
m AS (SELECT 'tasks' AS "table", avg(CASE WHEN a > 0 THEN 1.0 ELSE 0.0 END) AS coverage,
  avg(a) AS mean_children FROM c
  UNION ALL SELECT 'workorders', avg(CASE WHEN b > 0 THEN 1.0 ELSE 0.0 END), avg(b) FROM c)
SELECT "table", round(coverage, 6) AS coverage, round(mean_children, 6) AS mean_children,
  0.7::DOUBLE AS floor, coverage < 0.7 AS low FROM m""")
def join_coverage(t):
    counts = A.child_counts(t.orders, "o_orderkey", order_children(t))
    cover = A.join_coverage(counts, ["tasks", "workorders"])
    flags = A.coverage_flags(cover, {"tasks": 0.70, "workorders": 0.70})
    return flags.select(
        "table", F.round("coverage", 6).alias("coverage"),
        F.round("mean_children", 6).alias("mean_children"), "floor", "low")


@query("two_hop_children", """
SELECT c_custkey, count(*) AS feeds, cast(sum(l_quantity) AS BIGINT) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY 1""")
def two_hop_children(t):
    feeds = A.two_hop(t.lineitem, "l_orderkey", t.orders, "o_orderkey", "o_custkey")
    known = A.for_parents(feeds, "case_key", t.customer, "c_custkey")
    return known.groupBy(F.col("case_key").alias("c_custkey")).agg(
        F.count("*").alias("feeds"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@query("presence_check", """
SELECT count(*) AS total_expected, count(f.l_orderkey) AS found,
  count(*) - count(f.l_orderkey) AS missing,
  round(count(f.l_orderkey)::DOUBLE / count(*), 6) AS success_rate
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) f ON l_orderkey = o_orderkey""")
def presence_check(t):
    stored = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return A.presence(t.orders, stored, "o_orderkey").withColumn(
        "success_rate", F.round("success_rate", 6))


@query("missing_children", """
SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def missing_children(t):
    return A.missing_ids(t.orders, t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")),
                         "o_orderkey")


def document_cases(t):
    return t.documents.select(
        "doc_id", F.col("doc_id").cast("string").alias("caseNumber"), F.col("source").alias("subject"),
        F.col("lang").alias("status"), F.col("text").alias("description"),
        F.col("source").alias("environment"), F.col("lang").alias("category"))


def document_children(t):
    turns = t.conversations
    user = F.col("role") == "user"
    return [
        A.Child("casecomments", turns.filter(user), "conv_id", {"commentBody": F.col("text")},
                F.col("turn")),
        A.Child("workorderfeeds", t.pages, "page_id", {"body": F.col("html")}),
        A.Child("emails", turns.filter(~user), "conv_id",
                {"subject": F.col("role"), "textBody": F.col("text")}, F.col("turn"))]


@query("composite_case_text", f"""
WITH comments AS (SELECT conv_id, string_agg({sql_clean('text')}, ' | ' ORDER BY turn) AS s
    FROM conversations WHERE role = 'user' AND text <> '' GROUP BY 1),
emails AS (SELECT conv_id, string_agg(role || CASE WHEN text <> '' THEN ' | ' || {sql_clean('text')}
    ELSE '' END, ' | ' ORDER BY turn) AS s FROM conversations WHERE role <> 'user' GROUP BY 1),
joined AS (SELECT doc_id, concat_ws(chr(10) || chr(10),
  'Case: ' || doc_id || ' | ' || source || ' | Status: ' || lang,
  CASE WHEN text <> '' THEN 'ISSUE: ' || {sql_clean('text')} END,
  'ENVIRONMENT: ' || source || ' | ' || lang,
  'COMMENTS: ' || c.s, 'SERVICE NOTES: ' || {sql_clean('html')}, 'EMAILS: ' || e.s) AS s
  FROM documents LEFT JOIN comments c ON c.conv_id = doc_id LEFT JOIN emails e ON e.conv_id = doc_id
  LEFT JOIN pages ON page_id = doc_id)
SELECT doc_id, length(s) AS full_length, length(s) > 30000 AS was_truncated,
  CASE WHEN length(s) > 30000 THEN substr(substr(s, 1, 24000) || chr(10) || chr(10)
    || '[...TRUNCATED...]' || chr(10) || chr(10) || right(s, 6000), 1, 30000) ELSE s END
  AS "compositeText" FROM joined""")
def composite_case_text(t):
    return A.composite_texts(document_cases(t), "doc_id", document_children(t))


@query("composite_checks", """
WITH u AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'user'),
s AS (SELECT doc_id, 2 + CASE WHEN text <> '' THEN 1 ELSE 0 END + CASE WHEN u.conv_id IS NOT NULL THEN 1 ELSE 0 END AS sections,
  text <> '' AS issue, u.conv_id IS NOT NULL AS child FROM documents LEFT JOIN u ON u.conv_id = doc_id)
SELECT sections, issue, child, count(*) AS cases FROM s GROUP BY ALL""")
def composite_checks(t):
    cases = A.assemble(document_cases(t), "doc_id", document_children(t)[:1])
    text = A.composite_text(cases.columns)
    checked = cases.select(A.composite_checks(
        text, F.col("casecomments_count"), F.lit(0)).alias("c"))
    return checked.select(
        "c.sections", (F.col("c.words")["ISSUE"] > 0).alias("issue"),
        (~F.array_contains("c.failed", "children attached")).alias("child")).groupBy(
        "sections", "issue", "child").agg(F.count("*").alias("cases"))


@query("composite_structure", f"""
WITH users AS (SELECT conv_id, count(*) AS n FROM conversations WHERE role = 'user' GROUP BY 1)
SELECT 3 + (CASE WHEN page_id IS NOT NULL THEN 1 ELSE 0 END)
         + (CASE WHEN u.conv_id IS NOT NULL THEN 1 ELSE 0 END)
         + (CASE WHEN e.conv_id IS NOT NULL THEN 1 ELSE 0 END) AS sections, count(*) AS cases
FROM documents LEFT JOIN pages ON page_id = doc_id LEFT JOIN users u ON u.conv_id = doc_id
LEFT JOIN (SELECT DISTINCT conv_id FROM conversations WHERE role <> 'user') e ON e.conv_id = doc_id
GROUP BY 1""")
def composite_structure(t):
    cases = A.assemble(document_cases(t), "doc_id", document_children(t))
    text = A.composite_text(cases.columns)
    return (cases.select(F.size(F.split(text, r"\n\n", -1)).alias("sections"))
            .groupBy("sections").agg(F.count("*").alias("cases")))


@query("transformed_cases", f"""
WITH c AS (SELECT conv_id, text FROM conversations WHERE turn = 0),
j AS (SELECT doc_id, source || CASE WHEN d.text <> '' THEN ' | ' || d.text ELSE '' END AS issue, coalesce(c.text, '') AS resolution
  FROM documents d LEFT JOIN c ON conv_id = doc_id),
t AS (SELECT doc_id, {sql_clean("issue")} AS issue, {sql_clean("resolution")} AS resolution FROM j)
SELECT doc_id::VARCHAR AS "Id", md5(issue) AS issue_md5, md5(nullif(resolution, '')) AS resolution_md5,
  CASE WHEN resolution = '' THEN 'missing: resolution_text' END AS error FROM t""")
def transformed_cases(t):
    """Join, issue and resolution text, cleaning and validation in one flow."""
    cases = t.documents.select(F.col("doc_id").cast("string").alias("Id"), F.col("source").alias("Subject"),
                               F.col("text").alias("Description"))
    comments = t.conversations.filter("turn = 0").select(
        F.col("text").alias("CommentBody"), F.col("conv_id").cast("string").alias("ParentId"))
    none = t.spark.createDataFrame([], "Subject string, CaseId string")
    done = A.transform_cases(cases, none, none, comments)
    return done.select("Id", F.md5("issue_text").alias("issue_md5"), F.md5("resolution_text").alias("resolution_md5"), "error")
