"""Queries over what crosses the border: child exports, staged files, fixtures,
logs, change files and stored rules. They write under the shared folder and read
the given tables in full."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casequarry import schemas as S
from casequarry.functions import pii
from casequarry.functions import pii_rules as R
from casequarry.operators import assemble as A
from casequarry.operators import quality as Q
from casequarry.operators.compliance import red_team
from casequarry.plans.flow_queries import export_cases, work_folder
from casequarry.plans.quality_queries import CHANGES_SQL
from casequarry.plans.registry import query
from casequarry.sources import exports, sinks
from casequarry.sources.snapshots import Snapshot


@query("child_exports", """
SELECT 'workorder' AS "table", count(*) AS "rows", count(DISTINCT l_orderkey) AS parents, sum(length(l_linestatus)) AS characters FROM lineitem
UNION ALL SELECT 'casecomment', count(*), count(DISTINCT conv_id), sum(length(text)) FROM conversations WHERE role = 'user'
UNION ALL SELECT 'workorderfeed', count(*), count(DISTINCT page_id), sum(length(html)) FROM pages
UNION ALL SELECT 'emailmessage', count(*), count(DISTINCT conv_id), sum(length(text)) FROM conversations WHERE role <> 'user'""")
def child_exports(t):
    """Four child tables written as envelopes and read back by their schemas."""
    def text(c):
        return F.col(c).cast("string")
    turns = t.conversations
    frames = {
        "workorder": (t.lineitem.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("WorkOrderNumber"), F.col("l_linestatus").alias("Subject"),
            text("l_orderkey").alias("CaseId")), "CaseId", "Subject"),
        "casecomment": (turns.filter("role = 'user'").select(
            F.col("text").alias("CommentBody"), text("conv_id").alias("ParentId")), "ParentId", "CommentBody"),
        "workorderfeed": (t.pages.select(
            F.lit("page").alias("Type"), F.col("html").alias("Body"), text("page_id").alias("ParentId")), "ParentId", "Body"),
        "emailmessage": (turns.filter("role <> 'user'").select(
            F.col("role").alias("Subject"), F.col("text").alias("TextBody"), text("conv_id").alias("ParentId")),
            "ParentId", "TextBody")}
    folder, parts = work_folder(t), []
    for name, (frame, key, body) in frames.items():
        sinks.write_envelopes(frame, f"{folder}/{name}", key, 5000)
        back = exports.read_table(t.spark, folder, name, f"{folder}/{name}")
        parts.append(back.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("parents"),
                              F.sum(F.length(body)).alias("characters")).withColumn("table", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


@query("child_quality_issues", """
WITH e AS (SELECT CASE WHEN conv_id % 10 <> 0 THEN conv_id END AS k, CASE WHEN turn <> 1 THEN text END AS b FROM conversations),
n AS (SELECT count(*) FILTER (k IS NULL) AS keys, count(*) FILTER (b IS NULL) AS bodies FROM e)
SELECT 'emailmessage' AS "table", 'error' AS severity, 'required_null' AS rule,
  'emailmessage: ' || bodies || ' null values in required field ''TextBody''' AS message, bodies AS n FROM n
UNION ALL SELECT 'emailmessage', 'error', 'required_null', 'emailmessage: ' || keys || ' null values in required field ''ParentId''', keys FROM n
UNION ALL SELECT 'emailmessage', 'error', 'null_key', 'emailmessage: ' || keys || ' emails with null ParentId', keys FROM n
UNION ALL SELECT 'emailmessage', 'warning', 'null_body', 'emailmessage: ' || bodies || ' emails with null TextBody', bodies FROM n
UNION ALL SELECT 'task', 'error', 'empty', 'task: DataFrame is empty', 0::BIGINT WHERE (SELECT count(*) FROM orders WHERE o_totalprice < 0) = 0""")
def child_quality_issues(t):
    """Null keys and bodies of mails, and a table without rows."""
    mails = t.conversations.select(
        F.col("role").alias("Subject"), F.when(F.col("turn") != 1, F.col("text")).alias("TextBody"),
        F.when(F.col("conv_id") % 10 != 0, F.col("conv_id").cast("string")).alias("ParentId"))
    none = t.orders.filter("o_totalprice < 0").select(
        F.lit(S.TASK_TYPES[0]).alias("Type"), F.lit("x").alias("Description"), F.col("o_orderkey").cast("string").alias("CaseId"))
    return Q.quality_issues(mails, "emailmessage").unionByName(Q.quality_issues(none, "task"))


@query("structure_board", """
SELECT 'required_key' AS rule, count(*) AS documents FROM orders WHERE o_orderstatus = 'P' HAVING count(*) > 0
UNION ALL SELECT 'bad_json', count(*) FROM benchmark HAVING count(*) > 0""")
def structure_board(t):
    """Records without a required key, and documents that are not JSON."""
    folder = work_folder(t)
    cases = export_cases(t).withColumn("Status", F.when(F.col("Status") != "P", F.col("Status")))
    sinks.write_envelopes(cases, f"{folder}/cases", "Id", 2000)
    t.benchmark.select("text").write.option("maxRecordsPerFile", 1).text(f"{folder}/texts")
    found = Q.structure_issues(t.spark, f"{folder}/cases", "case").unionByName(
        Q.structure_issues(t.spark, f"{folder}/texts", "case"))
    # Which record comes first in a document is open, so the first one's second report is left out.
    return found.filter("rule != 'required_key_table'").groupBy("rule").agg(F.count("*").alias("documents"))


@query("staged_hand_off", """
SELECT o_orderstatus AS status, count(*) AS "rows", round(sum(o_totalprice), 2) AS total,
  (SELECT count(*) FROM part) AS parts FROM orders GROUP BY 1""")
def staged_hand_off(t):
    """Two tables staged, one by partition; a stage's result handed on by run."""
    folder = work_folder(t)
    sinks.stage({"orders": t.orders, "part": t.part}, f"{folder}/staged", ["o_orderstatus"])
    orders = t.spark.read.parquet(f"{folder}/staged/orders")
    parts = t.spark.read.parquet(f"{folder}/staged/part").agg(F.count("*")).scalar()
    counted = orders.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count("*").alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return sinks.hand_off(counted, f"{folder}/hand_off", "first").withColumn("parts", parts)


@query("collection_schema", """
SELECT o_orderstatus AS status, count(*) AS objects, 30 AS properties, 'missing caseId' AS first_gap FROM orders GROUP BY 1""")
def collection_schema(t):
    """Orders as objects of the collection: they pass the schema gate, orders themselves do not."""
    have = {"caseId": F.col("o_orderkey"), "accountId": F.col("o_custkey"), "status": F.col("o_orderstatus"),
            "priority": F.col("o_orderpriority"), "createdDate": F.col("o_orderdate")}
    objects = t.orders.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.COLLECTION])
    gap = S.schema_differences(t.orders.schema, S.COLLECTION)[0]
    return sinks.schema_gate(objects).groupBy("status").agg(F.count("*").alias("objects")).select(
        "status", "objects", F.lit(len(objects.columns)).alias("properties"), F.lit(gap).alias("first_gap"))


@query("nested_fixture", """
SELECT 'case' AS "table", count(*) AS "rows", sum(length(text)) AS characters FROM documents
UNION ALL SELECT 'casecomment', count(*), sum(length(text)) FROM conversations
WHERE role = 'user' AND conv_id IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'workorder', 0, NULL""")
def nested_fixture(t):
    """Cases with nested children, one mapping document a line, split into flat tables."""
    cases = t.documents.select(F.col("doc_id").cast("string").alias("Id"), F.col("text").alias("Description"))
    turns = t.conversations.filter("role = 'user'").withColumn("case", F.col("conv_id").cast("string"))
    whole = A.assemble(cases, "Id", [A.Child("comments", turns, "case", {"CommentBody": F.col("text")}, F.col("turn"))])
    entry = F.struct(F.col("Id").alias("name"), F.struct("Id", "Description").alias("Case"), F.col("comments").alias("CaseComments"))
    folder = work_folder(t)
    whole.select(F.to_json(F.struct(F.create_map("Id", entry).alias("sample_data"))).alias("value")).write.text(folder)
    flat = exports.split_nested(exports.nested_cases(t.spark, folder, lines=True))
    body = {"case": "Description", "casecomment": "CommentBody", "workorder": "Description"}
    return reduce(DataFrame.unionByName, [
        flat[name].agg(F.count("*").alias("rows"), F.sum(F.length(c)).alias("characters")).withColumn("table", F.lit(name))
        for name, c in body.items()])


@query("csv_round_trip", """
SELECT p_brand, count(*) AS "rows", sum(p_size) AS sizes, count(DISTINCT p_name) AS names FROM part GROUP BY 1""")
def csv_round_trip(t):
    folder = work_folder(t)
    sinks.write_csv(t.part, folder)
    back = t.spark.read.option("header", True).schema(t.part.schema).csv(folder)
    return back.groupBy("p_brand").agg(F.count("*").alias("rows"), F.sum("p_size").alias("sizes"),
                                       F.countDistinct("p_name").alias("names"))


@query("change_files", """
SELECT event_type, count(*) AS n, cast(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1""")
def change_files(t):
    """Change events as files, read once as a stream that archives what it read."""
    folder = work_folder(t)
    t.events.select("event_id", "event_type").write.json(f"{folder}/in")
    stream = sinks.change_stream(t.spark, f"{folder}/in", "event_id bigint, event_type string", archive=f"{folder}/archive")
    stream.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{folder}/out").groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("search_log_days", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS searches, cast(sum(floor(value)) AS BIGINT) AS results,
  count(DISTINCT event_type) AS filters FROM events GROUP BY 1""")
def search_log_days(t):
    """Log rows appended by day and read back."""
    asked = t.events.select(
        "user_id", F.col("props").alias("query"), F.create_map(F.lit("status"), F.col("event_type")).alias("filters"),
        F.floor("value").alias("result_count"), F.col("ts").cast("timestamp").alias("ts"))
    folder = work_folder(t)
    sinks.append(sinks.search_log(asked, F.col("ts")), folder, "logged_at")
    back = t.spark.read.parquet(folder)
    return back.groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count("*").alias("searches"), F.sum("result_count").alias("results"), F.countDistinct("filters").alias("filters"))


@query("labelled_case_text", """
WITH u AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations WHERE role = 'user'),
c AS (SELECT conv_id, chr(10) || chr(10) || '=== ENGINEER COMMENTS ===' || coalesce(chr(10)
  || string_agg(CASE WHEN text <> '' THEN 'Comment ' || i || ': ' || text END, chr(10) ORDER BY i), '') AS block FROM u GROUP BY 1)
SELECT doc_id, md5('CASE NUMBER: ' || doc_id || chr(10) || 'CASE ID: ' || doc_id || chr(10) || chr(10) || '=== ISSUE ===' || chr(10)
  || 'SUBJECT: ' || source || chr(10) || 'DESCRIPTION: ' || coalesce(text, '') || coalesce(block, '')
  || chr(10) || chr(10) || '=== RESOLUTION ===' || chr(10) || 'ROOT CAUSE: ' || source
  || chr(10) || chr(10) || '=== METADATA ===' || chr(10) || 'PRODUCT NUMBER: ' || lang
  || chr(10) || 'PRODUCT LINE: ' || chr(10) || 'ISSUE TYPE: ') AS text_md5
FROM documents LEFT JOIN c ON conv_id = doc_id""")
def labelled_case_text(t):
    """The labelled template, comments numbered."""
    cases = t.documents.select(
        "doc_id", F.col("doc_id").alias("id"), F.col("doc_id").alias("casenumber"), F.col("source").alias("subject"),
        F.col("text").alias("description"), F.col("source").alias("root_cause"), F.col("lang").alias("product_number"))
    turns = t.conversations.filter("role = 'user'")
    whole = A.assemble(cases, "doc_id", [A.Child("comments", turns, "conv_id", {"commentbody": F.col("text")}, F.col("turn"))])
    return whole.select("doc_id", F.md5(A.labelled_text(whole.columns)).alias("text_md5"))


@query("red_team_prepared", """
SELECT item_id, 'FAIL' AS plain, 'PASS' AS prepared FROM benchmark""")
def red_team_prepared(t):
    """A hidden address per text: missed as it stands, found once it is undone."""
    hidden = F.concat(F.lit("Contact user"), F.col("item_id").cast("string"), F.lit("[dot]x[at]acme[dot]com"))
    expected = F.array(F.lit("email")).alias("expected")
    plain = red_team(t.benchmark.select("item_id", hidden.alias("text"), expected))
    whole = red_team(t.benchmark.select("item_id", F.concat_ws(" ", "text", hidden).alias("text"), expected), prepare=True)
    return plain.select("item_id", F.col("status").alias("plain")).join(
        whole.select("item_id", F.col("status").alias("prepared")), "item_id")


@query("own_recogniser", r"""
SELECT doc_id, 'ORDER_NO' AS type, len(regexp_extract_all(text, '\b[0-9]{3,4}\b')) AS n FROM documents
WHERE regexp_matches(text, '\b[0-9]{3,4}\b')""")
def own_recogniser(t):
    """A recogniser added to stored rules, read back and run; one row per detection is counted."""
    own = R.Rule("ORDER_NO", r"\b[0-9]{3,4}\b", 0.6, "own", guard="[0-9]")
    stored = R.rules_frame(t.spark, {"own": R.with_rules([], own), "flat": R.FLAT})
    rules = R.rules_from_frame(stored, "own")
    rows = pii.detection_rows(t.documents, "doc_id", "text", rules=rules, classes="ascii")
    return rows.groupBy("doc_id", "type").agg(F.count("*").alias("n"))


@query("pii_decoded", """
SELECT item_id, md5(text) AS decoded_md5, 'Dial 18003333' || lpad((item_id % 1000)::VARCHAR, 3, '0') || ' now' AS dialled FROM benchmark""")
def pii_decoded(t):
    """Base64 words decoded, telephone letters turned into digits."""
    coded = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"\s", "")  # no line ends inside
    letters = F.concat(F.lit("Dial 1-800-DEED-"), F.lpad((F.col("item_id") % 1000).cast("string"), 3, "0"), F.lit(" now"))
    return t.benchmark.select("item_id", F.md5(F.array_join(pii.decoded_tokens(coded), "")).alias("decoded_md5"),
                              pii.phone_letters(letters).alias("dialled"))


@query("upsert_buckets", f"""
WITH {CHANGES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey
  ORDER BY version DESC, o_orderstatus DESC, o_totalprice DESC) AS n FROM changes)
SELECT o_orderkey, version, o_orderstatus FROM r WHERE n = 1""")
def upsert_buckets(t):
    """Orders, then their lines as changes, merged into a snapshot in buckets."""
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(1).alias("version"))
    changes = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.concat(F.lit("L"), "l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"), (F.col("l_linenumber") + 1).alias("version"))
    folder, order = work_folder(t), F.struct("version", "o_orderstatus", "o_totalprice")
    for number, rows in enumerate((base, changes)):
        rows = rows.withColumn("v", order)
        sinks.upsert_buckets(rows, folder, "o_orderkey", "v", number, 16)
    return sinks.read_buckets(t.spark, folder, rows.schema).select("o_orderkey", "version", "o_orderstatus")


# -- snapshots that grow ---------------------------------------------------------------

def grown(t):
    """Orders, then their lines as changes, in leaves of at most 1,000 rows; then what urgent orders' customers have is deleted."""
    base = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.lit(1).alias("version"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.concat(F.lit("L"), "l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"), (F.col("l_linenumber") + 1).alias("version"))
    order = F.struct("version", "o_orderstatus", "o_totalprice")
    snapshot = Snapshot(t.spark, work_folder(t), "o_orderkey", "v", base.withColumn("v", order).schema, 1000)
    snapshot.upsert(base.withColumn("v", order), 0)
    snapshot.upsert(lines.withColumn("v", order), 1)
    snapshot.delete(t.orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey"), 2)
    return snapshot


@query("snapshot_grown", f"""
WITH {CHANGES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey
  ORDER BY version DESC, o_orderstatus DESC, o_totalprice DESC) AS n FROM changes)
SELECT o_orderkey, version, o_orderstatus FROM r WHERE n = 1
  AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def snapshot_grown(t):
    return grown(t).read().select("o_orderkey", "version", "o_orderstatus")


@query("snapshot_leaves", """
WITH k AS (SELECT o_orderkey FROM orders UNION SELECT l_orderkey FROM lineitem)
SELECT count(*)::BIGINT AS rows, true AS bounded, true AS covered, true AS kept FROM k""")
def snapshot_leaves(t):
    """Leaves hold all rows, none more than its capacity, cover every hash once, and a delete leaves their files."""
    snapshot = grown(t)
    leaves = t.spark.createDataFrame([(x.depth, x.path, x.n, len(x.hidden)) for x in snapshot.leaves()[1]], "depth int, path string, n long, hidden int")
    rows = snapshot.read().count()
    hidden = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_orderkey").distinct().count()
    return leaves.agg(F.sum("n").alias("rows"), (F.max("n") <= 1000).alias("bounded"), (F.sum(F.pow(F.lit(0.5), "depth")) == 1).alias("covered"),
                      (F.sum("n") == rows + hidden).alias("kept"))
