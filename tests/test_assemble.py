import pytest
from pyspark.sql import functions as F

from casequarry.functions import text as T
from casequarry.operators import assemble as A


def clean(text):
    import re
    text = re.sub(r"<[^>]+>", "", text)
    for entity, char in T.ENTITIES:
        text = text.replace(entity, char)
    return re.sub(r"\s+", " ", text).strip()


def brute(case, children):
    """Nine sections, joined and cut, straight from the definition."""
    head = [case["subject"]] if case.get("subject") else []
    sections = [" | ".join(([f"Case: {case['caseNumber']}"] if case.get("caseNumber") else []) + head)]
    issue = [clean(case[f]) for f in A.ISSUE_FIELDS if case.get(f)]
    if issue:
        sections.append("ISSUE: " + " | ".join(issue))
    for name, (number, fields) in A.CHILD_SECTIONS.items():
        texts = [clean(r[f]) for r in children.get(name, []) for f in fields if r.get(f)]
        if texts:
            sections.append(A.SECTIONS[number] + " | ".join(texts))
    full = "\n\n".join(sections)
    if len(full) <= 30000:
        return full
    return (full[:24000] + T.TRUNCATED + full[-6000:])[:30000]


def make(spark, cases, comments, mails):
    cases_df = spark.createDataFrame(cases, "id int, caseNumber string, subject string, description string")
    comments_df = spark.createDataFrame(comments, "cid int, at int, body string")
    mails_df = spark.createDataFrame(mails, "cid int, at int, subject string, body string")
    return cases_df, [
        A.Child("casecomments", comments_df, "cid", {"commentBody": F.col("body")}, F.col("at")),
        A.Child("emails", mails_df, "cid", {"subject": F.col("subject"), "textBody": F.col("body")}, F.col("at"))]


@pytest.fixture(scope="module")
def data(spark):
    cases = [(1, "C1", "boot", "<p>fails</p>"), (2, None, None, None), (3, "C3", None, "x" * 40000),
             (4, "C4", "hot", "h"), (5, "C5", "edge", "e"), (6, "C6", "", " ")]
    comments = [(1, 2, "second"), (1, 1, "<b>first</b>"), (2, 1, "<p></p>"), (2, 2, None), (9, 1, "no parent")]
    comments += [(4, i, f"comment {i} " + "c" * (i % 50)) for i in range(6000)]
    comments += [(5, i, "<i></i>") for i in range(12000)]
    mails = [(1, 1, "re", "body"), (1, 2, "", "only body"), (3, 1, "s", "y" * 35000), (4, 1, "last", "z" * 100)]
    return cases, comments, mails


def test_composite_equals_definition_for_ordinary_and_hot_cases(spark, data):
    cases, comments, mails = data
    cases_df, children = make(spark, cases, comments, mails)
    got = {r["id"]: r for r in A.composite_texts(cases_df, "id", children).collect()}
    assert set(got) == {c[0] for c in cases}
    for cid, number, subject, description in cases:
        case = {"caseNumber": number, "subject": subject, "description": description}
        kids = {"casecomments": [{"commentBody": b} for i, at, b in sorted(
                    comments, key=lambda r: (r[0], r[1])) if i == cid],
                "emails": [{"subject": s, "textBody": b} for i, at, s, b in mails if i == cid]}
        assert got[cid]["compositeText"] == brute(case, kids), cid


def test_row_form_agrees_with_distributed_form(spark, data):
    cases, comments, mails = data
    cases_df, children = make(spark, cases, comments, mails)
    rows = A.assemble(cases_df, "id", children)
    text = T.smart_truncate(A.composite_text(rows.columns))
    one_row = {r["id"]: r["t"] for r in rows.select("id", text.alias("t")).collect()}
    flat = {r["id"]: r["compositeText"] for r in A.composite_texts(cases_df, "id", children).collect()}
    assert one_row == flat


def test_a_case_is_one_row_at_any_size(spark, data):
    cases, comments, mails = data
    cases_df, children = make(spark, cases, comments, mails)
    rows = {r["id"]: r for r in A.assemble(cases_df, "id", children).collect()}
    assert len(rows) == cases_df.count()
    assert rows[4]["casecomments_count"] == 6000
    assert sorted(c["commentBody"] for c in rows[4]["casecomments"]) == sorted(b for i, _, b in comments if i == 4)
    assert [c["commentBody"] for c in rows[1]["casecomments"]] == ["<b>first</b>", "second"]
    assert rows[6]["emails"] == [] and rows[6]["emails_count"] == 0
    long = A.child_rows(cases_df, "id", children)
    assert {(r["id"], r["child"]): r["n"] for r in long.groupBy("id", "child").agg(F.count("*").alias("n")).collect()}[
        4, "casecomments"] == 6000


def test_small_join_fixture(spark):
    cases = spark.createDataFrame([("case1",), ("case2",)], "Id string")
    kids = lambda rows, key: spark.createDataFrame(rows, f"{key} string, t string")
    children = [A.Child("tasks", kids([("case1", "a")], "k"), "k", {"t": F.col("t")}),
                A.Child("workorders", kids([("case1", "b")], "k"), "k", {"t": F.col("t")}),
                A.Child("casecomments", kids([("case1", "c"), ("case2", "d")], "k"), "k", {"t": F.col("t")})]
    rows = {r["Id"]: r for r in A.assemble(cases, "Id", children).collect()}
    assert [rows["case1"][f"{n}_count"] for n in ("tasks", "workorders", "casecomments")] == [1, 1, 1]
    assert [rows["case2"][f"{n}_count"] for n in ("tasks", "workorders", "casecomments")] == [0, 0, 1]
    counts = A.child_counts(cases, "Id", children)
    cover = A.join_coverage(counts, ["tasks", "workorders", "casecomments"])
    assert cover.first()["tasks_coverage"] == 0.5 and cover.first()["casecomments_coverage"] == 1.0
    low = {r["table"]: r["low"] for r in A.coverage_flags(cover).collect()}
    assert low == {"tasks": True, "workorders": True, "casecomments": False}


def test_labelled_template(spark):
    df = spark.createDataFrame(
        [("5001", "S", "D", [("T1", "do it"), (None, "again")], ["hello", ""], [("m", "x" * 600)] * 4)],
        "casenumber string, subject string, description string, tasks array<struct<subject:string,description:string>>, "
        "c array<string>, emails array<struct<subject:string,textbody:string>>")
    df = df.withColumn("comments", F.transform("c", lambda x: F.struct(x.alias("commentbody")))).drop("c")
    text = df.select(A.labelled_text(df.columns).alias("t")).first()["t"]
    assert text.startswith("CASE NUMBER: 5001\nCASE ID: N/A\n\n=== ISSUE ===\nSUBJECT: S\nDESCRIPTION: D\n"
                           "\n=== TROUBLESHOOTING STEPS ===\n\nTASK 1 - T1:\ndo it\nagain\n"
                           "\n=== ENGINEER COMMENTS ===\nComment 1: hello\n\n=== EMAIL COMMUNICATIONS ===\n"
                           "\nEmail 1 Subject: m\nEmail Body: " + "x" * 500 + "...\n\nEmail 2")
    assert "Email 4" not in text
    assert text.endswith("\n\n=== RESOLUTION ===\n\n=== METADATA ===\nPRODUCT NUMBER: \nPRODUCT LINE: \nISSUE TYPE: ")


def test_transform_cases(spark):
    cases = spark.createDataFrame([("1", "s", "d", "<p>fixed</p>"), ("2", None, None, None)],
                                  "Id string, Subject string, Description string, Resolution__c string")
    tasks = spark.createDataFrame([("Plan of Action", "step", "1")], "Type string, Description string, CaseId string")
    orders = spark.createDataFrame([], "Subject string, CaseId string")
    comments = spark.createDataFrame([("note", "1")], "CommentBody string, ParentId string")
    rows = {r["Id"]: r for r in A.transform_cases(cases, tasks, orders, comments).collect()}
    assert rows["1"]["issue_text"] == "s | d" and rows["1"]["resolution_text"] == "fixed | step | note"
    assert rows["1"]["error"] is None
    assert rows["2"]["error"] == "missing: issue_text, resolution_text"
