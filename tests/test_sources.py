import json

import pytest
from pyspark.sql import functions as F

from casequarry import schemas as S
from casequarry.functions import vectors as V
from casequarry.operators import quality as Q
from casequarry.sources import exports, sinks

CASE = {"Id": "1", "CaseNumber": "5001", "Subject": "s", "Description": "d", "Status": "Closed", "Priority": "High"}


def write(folder, name, value):
    path = folder / name
    path.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")
    return str(path)


def full_export(folder, **changes):
    tables = {
        "cases.json": {"records": [CASE], "totalSize": 1, "done": True},
        "tasks.json": [{"Type": "Plan of Action", "Description": "x", "CaseId": "1"},
                       {"Type": "Call", "Description": "y", "CaseId": "1"}],
        "workorders.json": [{"WorkOrderNumber": "W1", "CaseId": "1", "Subject": "a", "Description": "b"}],
        "casecomments.json": [{"CommentBody": "c", "ParentId": "1"}],
        "workorderfeeds.json": [{"Type": "Note", "Body": "b", "ParentId": "1"}],
        "emailmessages.json": [{"Subject": "s", "TextBody": "t", "ParentId": "1"}]}
    tables.update(changes)
    for name, value in tables.items():
        if value is not None:
            write(folder, name, value)


@pytest.mark.parametrize("value, ids", [
    ([{"Id": "1"}, {"Id": "2"}], ["1", "2"]), ({"records": [{"Id": "1"}], "totalSize": 1, "done": True}, ["1"]),
    ({"Id": "9", "Status": "New"}, ["9"]), ({"records": []}, []), ([], [])])
def test_three_envelopes(spark, tmp_path, value, ids):
    df = exports.read_envelopes(spark, write(tmp_path, "cases.json", value), S.TABLES["case"], position="at")
    assert [r["Id"] for r in df.orderBy("at").collect()] == ids


def test_unreadable_document(spark, tmp_path):
    path = write(tmp_path, "cases.json", "{not json")
    with pytest.raises(Exception, match="unreadable JSON"):
        exports.read_envelopes(spark, path, S.TABLES["case"]).collect()
    assert exports.read_envelopes(spark, path, S.TABLES["case"], strict=False).count() == 0
    assert exports.unreadable(spark, path).count() == 1


def test_json_lines(spark, tmp_path):
    path = write(tmp_path, "c.json", '{"Id":"1"}\n{"Id":"2"}\n')
    assert exports.read_envelopes(spark, path, S.TABLES["case"], lines=True).count() == 2


def test_tasks_filtered_only_when_typed(spark, tmp_path):
    full_export(tmp_path)
    frames = exports.read_all(spark, str(tmp_path))
    assert [r["Description"] for r in frames["task"].collect()] == ["x"]
    assert {r["table"]: r["rows"] for r in exports.summary(frames).collect()}["task"] == 1
    untyped = write(tmp_path, "t.json", [{"Description": "x", "CaseId": "1"}])
    assert exports.read_table(spark, str(tmp_path), "task", untyped).count() == 1


def test_missing_files(spark, tmp_path):
    full_export(tmp_path, **{"tasks.json": None})
    assert [r["file"] for r in exports.missing_files(spark, str(tmp_path)).collect()] == ["tasks.json"]


def issues(spark, folder):
    return [(r["table"], r["severity"], r["rule"], r["message"], r["n"])
            for r in Q.validate_files(spark, str(folder)).collect()]


def test_valid_export_has_one_warning(spark, tmp_path):
    full_export(tmp_path)
    found = issues(spark, tmp_path)
    assert [f[:3] for f in found] == [("task", "warning", "type")] and found[0][3].endswith(": Call")
    verdict = {r["table"]: r for r in Q.verdicts(Q.validate_files(spark, str(tmp_path))).collect()}
    assert all(v["valid"] for v in verdict.values()) and verdict["task"]["warnings"] == 1


def test_invalid_export(spark, tmp_path):
    bad = [dict(CASE), dict(CASE, Status=None, Priority=None), dict(CASE, Id="2", Status="Odd", Priority="P1", Subject=None)]
    full_export(tmp_path, **{
        "cases.json": bad, "tasks.json": None, "workorders.json": '{"records": []}', "casecomments.json": "oops",
        "workorderfeeds.json": [{"Type": "a", "ParentId": None, "Body": None}],
        "emailmessages.json": [{"Subject": "s", "ParentId": "1"}, {"Subject": "s", "TextBody": "t", "ParentId": "1"}]})
    found = {(f[0], f[2]): f for f in issues(spark, tmp_path)}
    assert found["case", "duplicate"][4] == 1 and found["case", "required_null"][4] == 1
    statuses = [f[3] for f in issues(spark, tmp_path) if f[2] == "status"]
    assert sorted(s.split(": ")[-1] for s in statuses) == ["Odd", "null"]
    assert found["case", "priority"][3].endswith("P1")
    assert ("task", "missing_file") in found and ("workorder", "no_records") in found
    assert ("casecomment", "bad_json") in found
    assert found["workorderfeed", "null_key"][3] == "workorderfeed: 1 feeds with null ParentId"
    assert found["workorderfeed", "null_body"][1] == "warning"
    assert found["emailmessage", "required_key"][3] == "emailmessage record 0: Missing required fields: TextBody"
    assert ("emailmessage", "required_key_table") in found and ("emailmessage", "null_body") not in found
    verdict = {r["table"]: r for r in Q.verdicts(Q.validate_files(spark, str(tmp_path)), hide=True).collect()}
    assert not any(v["valid"] for v in verdict.values())
    assert verdict["workorderfeed"]["warnings"] == 0


def test_single_object_passes_the_scan_and_fails_validation(spark, tmp_path):
    full_export(tmp_path, **{"cases.json": CASE})
    assert ("case", "error", "bad_shape") in [f[:3] for f in issues(spark, tmp_path)]


def test_nested_fixture(spark, tmp_path):
    doc = {"sample_data": {"t1": {"name": "n", "Case": CASE, "Task": [{"Type": "Trouble Shooting", "Description": "d"}],
                                  "WorkOrder": [{"WorkOrderNumber": "W"}], "CaseComments": [{"CommentBody": "a"}, {"CommentBody": "b"}],
                                  "WorkOrderFeed": [{"Type": "x", "Body": "y"}], "EmailMessage": []}}}
    frames = exports.split_nested(exports.nested_cases(spark, write(tmp_path, "m.json", doc)))
    assert {t: df.count() for t, df in frames.items()} == {
        "case": 1, "task": 1, "workorder": 1, "casecomment": 2, "workorderfeed": 1, "emailmessage": 0}
    assert {r["ParentId"] for r in frames["casecomment"].collect()} == {"1"}


def test_flat_examples(spark):
    rows = [("d1", "Case", "Subject", "boot"), ("d1", "WorkOrder", "Subject", "visit"), ("d1", "CaseComments", "CommentBody", "c1"),
            ("d1", "CaseComments", "CommentBody", "c2"), ("d1", "WorkOrderFeed", "Body", "f"), ("d2", "Case", "Id", "X"),
            ("d2", "WorkOrderFeed", "Body", "g"), ("d2", "Task", "Description", "t"), ("d2", "Task", "Type", None)]
    out = exports.from_field_examples(spark.createDataFrame(rows, "dataset string, table string, field string, example string"))
    cases = {r["Id"]: r for r in out["case"].collect()}
    assert set(cases) == {"500Kh0000000001", "X"} and cases["X"]["CaseNumber"] == "5000100002"
    assert out["casecomment"].count() == 2
    order = out["workorder"].first()
    assert order["Id"] == "0WO1000000" and order["CaseId"] == "500Kh0000000001"
    assert {r["ParentId"] for r in out["workorderfeed"].collect()} == {"0WO1000000"}


def test_envelope_writer_round_trip(spark, tmp_path):
    df = spark.range(95).select(F.col("id").cast("string").alias("Id"))
    sinks.write_envelopes(df, str(tmp_path / "out"), "Id", rows_per_file=10)
    texts = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(texts) > 5 and all(json.loads(t)["done"] for t in texts)
    assert sum(json.loads(t)["totalSize"] for t in texts) == 95
    back = exports.read_envelopes(spark, str(tmp_path / "out"), S.TABLES["case"], lines=True)
    assert {r["Id"] for r in back.collect()} == {str(i) for i in range(95)}


def test_staging_backfill_and_hand_off(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00"), (3, "2024-01-02 11:00:00")], "id int, at string")
    sinks.stage({"t": df}, str(tmp_path / "s"), ["id"])
    assert spark.read.parquet(str(tmp_path / "s" / "t")).count() == 3
    days = sinks.backfill(df, str(tmp_path / "b"), F.col("at").cast("timestamp"))
    assert sorted(r["rows"] for r in days.collect()) == [1, 2]
    again = df.filter("id = 1").withColumn("id", F.lit(7))
    sinks.backfill(again, str(tmp_path / "b"), F.col("at").cast("timestamp"))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "b")).collect()) == [2, 3, 7]
    assert sinks.hand_off(df, str(tmp_path / "h"), "r1").count() == 3
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 3
    sinks.append(df.withColumn("at", F.col("at").cast("timestamp")), str(tmp_path / "a"), "at")
    sinks.append(df.withColumn("at", F.col("at").cast("timestamp")), str(tmp_path / "a"), "at")
    assert spark.read.parquet(str(tmp_path / "a")).count() == 6


def test_load_upsert_and_versions(spark, tmp_path):
    rows = [(1, [1.0] * 4), (2, [0.0] * 4), (3, [1.0] * 3), (4, None), (5, [float("nan")] * 4)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    folder = str(tmp_path / "col")
    assert tuple(sinks.load_batch(df, folder, "v", "id", 4).first()) == (1, 4)
    assert spark.read.parquet(folder + "/vectors").first()["vector"] == [1.0] * 4
    reasons = {r["id"]: r["error"] for r in spark.read.parquet(folder + "/failed").collect()}
    assert reasons == {2: "zero magnitude", 3: "wrong dimensions: 3", 4: "missing vector", 5: "not finite"}
    old = spark.createDataFrame([(1, 1, "a"), (2, 5, "b")], "id int, ver int, x string")
    new = spark.createDataFrame([(1, 2, "A"), (2, 4, "late"), (3, 1, "c")], "id int, ver int, x string")
    merged = {r["id"]: r["x"] for r in sinks.upsert(old, new, "id", "ver").collect()}
    assert merged == {1: "A", 2: "b", 3: "c"}
    assert sinks.current_version(spark, str(tmp_path / "v")) is None
    sinks.write_version(old, str(tmp_path / "v"), 1)
    sinks.write_version(new, str(tmp_path / "v"), 2)
    assert sinks.current_version(spark, str(tmp_path / "v")).endswith("version=00000002")
    with pytest.raises(ValueError, match="complete"):
        sinks.write_version(old, str(tmp_path / "v"), 2)
    broken = tmp_path / "v" / "version=00000003"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("half a file")
    assert sinks.current_version(spark, str(tmp_path / "v")).endswith("version=00000002")
    sinks.write_version(new, str(tmp_path / "v"), 3)
    assert spark.read.parquet(sinks.current_version(spark, str(tmp_path / "v"))).count() == 3


def test_gates_and_search_log(spark):
    ok = ("1", "C1", "2024-01-01T00:00:00Z", "Closed", "High")
    bad = ("2", None, "2024-01-01", "Odd", None)
    df = spark.createDataFrame([ok, bad], "caseId string, caseNumber string, createdDate string, status string, priority string")
    failed = {r["caseId"]: r["f"] for r in df.select("caseId", Q.extract_gate().alias("f")).collect()}
    assert failed == {"1": [], "2": ["caseNumber", "createdDate", "status", "priority"]}
    rows = spark.createDataFrame([("1", "x", [1.0, 0.0]), ("2", "", [0.0, 0.0])], "id string, status string, v array<double>")
    loads = {r["id"]: r["f"] for r in rows.select("id", Q.load_gate(
        ["id", "status"], V.vector_error(F.col("v"), 2)).alias("f")).collect()}
    assert loads == {"1": [], "2": ["status", "vector"]}
    asked = spark.createDataFrame([("u", "boot", {"status": "Closed"}, 0)],
                                  "user_id string, query string, filters map<string,string>, result_count int")
    log = sinks.search_log(asked, F.lit("2024-01-01").cast("timestamp")).first()
    assert json.loads(log["filters"]) == {"status": "Closed"} and log["result_count"] == 0


def test_read_files_are_archived(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "old"
    source.mkdir()
    for i in range(3):
        (source / f"{i}.json").write_text(json.dumps({"id": str(i)}))
    for i in range(2):
        stream = sinks.change_stream(spark, str(source), "id string", archive=str(archive), maxFilesPerTrigger="1")
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert len(list(archive.rglob("*.json"))) >= 1


def test_schema_gate():
    assert S.schema_differences(S.COLLECTION, S.COLLECTION) == []
    assert len(S.COLLECTION) == 30
    assert "missing caseId" in S.schema_differences(S.TABLES["task"], S.COLLECTION)


def test_embedding(spark):
    calls = []

    class Flaky:
        def __call__(self, texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("refused")
            return [[float(len(t)), 1.0] for t in texts]
    df = spark.createDataFrame([(1, "abc"), (2, " "), (3, None), (4, "bad"), (5, "ab")], "id int, text string")
    rows = {r["id"]: r for r in V.embed(df, "text", Flaky(), 2, batch=2).collect()}
    assert rows[1]["embedding"] == [3.0, 1.0] and rows[5]["embedding"] == [2.0, 1.0]
    assert rows[2]["embedding"] == rows[3]["embedding"] == [0.0, 0.0] and rows[2]["embedding_error"] is None
    assert rows[4]["embedding"] == [0.0, 0.0] and "refused" in rows[4]["embedding_error"]
    copies = spark.createDataFrame([(i, "same") for i in range(50)] + [(50, "other")], "id int, text string")
    assert V.embed_distinct(copies, "text", V.HashingEmbedder(16), 16).count() == 51
    assert calls == []
