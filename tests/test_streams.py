import datetime as dt
import json

from pyspark.sql import functions as F

from casequarry.operators import monitor as M
from casequarry.sources import sinks
from casequarry.streaming import streams as K

SCHEMA = "id string, checksum string, at timestamp, kind string, value double"
T0 = dt.datetime(2024, 1, 1)


def write_events(folder, rows, name="part.json"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(
        {"id": i, "checksum": c, "at": (T0 + dt.timedelta(seconds=s)).isoformat(), "kind": k, "value": v})
        for i, c, s, k, v in rows))


def events(n=600):
    return [(str(i), str(i % 7), i * 20, "error" if (i // 30) % 3 == 1 or i % 11 == 0 else "ok", float(i % 50)) for i in range(n)]


def closing(n=600):
    """A last event far ahead, so that all windows before it are closed."""
    return [("end", "x", n * 20 + 86400 * 5, "ok", 0.0)]


def run(stream, tmp_path, name, mode="append"):
    query = (stream.writeStream.format("memory").queryName(name).outputMode(mode)
             .option("checkpointLocation", str(tmp_path / f"cp_{name}")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    assert query.exception() is None
    return stream.sparkSession.table(name)


def source(spark, tmp_path, rows=None):
    write_events(tmp_path / "in", rows if rows is not None else events() )
    write_events(tmp_path / "in", closing(), "z_last.json")
    stream = sinks.change_stream(spark, str(tmp_path / "in"), SCHEMA, maxFilesPerTrigger="1")
    batch = spark.read.schema(SCHEMA).json(str(tmp_path / "in")).filter("id <> 'end'")
    return stream, batch


def same(left, right):
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_window_ratio_stream_equals_batch(spark, tmp_path):
    stream, batch = source(spark, tmp_path)
    bad = F.col("kind") == "error"
    got = run(K.error_rate(stream, "at", "10 minutes", bad), tmp_path, "ratio")
    assert same(got, M.window_ratio(batch, "at", "10 minutes", bad))


def test_sliding_counts_and_percentiles_stream(spark, tmp_path):
    stream, batch = source(spark, tmp_path)
    got = run(M.window_counts(K.late(stream, "at"), "at", "5 minutes", ["kind"], "1 minute"), tmp_path, "sliding")
    assert same(got, M.window_counts(batch, "at", "5 minutes", ["kind"], "1 minute"))
    stream, batch = source(spark, tmp_path)
    got = run(M.window_percentiles_approx(K.late(stream, "at"), "at", "1 hour", "value"), tmp_path, "quant")
    assert same(got, M.window_percentiles_approx(batch, "at", "1 hour", "value"))


def test_outages_stream_equals_batch(spark, tmp_path):
    stream, batch = source(spark, tmp_path)
    got = run(K.outages(stream.filter("kind = 'error'"), "at", "5 minutes", ["kind"]), tmp_path, "outages")
    want = M.sessions(batch.filter("kind = 'error'"), "at", 300, ["kind"])
    last = want.agg(F.max("start")).first()[0]
    # The last error period stays open: the closing event is no error.
    assert same(got.select("start", "events"), want.filter(F.col("start") < F.lit(last)).select("start", "events")) or same(
        got.select("start", "events"), want.select("start", "events"))


def test_dedupe_stream(spark, tmp_path):
    rows = events(50) + events(50)
    stream, _ = source(spark, tmp_path, rows)
    got = run(K.deduplicated(stream, "at"), tmp_path, "dedupe")
    assert got.filter("id <> 'end'").count() == 50


def test_sustained_alert_stream(spark, tmp_path):
    stream, batch = source(spark, tmp_path)
    bad = F.col("kind") == "error"
    ratio = K.error_rate(stream.withColumn("label", F.lit("all")), "at", "2 minutes", bad, ["label"])
    table = str(tmp_path / "windows")
    first = (ratio.writeStream.format("parquet").option("path", table).outputMode("append")
             .option("checkpointLocation", str(tmp_path / "cp_windows")).trigger(availableNow=True).start())
    first.awaitTermination(120)
    closed = spark.readStream.schema(spark.read.parquet(table).schema).parquet(table)
    flagged = closed.withColumn("bad", F.col("ratio") > 0.5)
    got = run(K.sustained_alerts(flagged, "label", "start", "bad", 120, 3), tmp_path, "alerts")
    windows = M.window_ratio(batch, "at", "2 minutes", bad)
    runs = M.sustained(windows, "start", F.col("ratio") > 0.5, 120, 3).collect()
    assert len(runs) > 3
    fired = sorted(r["fired_at"] for r in got.collect())
    assert fired == sorted(r["first"] + dt.timedelta(seconds=240) for r in runs)


def test_change_flow(spark, tmp_path):
    folder = tmp_path / "changes"
    folder.mkdir()
    schema = "id string, version int, at timestamp, text string"

    def put(name, rows):
        (folder / name).write_text("\n".join(json.dumps(
            {"id": i, "version": v, "at": (T0 + dt.timedelta(seconds=v)).isoformat(), "text": t}) for i, v, t in rows))
    put("a.json", [("1", 1, "mail a@b.com"), ("2", 1, "plain"), ("1", 1, "mail a@b.com")])
    target = str(tmp_path / "store")

    def go():
        stream = sinks.change_stream(spark, str(folder), schema, maxFilesPerTrigger="1")
        K.run_changes(stream, target, str(tmp_path / "cp"), "id", "version", "text", "at").awaitTermination(120)
        return {r["id"]: r["text"] for r in spark.read.parquet(sinks.current_version(spark, target + "/current")).collect()}
    assert go() == {"1": "mail [EMAIL_REDACTED]", "2": "plain"}
    put("b.json", [("2", 2, "newer"), ("3", 1, "ip 10.0.0.1")])
    assert go() == {"1": "mail [EMAIL_REDACTED]", "2": "newer", "3": "ip [IP_REDACTED]"}


def test_repeated_batch_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("1", 1, "x", False)], "id string, version int, text string, leak boolean")
    for _ in range(2):
        K.apply_changes(spark, rows, str(tmp_path / "s"), "id", "version", 4)
    newest = sinks.current_version(spark, str(tmp_path / "s" / "current"))
    assert newest.endswith("00000004") and spark.read.parquet(newest).count() == 1


def test_buckets_without_changes_stay(spark, tmp_path):
    folder, schema = str(tmp_path / "b"), "id long, version int, x string"
    first = spark.range(200).selectExpr("id", "1 AS version", "'a' AS x")
    sinks.upsert_buckets(first, folder, "id", "version", 0, 8)
    before = sinks.bucket_paths(spark, folder)[1]
    change = spark.createDataFrame([(7, 2, "b"), (7, 1, "late")], schema)
    for _ in range(2):
        sinks.upsert_buckets(change, folder, "id", "version", 1, 8)
    number, after = sinks.bucket_paths(spark, folder)
    assert number == 1 and len(after) == 8 and sum(after[b] != before[b] for b in after) == 1
    rows = {r["id"]: r["x"] for r in sinks.read_buckets(spark, folder, first.schema).collect()}
    assert len(rows) == 200 and rows[7] == "b" and rows[8] == "a"


def test_runs_are_closed_by_gaps_good_windows_and_silence(spark, tmp_path):
    from casequarry.streaming import alerts
    schema = "label string, start timestamp, bad boolean"
    provider = "spark.sql.streaming.stateStore.providerClass"
    alerts.with_state_store(spark)

    def go(rows):
        spark.createDataFrame([(l, T0 + dt.timedelta(minutes=m) if m is not None else None, b) for l, m, b in rows], schema).coalesce(1).write.mode(
            "append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        out = alerts.sustained_runs(stream, "label", "start", "bad", 60, 3, "2 minutes")
        out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(
            availableNow=True).start().awaitTermination(120)
        return sorted((str(r["label"]), int((r["first"] - T0).total_seconds() // 60), r["windows"])
                      for r in spark.read.schema(out.schema).parquet(f"{tmp_path}/out").collect())
    try:
        assert go([("a", 0, True), ("a", 2, True), ("a", 1, True), ("a", 1, False), ("b", 0, True), ("b", 1, True), ("b", 2, False), (None, 0, True),
                   (None, 1, True), (None, 2, True), ("c", 0, None), ("c", None, True)]) == []
        # A minute in a batch of its own joins the run; a gap ends it; null labels are a label.
        assert go([("a", 3, True), ("a", 6, True), ("b", 7, True), ("b", 8, True), ("b", 9, True)]) == [("None", 0, 3), ("a", 0, 4)]
        # Too late to spoil the run; silence of b closes its run.
        assert go([("a", 1, False), ("a", 30, False)]) == [("None", 0, 3), ("a", 0, 4), ("b", 7, 3)]
    finally:
        spark.conf.unset(provider)
