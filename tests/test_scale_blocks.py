"""Helpers that avoid gathering a hot key must equal the plain form."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from casequarry import skew
from casequarry.operators import monitor as M
from casequarry.operators import reconcile as J
from casequarry.operators import sampling as S
from casequarry.session import checkpoint_dir


@pytest.fixture(scope="module")
def hot(spark):
    rng = random.Random(3)
    rows = [(("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 5)}"), i, rng.choice([0.5, 1.0, rng.random() * 100]))
            for i in range(3000)]
    return rows, spark.createDataFrame(rows, "k string, id int, x double")


def test_top_n(hot):
    rows, df = hot
    got = skew.top_n(df, ["k"], [F.desc("x"), F.asc("id")], 7, "rank", ["id"])
    plain = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("x"), "id"))).filter("rank <= 7")
    assert got.select("k", "id", "rank").exceptAll(plain.select("k", "id", "rank")).count() == 0
    assert got.count() == plain.count()


def test_latest_and_earliest(hot):
    rows, df = hot
    best = {r["k"]: r["id"] for r in skew.latest(df, ["k"], ["x", "id"]).collect()}
    first = {r["k"]: r["id"] for r in skew.earliest(df, ["k"], ["x", "id"]).collect()}
    for key in best:
        mine = [(x, i) for k, i, x in rows if k == key]
        assert best[key] == max(mine)[1] and first[key] == min(mine)[1]


@pytest.mark.parametrize("bins", [2, 16, 4096])
def test_percentiles(hot, bins):
    rows, df = hot
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    got = {r["k"]: r for r in skew.exact_percentiles(df, ["k"], "x", wanted, bins).collect()}
    for key in {k for k, _, _ in rows}:
        values = [x for k, _, x in rows if k == key]
        for name, p in wanted.items():
            assert got[key][name] == pytest.approx(np.percentile(values, p * 100))
    whole = skew.exact_percentiles(df, [], "x", {"p": 0.5}, bins).first()["p"]
    assert whole == pytest.approx(np.percentile([x for _, _, x in rows], 50))


def test_percentiles_of_one_value(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, None)], "k int, x double")
    assert [tuple(r) for r in skew.exact_percentiles(df, ["k"], "x", {"p": 0.5}).collect()] == [(1, 2.0)]


@pytest.mark.parametrize("gap, steps", [(60, [1, 5, 30, 59.999999, 60, 61, 200]), (60, [30, 45, 55]),
                                        (7200, [3000, 6500, 7200, 7300, 90000])])
def test_sessions_equal_session_window(spark, gap, steps):
    rng = random.Random(5)
    at, rows = 0.0, []
    for i in range(800 if gap == 7200 else 4000):
        at += rng.choice(steps)
        rows.append((rng.choice("aab"), at))
    df = spark.createDataFrame(rows, "k string, s double").withColumn("at", F.timestamp_micros((F.col("s") * 1000000).cast("bigint")))
    mine = M.sessions(df, "at", gap, ["k"]).select("k", "start", "events")
    plain = df.groupBy("k", F.session_window("at", f"{gap} seconds")).agg(F.count("*").alias("events")).select(
        "k", F.col("session_window.start").alias("start"), "events")
    assert mine.exceptAll(plain).count() == 0 and plain.exceptAll(mine).count() == 0


def test_sustained_across_midnight(spark):
    hours = [(h, (20 <= h <= 27) or h in (3, 4, 40, 41, 42)) for h in range(48)]
    df = spark.createDataFrame(hours, "h int, bad boolean").withColumn("start", F.timestamp_seconds(F.col("h") * 3600))
    runs = M.sustained(df, "start", F.col("bad"), 3600, 3).orderBy("first").collect()
    assert [(r["windows"], r["first"].hour) for r in runs] == [(8, 20), (3, 16)]


def test_sliding_rate_equals_window(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(rng.choice("ab"), rng.randint(0, 4000)) for _ in range(500)], "k string, s int").withColumn(
        "at", F.timestamp_seconds("s"))
    mine = M.sliding_rate(df, "at", 300, 30, ["k"]).select("start", "k", "n")
    plain = M.window_counts(df, "at", "300 seconds", ["k"], "30 seconds").select("start", "k", "n")
    assert mine.exceptAll(plain).count() == 0 and plain.exceptAll(mine).count() == 0


def test_interval_join(spark):
    rng = random.Random(1)
    records = [(i, rng.randint(0, 50000)) for i in range(400)]
    outages = [(0, 100, 9000), (1, 8000, 8100), (2, 30000, 47000)]
    r = spark.createDataFrame(records, "id int, s int").withColumn("at", F.timestamp_seconds("s"))
    o = spark.createDataFrame(outages, "o int, a int, b int").select(
        "o", F.timestamp_seconds("a").alias("start"), F.timestamp_seconds("b").alias("end"))
    got = {(x["id"], x["o"]) for x in J.records_in_intervals(r, "at", o, "start", "end").collect()}
    assert got == {(i, n) for i, s in records for n, a, b in outages if a <= s <= b}


def test_samples_are_repeatable_and_exact(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 900, "hot").otherwise("cold").alias("p"))
    got = S.proportional(df, "p", "id", 100)
    assert got.count() == 100 and got.groupBy("p").count().filter("p = 'hot'").first()["count"] == 90
    assert {r["id"] for r in got.collect()} == {r["id"] for r in S.proportional(df.repartition(7), "p", "id", 100).collect()}
    assert S.trim_or_fill(df.filter("id < 10").select("id"), df, "id", 25).count() == 25
    assert S.stratified(df, ["p"], "id", 100).groupBy("p").count().count() == 2


def test_compare_stores(spark):
    source = spark.createDataFrame([(1, "a", "a"), (2, "a", "a"), (3, "a", "b"), (4, "a", "c"), (5, "a", "a")],
                                   "id int, checksum string, recomputed string")
    stored = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "b"), (9, "z")], "id int, checksum string")
    got = {r["id"]: r["outcome"] for r in J.compare_stores(source, stored, "id").collect()}
    assert got == {1: "MATCH", 2: "STALE", 3: "SOURCE_NEWER", 4: "CORRUPT", 5: "MISSING", 9: "ORPHANED"}


class FakeContext:
    """Just the calls checkpoint_dir makes."""

    def __init__(self, master, setting):
        self.master, self.setting, self.folder = master, setting, None

    def getConf(self):
        return {"spark.checkpoint.dir": self.setting}

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, setting):
        self.sparkContext = FakeContext(master, setting)
        self.conf = {}


def test_checkpoint_folder_is_the_clusters():
    session = FakeSession("spark://host", "hdfs://shared/ckpt")
    assert checkpoint_dir(session) == session.sparkContext.folder == "hdfs://shared/ckpt"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(FakeSession("spark://host", None))
    assert "casequarry-ckpt" in checkpoint_dir(FakeSession("local[2]", None))
