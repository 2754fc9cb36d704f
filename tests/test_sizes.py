"""Steps whose tasks are sized by rows, and values that are made once a row."""

import numpy as np
from pyspark.sql import functions as F

from casequarry import skew
from casequarry.functions import vectors as V
from casequarry.operators import assemble, reconcile


def plan(df):
    return df._jdf.queryExecution().toString()


def test_recovery_and_store_comparison_deal_many_rows_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(skew, "PART_ROWS", 10)
    staged = spark.range(200).withColumnRenamed("id", "k")
    records = spark.range(0, 300, 2).select(F.col("id").alias("k"), F.lit("extracted").alias("current_stage"), F.lit("failed").alias("status"))
    routed = reconcile.recovery_routes(records, staged, "k")
    after = reconcile.rerun(routed, staged, "k", {"reclean": lambda rows: rows.select("k", F.when(F.col("k") < 20, "bad").alias("error"))})
    assert "hashpartitioning(k" in plan(after) and ", 20)" in plan(after)
    assert tuple(reconcile.recovery_outcome(after).first()) == (150, 90, 60)
    store = staged.select("k", F.lit("a").alias("checksum"), F.lit("a").alias("recomputed"))
    compared = reconcile.compare_stores(store, store.filter("k != 3"), "k", 200)
    assert ", 20)" in plan(compared)
    assert {x["outcome"]: x["n"] for x in compared.groupBy("outcome").agg(F.count("*").alias("n")).collect()} == {"MATCH": 199, "MISSING": 1}


def test_composite_checks_make_the_text_once(spark):
    rows = spark.createDataFrame([("Issue: a\n\nRESOLUTION: b", 1), ("none", 0)], "t string, n int")
    text = F.concat(F.col("t"), F.lit("!marker"))
    out = rows.select(assemble.composite_checks(text, F.col("n"), F.lit(0)).alias("c"))
    assert out._jdf.queryExecution().analyzed().toString().count("!marker") == 1
    a, b = (x["c"] for x in out.orderBy("t").collect())
    assert (a["sections"], a["words"]["ISSUE"], a["words"]["RESOLUTION"], a["failed"], a["ready"]) == (2, 1, 1, [], True)
    assert b["failed"] == ["issue present", "resolution present", "children attached"] and not b["ready"]


def test_embedding_takes_a_batch_of_rows_at_a_time(spark):
    rows = spark.range(250).select("id", F.concat(F.lit("text "), "id").alias("t")).coalesce(1)
    out = V.embed(rows, "t", lambda texts: [np.array([len(texts), 1.0], np.float32) for _ in texts], 2, batch=100)
    assert "MapInArrow" in plan(out) and "MapInPandas" not in plan(out)
    got = out.orderBy("id").collect()
    assert [x["embedding"][0] for x in got] == [100.0] * 200 + [50.0] * 50 and all(x["embedding_error"] is None for x in got)
