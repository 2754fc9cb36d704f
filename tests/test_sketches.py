"""Mergeable percentiles and distinct counts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from casequarry.operators import sketches as K


def events(spark, seed=1, n=4000):
    r = random.Random(seed)
    start = dt.datetime(2024, 3, 1)
    rows = [(start + dt.timedelta(seconds=r.randrange(10 * 86400)), r.randrange(300), r.choice("ab"), r.lognormvariate(0, 2)) for _ in range(n)]
    rows += [(start, 7, "a", None), (None, 8, "a", 1.0), (start, None, "b", 2.0)] + [(start, 5, "hot", 3.0)] * 500
    return spark.createDataFrame(rows, "ts timestamp, user long, kind string, value double"), rows


def test_merged_quantiles_stay_within_their_error(spark, tmp_path):
    table, rows = events(spark)
    parts = table.withColumn("late", F.col("value") > 5)
    for number, late in enumerate((False, True)):  # two batches of the same minutes
        K.append(K.quantile_sketches(parts.filter(F.col("late") == late), "ts", "value", ["kind"]), str(tmp_path), number)
    K.append(K.quantile_sketches(parts.filter("late"), "ts", "value", ["kind"]), str(tmp_path), 1)  # again: replaced
    days = K.percentiles(K.merged_quantiles(K.stored(spark, str(tmp_path)), "10 days", ["kind"])).collect()
    seen = 0
    for day in days:
        mine = sorted(v for t, _, k, v in rows if v is not None and t is not None and k == day["kind"]
                      and day["start"] <= t < day["start"] + dt.timedelta(days=10))
        assert day["n"] == len(mine)
        seen += len(mine)
        for name, p in K.POINTS.items():
            below, upto = sum(v < day[name] for v in mine), sum(v <= day[name] for v in mine)
            assert below <= (p + 0.02) * len(mine) + 1 and upto >= (p - 0.02) * len(mine) - 1
    assert seen == sum(v is not None and t is not None for t, _, _, v in rows)


def test_share_up_to_a_bound(spark):
    table, rows = events(spark)
    got = K.rank_of(K.merged_quantiles(K.quantile_sketches(table, "ts", "value"), "30 days"), 1.0).collect()
    values = [v for t, _, _, v in rows if v is not None and t is not None]
    assert abs(sum(x["share"] * x["n"] for x in got) / len(values) - sum(v <= 1 for v in values) / len(values)) < 0.02


def test_distinct_users_of_sliding_weeks(spark):
    table, rows = events(spark)
    got = {x["day"]: x for x in K.sliding_distinct(K.distinct_sketches(table, "ts", "user"), 7).collect()}
    days = sorted({t.date() for t, u, _, _ in rows if t and u is not None})
    assert sorted(got) == days
    for day in days:
        mine = [u for t, u, _, _ in rows if t and u is not None and 0 <= (day - t.date()).days < 7]
        assert got[day]["n"] == len(mine) and abs(got[day]["users"] - len(set(mine))) <= max(1, 0.02 * len(set(mine)))


def test_no_events(spark):
    none, _ = events(spark, n=0)
    none = none.filter("false")
    assert K.percentiles(K.merged_quantiles(K.quantile_sketches(none, "ts", "value"), "1 hour")).collect() == []
    assert K.sliding_distinct(K.distinct_sketches(none, "ts", "user"), 7).collect() == []
