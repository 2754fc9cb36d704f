"""Records in intervals by a sweep, against all pairs."""

import datetime as dt
import random

import pytest

from casequarry.operators import sweeps

T0 = dt.datetime(2024, 1, 1)


def at(second):
    return None if second is None else T0 + dt.timedelta(seconds=second)


@pytest.mark.parametrize("range_rows", (20, 100_000))
def test_same_as_all_pairs(spark, range_rows):
    r = random.Random(4)
    records = [(i, r.randrange(1000)) for i in range(300)] + [(1000 + i, 500) for i in range(150)] + [(2000, None), (2001, 700), (2001, 700)]
    spans = [(f"s{i}", a, a + r.randrange(60)) for i, a in enumerate(r.choices(range(1000), k=40))]
    spans += [("long", 0, 1000), ("instant", 500, 500), ("backwards", 30, 20), ("open", None, 50), ("outside", 5000, 6000)]
    left = spark.createDataFrame([(i, at(s)) for i, s in records], "id int, ts timestamp").repartition(3)
    right = spark.createDataFrame([(n, at(a), at(b)) for n, a, b in spans], "name string, a timestamp, b timestamp")
    got = sorted((x["id"], x["name"]) for x in sweeps.records_in_intervals(left, "ts", right, "a", "b", range_rows).collect())
    want = sorted((i, n) for i, s in records for n, a, b in spans if None not in (s, a, b) and a <= s <= b)
    assert got == want and len(want) > 1000


def test_a_long_interval_is_a_row_per_range(spark):
    import numpy as np
    bounds = np.arange(1, 8) * 1_000_000
    rows = spark.createDataFrame([("long", 0, 10**12), ("short", 1, 2)], "n string, __a long, __b long")
    assert sorted(x["n"] for x in sweeps._dealt_intervals(rows, bounds).collect()) == ["long"] * 8 + ["short"]


def test_empty_sides_and_clashing_names(spark):
    none = spark.createDataFrame([], "id int, ts timestamp")
    spans = spark.createDataFrame([("x", at(0), at(9))], "name string, a timestamp, b timestamp")
    assert sweeps.records_in_intervals(none, "ts", spans, "a", "b").collect() == []
    some = spark.createDataFrame([(1, at(3))], "id int, ts timestamp")
    assert sweeps.records_in_intervals(some, "ts", spans.filter("false"), "a", "b").collect() == []
    with pytest.raises(ValueError):
        sweeps.records_in_intervals(some, "ts", spans.withColumnRenamed("name", "id"), "a", "b")
