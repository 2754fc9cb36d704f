import math

import pytest
from conftest import one
from pyspark.sql import functions as F

from casequarry.functions import enrich as E
from casequarry.functions import ranking as R
from casequarry.operators import evaluate as X


def s(x):
    return F.lit(x).cast("string")


def ts(x):
    return F.lit(x).cast("timestamp")


@pytest.mark.parametrize("product, family", [
    ("HPE ProLiant DL380 Gen10", "ProLiant"), ("ProLiant DL360 Gen9", "ProLiant"),
    ("HPE Synergy 480 Gen10", "Synergy"), ("Aruba 2930F Switch", "Aruba Switches"),
    ("Aruba AP-505", "Aruba Access Points"), ("", "Unknown"), (None, "Unknown"),
    ("Unknown Product XYZ", "Other")])
def test_product_family(spark, product, family):
    assert one(spark, E.product_family(s(product))) == family


@pytest.mark.parametrize("given, wanted", [
    ("HW - Server - Boot Issues", ("Hardware", "Server", "Boot Issues", "Hardware > Server > Boot Issues")),
    ("SW - OS - Configuration", ("Software", "OS", "Configuration", "Software > OS > Configuration")),
    ("NW - Switch", ("Networking", "Switch", None, "Networking > Switch")),
    ("FW", ("Firmware", None, None, "Firmware")),
    ("", ("Uncategorized", None, None, "Uncategorized")),
    (None, ("Uncategorized", None, None, "Uncategorized")),
    ("hw-a-b-c", ("Hardware", "a", "b", "Hardware > a > b")),
    ("XYZ - Unknown - Test", ("XYZ", "Unknown", "Test", "XYZ > Unknown > Test"))])
def test_category(spark, given, wanted):
    assert tuple(one(spark, E.category_levels(s(given)))) == wanted


@pytest.mark.parametrize("created, closed, hours, bucket", [
    ("2024-08-15 09:00", "2024-08-15 12:00", 3.0, "0-4 hours"),
    ("2024-08-15 09:00", "2024-08-15 13:00", 4.0, "4-24 hours"),
    ("2024-08-15 09:00", "2024-08-15 18:00", 9.0, "4-24 hours"),
    ("2024-08-15 09:00", "2024-08-16 09:00", 24.0, "1-7 days"),
    ("2024-08-15 09:00", "2024-08-16 11:30", 26.5, "1-7 days"),
    ("2024-08-15 09:00", "2024-08-30 15:00", 366.0, ">7 days"),
    ("2024-08-15 09:00", None, None, "Open"), (None, "2024-08-16 11:30", None, "Unknown"),
    ("2024-08-16 09:00", "2024-08-15 09:00", None, "Invalid")])
def test_resolution(spark, created, closed, hours, bucket):
    assert one(spark, E.resolution_hours(ts(created), ts(closed))) == hours
    assert one(spark, E.resolution_bucket(ts(created), ts(closed))) == bucket


@pytest.mark.parametrize("at, quarter", [
    ("2024-01-15 09:00", "Q1 2024"), ("2024-03-31 09:00", "Q1 2024"), ("2024-04-01 09:00", "Q2 2024"),
    ("2024-06-30 09:00", "Q2 2024"), ("2024-07-01 09:00", "Q3 2024"), ("2024-09-30 09:00", "Q3 2024"),
    ("2024-10-01 09:00", "Q4 2024"), ("2024-12-31 23:59", "Q4 2024"), (None, "Unknown")])
def test_quarter(spark, at, quarter):
    assert one(spark, E.quarter_label(ts(at))) == quarter


@pytest.mark.parametrize("at, age", [
    ("2024-08-15 09:00", 81), ("2024-11-04 09:00", 0), ("2024-11-03 09:00", 1),
    ("2024-11-05 09:00", None), (None, None)])
def test_age(spark, at, age):
    assert one(spark, E.case_age_days(ts(at), ts("2024-11-04 12:00"))) == age


def python_ndcg(ratings, k=5):
    def dcg(rs):
        return sum((2 ** r - 1) / math.log2(i + 2) for i, r in enumerate(rs[:k]))
    ideal = dcg(sorted(ratings[:k], reverse=True))
    return dcg(ratings[:k]) / ideal if ideal else 0


@pytest.mark.parametrize("ratings", [[5, 4, 1, 2, 3, 5, 5, 1, 1, 4], [1, 1], [4], [1, 2, 3, 4], []])
def test_rating_measures(spark, ratings):
    col = F.array(*[F.lit(x) for x in ratings]).cast("array<int>")
    rel = [1 if x >= 4 else 0 for x in ratings]
    for k in (1, 3, 5, 10):
        wanted = sum(rel[:k]) / k if len(rel) >= k else 0
        assert one(spark, R.precision_at(col, k)) == pytest.approx(wanted)
    assert one(spark, R.ndcg_at(col)) == pytest.approx(python_ndcg(ratings))
    first = next((i + 1 for i, x in enumerate(rel) if x), 0)
    assert one(spark, R.reciprocal_rank(col)) == pytest.approx(1 / first if first else 0)
    ap = [sum(rel[:i + 1]) / (i + 1) for i, x in enumerate(rel) if x]
    assert one(spark, R.average_precision(col)) == pytest.approx(sum(ap) / len(ap) if ap else 0)


def test_t_tail_known_values():
    assert X._t_tail(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert X._t_tail(1.959964, 1e7) == pytest.approx(0.05, abs=1e-5)
    assert X._t_tail(0.0, 5) == pytest.approx(1.0)
    assert X._t_tail(12.706205, 1) == pytest.approx(0.05, abs=1e-6)


def test_ab_decision(spark):
    rows = [("A", 1.0 + i % 7 * 0.01) for i in range(200)] + [("B", 0.8 + i % 7 * 0.01) for i in range(200)]
    df = spark.createDataFrame(rows, "v string, x double")
    out = X.ab_decision(X.two_sample(df, "v", "x")).first()
    assert out["latency_significant"] and out["recommendation"].startswith("Variant B shows")
    same = X.ab_decision(X.two_sample(df.withColumn("x", F.lit(1.0) + F.rand(1) * 0), "v", "x"))
    assert same.first()["recommendation"].startswith("No significant")
