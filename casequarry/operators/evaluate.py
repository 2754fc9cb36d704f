"""Search-quality measures, tuning, regression board and experiments."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from casequarry.functions import ranking as R
from casequarry.functions import text as T
from casequarry.operators.sampling import random_rows, sample_key
from casequarry.operators.search import search_all
from casequarry.skew import exact_percentiles


def expected_rows(results: DataFrame, expected: DataFrame, doc_id: str) -> DataFrame:
    """Result rows whose id is in the query's list of expected ids (one row per
    query and id)."""
    return results.join(expected.select("query_id", doc_id), ["query_id", doc_id], "left_semi")


def precision_per_query(relevant: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """Relevant rows among the first k, divided by k; no hit counts 0."""
    hits = relevant.filter(F.col("rank") <= k).groupBy("query_id").agg(F.count("*").alias("hits"))
    return queries.select("query_id").join(hits, "query_id", "left").select(
        "query_id", (F.coalesce("hits", F.lit(0)) / F.lit(float(k))).alias("precision"))


def recall_per_query(relevant: DataFrame, totals: DataFrame, k: int = 10) -> DataFrame:
    """Relevant rows among the first k, divided by the query's number of
    relevant rows (column ``total``)."""
    hits = relevant.filter(F.col("rank") <= k).groupBy("query_id").agg(F.count("*").alias("hits"))
    return totals.join(hits, "query_id", "left").select(
        "query_id", F.coalesce(F.try_divide(F.coalesce("hits", F.lit(0)), F.col("total")), F.lit(0.0)).alias("recall"))


def rating_metrics(ratings: DataFrame, column: str = "ratings") -> DataFrame:
    """All measures per query from its ordered star ratings."""
    r = F.col(column)
    return ratings.select(
        *[c for c in ratings.columns if c != column],
        *[R.precision_at(r, k).alias(f"precision_at_{k}") for k in (1, 3, 5, 10)],
        R.ndcg_at(r, 5).alias("ndcg_at_5"), R.reciprocal_rank(r).alias("mrr"),
        R.average_precision(r).alias("average_precision"))


def averages(metrics: DataFrame, names: Sequence[str] = tuple(R.TARGETS)) -> DataFrame:
    return metrics.agg(*[F.avg(n).alias(n) for n in names], F.count("*").alias("total_queries"))


def verdict_rows(average: DataFrame, targets: dict[str, float] = R.TARGETS) -> DataFrame:
    """(metric, value, target, status) from one row of averages."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("value"), F.lit(float(v)).alias("target"))
        for n, v in targets.items()]))
    return average.select(rows.alias("r")).select("r.*").withColumn(
        "status", F.when(F.col("value") >= F.col("target"), "PASS").otherwise("FAIL"))


def breakdown(metrics: DataFrame, groups: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Means per group with subtotals; a total row has nulls."""
    return metrics.rollup(*groups).agg(F.count("*").alias("queries"),
                                       *[F.avg(n).alias(n) for n in names])


# Advice per missed target.
ADVICE = [
    ("precision_at_5", 0.85, "CRITICAL", "Precision@5 below target"),
    ("precision_at_1", 0.70, "HIGH", "Low first-result precision"),
    ("mrr", 0.80, "MEDIUM", "Relevant results not appearing early enough"),
]


def recommendations(average: DataFrame) -> DataFrame:
    """One row per missed target; a single OK row if none is missed."""
    found = F.array_compact(F.array(*[
        F.when(F.col(m) < v, F.struct(F.lit(level).alias("level"), F.lit(text).alias("advice")))
        for m, v, level, text in ADVICE]))
    fine = F.array(F.struct(F.lit("OK").alias("level"),
                            F.lit("All metrics within acceptable ranges").alias("advice")))
    return average.select(F.inline(F.when(F.size(found) > 0, found).otherwise(fine)))


ALPHAS = [0.6, 0.7, 0.75, 0.8, 0.85, 0.9]
THRESHOLDS = [0.65, 0.70, 0.75, 0.80]


def tune(corpus: DataFrame, queries: DataFrame, judge: Callable[[DataFrame], DataFrame],
         doc_id: str, text: str, vector: str, alphas: Sequence[float] = ALPHAS,
         thresholds: Sequence[float] = THRESHOLDS, k: int = 5) -> DataFrame:
    """Mean precision at k for every weight and threshold. All weights run in
    one search; thresholds only filter its results. ``judge`` keeps the result
    rows that are relevant."""
    spread = queries.withColumn("__alpha", F.explode(F.array(*[F.lit(a) for a in alphas]))).withColumn(
        "__key", F.concat_ws("#", F.col("query_id").cast("string"), F.col("__alpha").cast("string")))
    asked = spread.select(F.col("__key").alias("query_id"), "text", "vector",
                          F.col("__alpha").alias("alpha"), F.lit(k).alias("limit"))
    found = search_all(corpus, asked, doc_id, text, vector).withColumnRenamed("query_id", "__key")
    names = spread.select("__key", "query_id", F.col("__alpha").alias("alpha"))
    hits = (judge(found.join(names, "__key"))
            .withColumn("threshold", F.explode(F.array(*[F.lit(float(x)) for x in thresholds])))
            .filter(F.col("score") >= F.col("threshold"))
            .groupBy("alpha", "threshold").agg(F.count("*").alias("hits")))
    number = queries.agg(F.count("*")).scalar()
    grid = corpus.sparkSession.createDataFrame(
        [(float(a), float(x)) for a in alphas for x in thresholds], "alpha double, threshold double")
    return grid.join(hits, ["alpha", "threshold"], "left").select(
        "alpha", "threshold", F.try_divide(F.coalesce("hits", F.lit(0)), number * k).alias("precision_at_k"))


def best_setting(grid: DataFrame) -> DataFrame:
    """The grid row with the best precision; the smallest settings win ties."""
    order = F.struct("precision_at_k", -F.col("alpha"), -F.col("threshold"))
    return grid.agg(F.max_by(F.struct(*grid.columns), order).alias("b")).select("b.*")


# Tests of the regression board.
REGRESSION = [("RT001", "Golden Query Precision", "precision_at_5", ">=", 0.85),
              ("RT002", "Product-Specific Accuracy", "product_accuracy", ">=", 0.80),
              ("RT003", "Query Latency", "latency_p95", "<", 1.0),
              ("RT005", "PII Leakage", "pii_leaks", "<=", 0.0)]


def regression_board(weekly: DataFrame) -> DataFrame:
    """``weekly`` has week, metric, value (a few rows per week). Every metric is
    tested against its target, and against the week before: RT004 fails when
    it got worse by more than 5 %."""
    spark = weekly.sparkSession
    tests = spark.createDataFrame(
        REGRESSION, "test_id string, name string, metric string, op string, target double")
    ok = (F.when(F.col("op") == ">=", F.col("value") >= F.col("target"))
          .when(F.col("op") == "<", F.col("value") < F.col("target"))
          .otherwise(F.col("value") <= F.col("target")))
    status = F.when(F.col("value").isNull(), "ERROR").when(ok, "PASS").otherwise("FAIL")
    direct = weekly.join(F.broadcast(tests), "metric").select(
        "week", "test_id", "metric", "value", status.alias("status"))
    before = F.lag("value").over(Window.partitionBy("metric").orderBy("week"))
    lower_is_better = F.col("metric").isin("latency_p95", "pii_leaks")
    change = F.try_divide(F.col("value") - F.col("before"), F.col("before"))
    worse = F.when(lower_is_better, change > 0.05).otherwise(change < -0.05)
    drift = weekly.withColumn("before", before).select(
        "week", F.lit("RT004").alias("test_id"), "metric", "value",
        F.when(F.coalesce(worse, F.lit(False)), "FAIL").otherwise("PASS").alias("status"))
    return direct.unionByName(drift)


def variant(key: Column, split: float, salt: str = "ab") -> Column:
    """A or B by a hash, so the same key always gets the same variant."""
    digest = F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(salt))), 1, 8)
    return F.when(F.conv(digest, 16, 10).cast("bigint") % 100 < int(split * 100), "A").otherwise("B")


def _t_tail(t: float, df: float) -> float:
    """Two-sided p of Student's t by the incomplete beta continued fraction."""
    x, a, b = df / (df + t * t), df / 2.0, 0.5
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0

    def fraction(a: float, b: float, x: float) -> float:
        c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        h = d
        for m in range(1, 500):
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            for step in (even, odd):
                d = 1.0 + step * d
                c = 1.0 + step / c
                d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
                c = c if abs(c) > 1e-300 else 1e-300
                h *= d * c
            if abs(d * c - 1.0) < 1e-14:
                break
        return h

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log(1 - x))
    if x < (a + 1) / (a + b + 2):
        return front * fraction(a, b, x) / a
    return 1.0 - front * fraction(b, a, 1 - x) / b


@F.pandas_udf(DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    """Runs on the one row of a test's result."""
    return pd.Series([_t_tail(abs(a), b) if a == a and b > 0 else None for a, b in zip(t, df)])


def two_sample(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: sizes, means and the pooled-variance t statistic of A and B."""
    def of(name: str, fn) -> Column:
        return fn(F.when(F.col(group) == name, F.col(value)))
    one = df.agg(
        of("A", F.count).alias("n_a"), of("B", F.count).alias("n_b"),
        of("A", F.avg).alias("mean_a"), of("B", F.avg).alias("mean_b"),
        of("A", F.var_samp).alias("var_a"), of("B", F.var_samp).alias("var_b"))
    freedom = F.col("n_a") + F.col("n_b") - 2
    spread = (F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")
    shares = F.try_divide(F.lit(1.0), F.col("n_a")) + F.try_divide(F.lit(1.0), F.col("n_b"))
    error = F.sqrt(F.try_divide(spread, freedom) * shares)
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), error)
    return one.select("n_a", "n_b", "mean_a", "mean_b", t.alias("t"),
                      freedom.cast("double").alias("freedom"))


def ab_decision(latency: DataFrame, precision: DataFrame | None = None) -> DataFrame:
    """Relative changes, p values and the decision text from ``two_sample`` rows."""
    a, b = F.col("mean_a"), F.col("mean_b")
    out = latency.select(
        F.col("n_a").alias("variant_a_queries"), F.col("n_b").alias("variant_b_queries"),
        a.alias("variant_a_avg_latency"), b.alias("variant_b_avg_latency"),
        F.try_divide(a - b, a).alias("latency_improvement"), t_p_value("t", "freedom").alias("latency_p_value"))
    if precision is None:
        gain, p = F.lit(None).cast("double"), F.lit(None).cast("double")
    else:
        one = precision.select(F.struct(F.try_divide(b - a, a).alias("g"),
                                        t_p_value("t", "freedom").alias("p"))).scalar()
        out = out.withColumn("__p", one)
        gain, p = F.col("__p.g"), F.col("__p.p")
    out = out.withColumns({"precision_improvement": gain, "precision_p_value": p}).withColumns({
        "latency_significant": F.col("latency_p_value") < 0.05,
        "precision_significant": F.col("precision_p_value") < 0.05})

    def rollout(column: str, what: str) -> Column:
        share = F.format_string("%.1f%%", F.col(column) * 100)
        return F.concat(F.lit("Variant B shows "), share, F.lit(
            f" {what} improvement (statistically significant). Recommend rollout."))
    text = (F.when(F.col("latency_significant") & (F.col("latency_improvement") > 0.1),
                   rollout("latency_improvement", "latency"))
            .when(F.col("precision_significant") & (F.col("precision_improvement") > 0.05),
                  rollout("precision_improvement", "precision"))
            .otherwise("No significant improvement detected. Keep Variant A (baseline)."))
    return out.withColumn("recommendation", text).drop("__p")


# Latency targets in seconds.
LATENCY_TARGETS = {"p50": 0.5, "p95": 1.0, "p99": 2.0, "mean": 0.75}


def latency_percentiles(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """p50, p95, p99 and mean, exact."""
    points = exact_percentiles(df, groups, value, {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    if groups:
        return points.join(df.groupBy(*groups).agg(F.avg(value).alias("mean")), list(groups))
    return points.withColumn("mean", df.agg(F.avg(value)).scalar())


def latency_verdicts(points: DataFrame, targets: dict[str, float] = LATENCY_TARGETS) -> DataFrame:
    return points.select(F.inline(F.array(*[F.struct(
        F.lit(n).alias("metric"), F.col(n).alias("seconds"), F.lit(v).alias("target"),
        F.when(F.col(n) < v, "PASS").otherwise("FAIL").alias("status")) for n, v in targets.items()])))


def throughput(df: DataFrame, latency: str, at: str) -> DataFrame:
    """Queries per second, by summed latency and by wall time."""
    span = F.unix_micros(F.max(at).cast("timestamp")) - F.unix_micros(F.min(at).cast("timestamp"))
    return df.agg(F.count("*").alias("queries"),
                  F.try_divide(F.count("*"), F.sum(latency)).alias("per_latency_second"),
                  F.try_divide(F.count("*"), span / 1e6).alias("per_wall_second"))


def click_through(searches: DataFrame, feedback: DataFrame, key: str) -> DataFrame:
    """Share of searches with a click, and the mean rating."""
    per_search = feedback.groupBy(key).agg(
        F.max(F.when(F.col("clicked"), 1).otherwise(0)).alias("c"), F.sum("rating").alias("s"),
        F.count("rating").alias("n"))
    return searches.join(per_search, key, "left").agg(
        F.count("*").alias("searches"), F.avg(F.coalesce("c", F.lit(0))).alias("click_through_rate"),
        F.try_divide(F.sum("s"), F.sum("n")).alias("mean_rating"))


def golden_queries(cases: DataFrame, key: str, title: str, number: str, product: str, category: str,
                   n: int = 50, seed: int = 42, floor: float = 0.85) -> DataFrame:
    """``n`` cases as numbered test queries with what they should find."""
    chosen = random_rows(cases, key, n, seed)
    place = F.row_number().over(Window.orderBy(sample_key(key, seed), key))  # n rows
    return chosen.select(
        F.format_string("Q%03d", place).alias("query_id"),
        T.simplify_to_user_query(F.col(title)).alias("query_text"),
        F.col(number).alias("source_case"), F.array(product).alias("expected_products"),
        F.array(category).alias("expected_categories"), F.lit(floor).alias("min_precision_at_5"))


def expectation_check(results: DataFrame, expectations: DataFrame, columns: dict[str, str],
                      precision: DataFrame | None = None) -> DataFrame:
    """Per query: does any result carry an expected value of each kind, and is
    the precision at least the query's own floor? ``columns`` maps an
    expectation array to a result column; an absent expectation is met."""
    found = results.groupBy("query_id").agg(*[
        F.collect_set(c).alias(f"__{c}") for c in dict.fromkeys(columns.values())])
    joined = expectations.join(found, "query_id", "left")
    checks = {}
    for wanted, have in columns.items():
        test = F.arrays_overlap(F.col(wanted), F.coalesce(f"__{have}", F.array().cast("array<string>")))
        checks[f"{wanted}_met"] = F.col(wanted).isNull() | F.coalesce(test, F.lit(False))
    out = joined.withColumns(checks)
    if precision is not None:
        out = out.join(precision, "query_id", "left").withColumn(
            "precision_met", F.coalesce("precision", F.lit(0.0)) >= F.col("min_precision"))
        checks["precision_met"] = None
    passed = reduce(lambda a, b: a & b, [F.col(c) for c in checks])
    return out.select("query_id", *checks, passed.alias("passed"))
