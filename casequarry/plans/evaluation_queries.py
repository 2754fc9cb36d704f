"""Evaluation, sampling and experiment queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casequarry.operators import evaluate as X
from casequarry.operators import sampling as S
from casequarry.operators.search import search_all
from casequarry.plans.registry import query
from casequarry.plans.search_queries import BM25_SQL, corpus, golden


def by_label(t):
    """Every benchmark vector as a query; a row is relevant when it has the
    query's label. Relevance is tested on the results, not listed beforehand."""
    rows = t.embeddings.withColumnRenamed("vec_id", "doc_id")
    queries = golden(t).select("query_id", "vector").filter(F.col("vector").isNotNull())
    found = search_all(rows, queries.withColumn("alpha", F.lit(1.0)), "doc_id", None, "embedding")
    asked = t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("label").alias("wanted"))
    relevant = (found.join(rows.select("doc_id", "label"), "doc_id").join(asked, "query_id")
                .filter(F.col("label") == F.col("wanted")))
    return queries, found, relevant


LABEL_SQL = """
sem AS (SELECT q.vec_id AS item_id, q.label AS ql, d.vec_id AS doc_id, d.label AS dl, row_number() OVER (PARTITION BY q.vec_id
    ORDER BY round((1 + list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[])) / 2, 9) DESC, d.vec_id) AS rank
  FROM embeddings q, embeddings d WHERE q.vec_id IN (SELECT item_id FROM benchmark))"""


@query("precision_at_k", f"""
WITH {LABEL_SQL}
SELECT item_id AS query_id, count(*) FILTER (WHERE ql = dl AND rank <= 5) / 5.0::DOUBLE AS precision
FROM sem GROUP BY 1""")
def precision_at_k(t):
    queries, _, relevant = by_label(t)
    return X.precision_per_query(relevant, queries)


@query("recall_at_k", f"""
WITH {LABEL_SQL}
SELECT item_id AS query_id, round(avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0.0 END), 6) AS recall
FROM sem WHERE ql = dl GROUP BY 1""")
def recall_at_k(t):
    queries, _, relevant = by_label(t)
    sizes = t.embeddings.groupBy("label").agg(F.count("*").alias("total"))
    totals = queries.select(F.col("query_id")).join(
        t.embeddings.select(F.col("vec_id").alias("query_id"), "label"), "query_id").join(
            sizes, "label").select("query_id", "total")
    return X.recall_per_query(relevant, totals).withColumn("recall", F.round("recall", 6))


def rating_rows(t):
    """Ordered ratings per order customer: 1 to 5 from the order prices."""
    rated = t.orders.select("o_custkey", "o_orderkey", (1 + F.floor(
        F.col("o_totalprice") / 1000) % 5).cast("int").alias("r"))
    return rated.groupBy("o_custkey").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("o_orderkey", "r"))), lambda x: x["r"]).alias("ratings"))


RATING_SQL = """
r AS (SELECT o_custkey, 1 + cast(floor(o_totalprice / 1000) AS BIGINT) % 5 AS r,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders),
t AS (SELECT *, CASE WHEN r >= 4 THEN 1 ELSE 0 END AS rel FROM r),
n AS (SELECT o_custkey, count(*) AS n,
  sum(rel) FILTER (WHERE i <= 1) AS s1, sum(rel) FILTER (WHERE i <= 3) AS s3,
  sum(rel) FILTER (WHERE i <= 5) AS s5, sum(rel) FILTER (WHERE i <= 10) AS s10, min(i) FILTER (WHERE rel = 1) AS first,
  sum((pow(2, r) - 1) / log2(i + 1)) FILTER (WHERE i <= 5) AS dcg FROM t GROUP BY 1),
o AS (SELECT o_custkey, r, row_number() OVER (PARTITION BY o_custkey ORDER BY r DESC) AS j FROM t WHERE i <= 5),
d AS (SELECT o_custkey, sum((pow(2, r) - 1) / log2(j + 1)) AS idcg FROM o GROUP BY 1),
a AS (SELECT o_custkey, avg(p) AS ap FROM (SELECT o_custkey, rel,
    sum(rel) OVER (PARTITION BY o_custkey ORDER BY i)::DOUBLE / i AS p FROM t) WHERE rel = 1 GROUP BY 1),
m AS (SELECT n.o_custkey, s1::DOUBLE AS p1, CASE WHEN n >= 3 THEN s3 / 3.0::DOUBLE ELSE 0 END AS p3,
  CASE WHEN n >= 5 THEN s5 / 5.0::DOUBLE ELSE 0 END AS p5, CASE WHEN n >= 10 THEN s10 / 10.0::DOUBLE ELSE 0 END AS p10,
  CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END AS ndcg, coalesce(1.0::DOUBLE / first, 0) AS mrr, coalesce(ap, 0) AS ap
  FROM n JOIN d ON d.o_custkey = n.o_custkey LEFT JOIN a ON a.o_custkey = n.o_custkey)"""


@query("ndcg_mrr", f"""
WITH {RATING_SQL}
SELECT o_custkey, round(p1, 6) AS precision_at_1, round(p3, 6) AS precision_at_3, round(p5, 6) AS precision_at_5,
  round(p10, 6) AS precision_at_10, round(ndcg, 6) AS ndcg_at_5, round(mrr, 6) AS mrr,
  round(ap, 6) AS average_precision FROM m""")
def ndcg_mrr(t):
    rows = X.rating_metrics(rating_rows(t))
    return rows.select("o_custkey", *[F.round(c, 6).alias(c) for c in rows.columns if c != "o_custkey"])


@query("quality_verdicts", f"""
WITH {RATING_SQL},
v AS (SELECT 'precision_at_1' AS metric, avg(p1) AS value, 0.7::DOUBLE AS target FROM m
  UNION ALL SELECT 'precision_at_3', avg(p3), 0.8 FROM m UNION ALL SELECT 'precision_at_5', avg(p5), 0.85 FROM m
  UNION ALL SELECT 'precision_at_10', avg(p10), 0.75 FROM m UNION ALL SELECT 'ndcg_at_5', avg(ndcg), 0.85 FROM m
  UNION ALL SELECT 'mrr', avg(mrr), 0.8 FROM m)
SELECT metric, round(value, 6) AS value, target, CASE WHEN value >= target THEN 'PASS' ELSE 'FAIL' END AS status FROM v""")
def quality_verdicts(t):
    average = X.averages(X.rating_metrics(rating_rows(t)))
    return X.verdict_rows(average).withColumn("value", F.round("value", 6))


@query("quality_recommendations", f"""
WITH {RATING_SQL}, g AS (SELECT avg(p1) AS p1, avg(p5) AS p5, avg(mrr) AS mrr FROM m)
SELECT 'CRITICAL' AS level, 'Precision@5 below target' AS advice FROM g WHERE p5 < 0.85
UNION ALL SELECT 'HIGH', 'Low first-result precision' FROM g WHERE p1 < 0.70
UNION ALL SELECT 'MEDIUM', 'Relevant results not appearing early enough' FROM g WHERE mrr < 0.80
UNION ALL SELECT 'OK', 'All metrics within acceptable ranges' FROM g WHERE p5 >= 0.85 AND p1 >= 0.7 AND mrr >= 0.8""")
def quality_recommendations(t):
    return X.recommendations(X.averages(X.rating_metrics(rating_rows(t))))


@query("quality_breakdown", f"""
WITH {RATING_SQL}
SELECT coalesce(c_mktsegment, 'ALL') AS segment, count(*) AS queries, round(avg(p5), 6) AS precision_at_5,
  round(avg(mrr), 6) AS mrr FROM m JOIN customer ON c_custkey = o_custkey GROUP BY ROLLUP (c_mktsegment)""")
def quality_breakdown(t):
    rows = X.rating_metrics(rating_rows(t)).join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    out = X.breakdown(rows, ["c_mktsegment"], ["precision_at_5", "mrr"])
    return out.select(F.coalesce("c_mktsegment", F.lit("ALL")).alias("segment"), "queries",
                      F.round("precision_at_5", 6).alias("precision_at_5"), F.round("mrr", 6).alias("mrr"))


GRID_SQL = f"""{BM25_SQL},
hy AS (SELECT coalesce(kw.item_id, sem.item_id) AS item_id, coalesce(kw.doc_id, sem.doc_id) AS doc_id,
  coalesce(semantic, 0) AS semantic, coalesce(keyword, 0) AS keyword
  FROM kw FULL OUTER JOIN sem ON kw.item_id = sem.item_id AND kw.doc_id = sem.doc_id),
al AS (SELECT unnest([0.6, 0.7, 0.75, 0.8, 0.85, 0.9])::DOUBLE AS alpha),
th AS (SELECT unnest([0.65, 0.70, 0.75, 0.80])::DOUBLE AS threshold),
s AS (SELECT alpha, item_id, doc_id, round(alpha * semantic + (1 - alpha) * keyword, 9) AS score FROM hy, al),
k AS (SELECT *, row_number() OVER (PARTITION BY alpha, item_id ORDER BY score DESC, doc_id) AS rank FROM s),
h AS (SELECT alpha, threshold, count(*) AS hits FROM k JOIN documents d ON d.doc_id = k.doc_id
  JOIN documents o ON o.doc_id = item_id AND o.lang = d.lang, th WHERE rank <= 5 AND score >= threshold GROUP BY 1, 2),
g AS (SELECT alpha, threshold, coalesce(hits, 0) / (5.0::DOUBLE * (SELECT count(*) FROM benchmark)) AS p
  FROM al CROSS JOIN th LEFT JOIN h USING (alpha, threshold))"""


def grid(t):
    """A row is relevant when it has the language of the query's own document."""
    langs = t.documents.select("doc_id", "lang")

    def judge(found):
        own = langs.select(F.col("doc_id").alias("query_id"), F.col("lang").alias("wanted"))
        return (found.join(langs, "doc_id").join(own, "query_id")
                .filter(F.col("lang") == F.col("wanted")))
    return X.tune(corpus(t), golden(t), judge, "doc_id", "text", "embedding")


@query("alpha_grid", f"WITH {GRID_SQL} SELECT alpha, threshold, round(p, 6) AS precision_at_k FROM g")
def alpha_grid(t):
    return grid(t).withColumn("precision_at_k", F.round("precision_at_k", 6))


@query("alpha_grid_best", f"""
WITH {GRID_SQL} SELECT alpha, threshold, round(p, 6) AS precision_at_k FROM g
ORDER BY p DESC, alpha, threshold LIMIT 1""")
def alpha_grid_best(t):
    return X.best_setting(grid(t)).withColumn("precision_at_k", F.round("precision_at_k", 6))


@query("regression_board", """
WITH e AS (SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, event_type, user_id, value, props FROM events),
w AS (SELECT week, 'precision_at_5' AS metric, avg(CASE WHEN event_type <> 'error' THEN 1.0::DOUBLE ELSE 0 END) AS value FROM e GROUP BY 1
  UNION ALL SELECT week, 'product_accuracy', avg(CASE WHEN event_type <> 'error' THEN 1.0::DOUBLE ELSE 0 END) FROM e WHERE user_id % 2 = 0 GROUP BY 1
  UNION ALL SELECT week, 'pii_leaks', count(*) FILTER (contains(props, '@'))::DOUBLE FROM e GROUP BY 1
  UNION ALL SELECT week, 'latency_p95', quantile_cont(value, 0.95) FROM e GROUP BY 1),
t(metric, test_id) AS (VALUES ('precision_at_5', 'RT001'), ('product_accuracy', 'RT002'), ('latency_p95', 'RT003'), ('pii_leaks', 'RT005')),
d AS (SELECT week, test_id, metric, value,
  CASE WHEN (metric = 'precision_at_5' AND value >= 0.85) OR (metric = 'product_accuracy' AND value >= 0.8)
    OR (metric = 'latency_p95' AND value < 1) OR (metric = 'pii_leaks' AND value <= 0) THEN 'PASS' ELSE 'FAIL' END AS status
  FROM w JOIN t USING (metric)),
l AS (SELECT week, metric, value, lag(value) OVER (PARTITION BY metric ORDER BY week) AS b FROM w)
SELECT week, test_id, metric, round(value, 6) AS value, status FROM d
UNION ALL SELECT week, 'RT004', metric, round(value, 6), CASE WHEN b <> 0 AND ((metric IN ('latency_p95', 'pii_leaks') AND (value - b) / b > 0.05)
  OR (metric NOT IN ('latency_p95', 'pii_leaks') AND (value - b) / b < -0.05)) THEN 'FAIL' ELSE 'PASS' END FROM l""")
def regression_board(t):
    """The four measures come from the events of a week: successes stand for
    precision, those of even users for one product, ``@`` for a leak."""
    from casequarry.skew import exact_percentiles
    events = t.events.withColumn("week", F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd"))
    ok = F.when(F.col("event_type") != "error", 1.0).otherwise(0.0)
    measured = events.groupBy("week").agg(
        F.avg(ok).alias("precision_at_5"), F.avg(F.when(F.col("user_id") % 2 == 0, ok)).alias("product_accuracy"),
        F.count_if(F.contains("props", F.lit("@"))).cast("double").alias("pii_leaks"))
    slow = exact_percentiles(events, ["week"], "value", {"latency_p95": 0.95})
    names = ["precision_at_5", "product_accuracy", "pii_leaks", "latency_p95"]
    weekly = measured.join(slow, "week").select("week", F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])))
    return X.regression_board(weekly).withColumn("value", F.round("value", 6))


VARIANT_SQL = "CASE WHEN ('0x' || substr(md5(user_id || ':ab'), 1, 8))::BIGINT % 100 < 50 THEN 'A' ELSE 'B' END"


def with_variant(t):
    return t.events.withColumn("variant", X.variant(F.col("user_id"), 0.5))


@query("variant_assignment", f"SELECT {VARIANT_SQL} AS variant, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def variant_assignment(t):
    users = with_variant(t).groupBy("variant", "user_id").agg(F.count("*").alias("n"))
    return users.groupBy("variant").agg(F.sum("n").alias("n"), F.count("*").alias("users"))


AB_SQL = f"""
v AS (SELECT {VARIANT_SQL} AS variant, value FROM events),
s AS (SELECT count(*) FILTER (WHERE variant = 'A') AS n_a, count(*) FILTER (WHERE variant = 'B') AS n_b,
  avg(value) FILTER (WHERE variant = 'A') AS mean_a, avg(value) FILTER (WHERE variant = 'B') AS mean_b,
  var_samp(value) FILTER (WHERE variant = 'A') AS va, var_samp(value) FILTER (WHERE variant = 'B') AS vb FROM v)"""


@query("ab_test_stats", f"""
WITH {AB_SQL}
SELECT n_a, n_b, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b,
  round((mean_a - mean_b) / sqrt(((n_a - 1) * va + (n_b - 1) * vb) / (n_a + n_b - 2)
    * (1.0::DOUBLE / n_a + 1.0::DOUBLE / n_b)), 6) AS t, (n_a + n_b - 2)::DOUBLE AS freedom FROM s""")
def ab_test_stats(t):
    out = X.two_sample(with_variant(t), "variant", "value")
    return out.select("n_a", "n_b", *[F.round(c, 6).alias(c) for c in ("mean_a", "mean_b", "t")], "freedom")


def two_sided(t: str) -> str:
    """Student's two-sided p value for ``t`` and ``freedom``: the density summed by Simpson's rule."""
    return f"""(SELECT 1 - 2 * exp(lgamma((freedom + 1) / 2) - lgamma(freedom / 2)) / sqrt(pi() * freedom) * abs({t}) / 6000
  * sum(CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    * exp(-(freedom + 1) / 2 * ln(1 + pow(abs({t}) * i / 2000, 2) / freedom))) FROM range(0, 2001) x(i))"""


@query("ab_test_decision", f"""
WITH v AS (SELECT {VARIANT_SQL} AS variant, value, CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0 END AS hit FROM events),
s AS (SELECT count(*) FILTER (variant = 'A') AS n_a, count(*) FILTER (variant = 'B') AS n_b,
  avg(value) FILTER (variant = 'A') AS l_a, avg(value) FILTER (variant = 'B') AS l_b,
  var_samp(value) FILTER (variant = 'A') AS lv_a, var_samp(value) FILTER (variant = 'B') AS lv_b,
  avg(hit) FILTER (variant = 'A') AS h_a, avg(hit) FILTER (variant = 'B') AS h_b,
  var_samp(hit) FILTER (variant = 'A') AS hv_a, var_samp(hit) FILTER (variant = 'B') AS hv_b FROM v),
x AS (SELECT *, (n_a + n_b - 2)::DOUBLE AS freedom, sqrt(1.0::DOUBLE / n_a + 1.0::DOUBLE / n_b) AS shares FROM s),
y AS (SELECT *, (l_a - l_b) / (shares * sqrt(((n_a - 1) * lv_a + (n_b - 1) * lv_b) / freedom)) AS lt,
  (h_a - h_b) / (shares * sqrt(((n_a - 1) * hv_a + (n_b - 1) * hv_b) / freedom)) AS ht FROM x),
p AS (SELECT *, {two_sided("lt")} AS lp, {two_sided("ht")} AS hp, (l_a - l_b) / l_a AS faster, (h_b - h_a) / h_a AS better FROM y)
SELECT n_a AS variant_a_queries, n_b AS variant_b_queries, round(l_a, 6) AS variant_a_avg_latency,
  round(l_b, 6) AS variant_b_avg_latency, round(faster, 6) AS latency_improvement, round(lp, 6) AS latency_p_value,
  round(better, 6) AS precision_improvement, round(hp, 6) AS precision_p_value, lp < 0.05 AS latency_significant,
  hp < 0.05 AS precision_significant,
  CASE WHEN lp < 0.05 AND faster > 0.1 THEN 'Variant B shows ' || format('{{:.1f}}', faster * 100)
    || '% latency improvement (statistically significant). Recommend rollout.'
  WHEN hp < 0.05 AND better > 0.05 THEN 'Variant B shows ' || format('{{:.1f}}', better * 100)
    || '% precision improvement (statistically significant). Recommend rollout.'
  ELSE 'No significant improvement detected. Keep Variant A (baseline).' END AS recommendation FROM p""")
def ab_test_decision(t):
    rows = with_variant(t).withColumn("hit", F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0))
    out = X.ab_decision(X.two_sample(rows, "variant", "value"), X.two_sample(rows, "variant", "hit"))
    return out.withColumns({c: F.round(c, 6) for c in (
        "variant_a_avg_latency", "variant_b_avg_latency", "latency_improvement", "latency_p_value",
        "precision_improvement", "precision_p_value")})


@query("latency_percentiles", """
SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
  round(quantile_cont(value, 0.99), 6) AS p99, round(avg(value), 6) AS mean FROM events GROUP BY 1""")
def latency_percentiles(t):
    out = X.latency_percentiles(t.events, "value", ["event_type"])
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99", "mean")])


@query("latency_verdicts", """
WITH s AS (SELECT quantile_cont(value / 100, 0.5) AS p50, quantile_cont(value / 100, 0.95) AS p95,
  quantile_cont(value / 100, 0.99) AS p99, avg(value / 100) AS mean FROM events),
r AS (SELECT 'p50' AS metric, p50 AS seconds, 0.5::DOUBLE AS target FROM s UNION ALL SELECT 'p95', p95, 1.0 FROM s
  UNION ALL SELECT 'p99', p99, 2.0 FROM s UNION ALL SELECT 'mean', mean, 0.75 FROM s)
SELECT metric, round(seconds, 6) AS seconds, target, CASE WHEN seconds < target THEN 'PASS' ELSE 'FAIL' END AS status FROM r""")
def latency_verdicts(t):
    rows = t.events.withColumn("seconds", F.col("value") / 100)
    return X.latency_verdicts(X.latency_percentiles(rows, "seconds")).withColumn(
        "seconds", F.round("seconds", 6))


@query("throughput", """
SELECT count(*) AS queries, round(count(*) / sum(value), 6) AS per_latency_second,
  round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) AS per_wall_second FROM events""")
def throughput(t):
    out = X.throughput(t.events, "value", "ts")
    return out.select("queries", *[F.round(c, 6).alias(c) for c in ("per_latency_second", "per_wall_second")])


@query("click_through", """
WITH f AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS c, sum(l_linenumber) AS s,
  count(*) AS n FROM lineitem GROUP BY 1)
SELECT count(*) AS searches, round(avg(coalesce(c, 0)), 6) AS click_through_rate, round(sum(s)::DOUBLE / sum(n), 6) AS mean_rating
FROM orders LEFT JOIN f ON l_orderkey = o_orderkey""")
def click_through(t):
    feedback = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_returnflag") == "R").alias("clicked"),
                                 F.col("l_linenumber").alias("rating"))
    out = X.click_through(t.orders.select("o_orderkey"), feedback, "o_orderkey")
    return out.select("searches", *[F.round(c, 6).alias(c) for c in ("click_through_rate", "mean_rating")])


@query("golden_query_set", r"""
WITH s AS (SELECT *, row_number() OVER (ORDER BY md5(p_partkey || ':42'), p_partkey) AS i FROM part)
SELECT printf('Q%03d', i) AS query_id, trim(lower(p_name)) AS query_text, p_partkey AS source_case, p_brand AS product,
  p_type AS category FROM s WHERE i <= 50""")
def golden_query_set(t):
    out = X.golden_queries(t.part, "p_partkey", "p_name", "p_partkey", "p_brand", "p_type")
    return out.select("query_id", "query_text", "source_case", F.get("expected_products", F.lit(0)).alias("product"),
                      F.get("expected_categories", F.lit(0)).alias("category"))


@query("expectation_check", f"""
WITH {LABEL_SQL},
k AS (SELECT item_id, count(*) FILTER (WHERE ql = dl AND rank <= 5) / 5.0::DOUBLE AS p,
  count(*) FILTER (WHERE rank <= 10 AND ql = dl) > 0 AS a FROM sem GROUP BY 1)
SELECT item_id AS query_id, a AS expected_labels_met, p >= 0.6 AS precision_met, a AND p >= 0.6 AS passed FROM k""")
def expectation_check(t):
    queries, found, relevant = by_label(t)
    labels = t.embeddings.select(F.col("vec_id").alias("query_id"),
                                 F.array(F.col("label").cast("string")).alias("expected_labels"))
    wanted = queries.select("query_id").join(labels, "query_id").withColumn("min_precision", F.lit(0.6))
    results = found.join(t.embeddings.select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("string").alias("label")), "doc_id")
    return X.expectation_check(results, wanted, {"expected_labels": "label"},
                               X.precision_per_query(relevant, queries))


# -- samples --------------------------------------------------------------------

H = "md5(o_orderkey || ':42')"


@query("stratified_sample", f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY {H}, o_orderkey) AS i FROM orders)
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM r WHERE i <= 50
ORDER BY o_orderstatus, o_orderpriority, {H}, o_orderkey LIMIT 1000""")
def stratified_sample(t):
    return S.stratified(t.orders, ["o_orderstatus", "o_orderpriority"], "o_orderkey", 1000).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority")


@query("equal_cap_sample", f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {H}, o_orderkey) AS i FROM orders)
SELECT o_orderkey, o_orderpriority FROM r WHERE i <= 400""")
def equal_cap_sample(t):
    return S.equal_caps(t.orders, "o_orderpriority", "o_orderkey", 2000).select("o_orderkey", "o_orderpriority")


@query("proportional_sample", f"""
WITH q AS (SELECT o_orderpriority, floor(2000 * (count(*)::DOUBLE / (SELECT count(*) FROM orders))) AS quota
  FROM orders GROUP BY 1),
r AS (SELECT o_orderkey, o.o_orderpriority, quota, row_number() OVER (PARTITION BY o.o_orderpriority ORDER BY {H}, o_orderkey) AS i
  FROM orders o JOIN q ON q.o_orderpriority = o.o_orderpriority),
c AS (SELECT o_orderkey, o_orderpriority, CASE WHEN i <= quota THEN 0 ELSE 1 END AS rest FROM r)
SELECT o_orderkey, o_orderpriority FROM c ORDER BY rest, {H}, o_orderkey LIMIT 2000""")
def proportional_sample(t):
    return S.proportional(t.orders, "o_orderpriority", "o_orderkey", 2000).select(
        "o_orderkey", "o_orderpriority")


PH = "md5(p_partkey || ':42')"


@query("family_target_sample", f"""
WITH f AS (SELECT p_partkey, p_type, 'ring' AS family, 120 AS target FROM part WHERE contains(p_name, 'ring')
  UNION ALL SELECT p_partkey, p_type, 'red', 60 FROM part WHERE contains(p_name, 'red')
  UNION ALL SELECT p_partkey, p_type, 'Other', 60 FROM part WHERE NOT regexp_matches(lower(p_name), 'ring|red|other')),
a AS (SELECT *, row_number() OVER (PARTITION BY family, p_type ORDER BY {PH}, p_partkey) AS i FROM f),
b AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY p_type, {PH}, p_partkey) AS j FROM a WHERE i <= floor(target / 6)),
c AS (SELECT p.p_partkey, p.p_name, CASE WHEN p.p_partkey IN (SELECT p_partkey FROM b WHERE j <= target) THEN 0 ELSE 1 END AS rest
  FROM part p)
SELECT p_partkey, p_name FROM c ORDER BY rest, {PH}, p_partkey LIMIT 300""")
def family_target_sample(t):
    return S.by_family_targets(t.part, "p_name", ["p_type"], "p_partkey", 300,
                               {"ring": 120, "red": 60, "Other": 60}).select("p_partkey", "p_name")


@query("combined_samples", f"""
WITH a AS (SELECT o_orderkey, 'a' AS origin FROM orders WHERE o_orderstatus = 'F'),
b AS (SELECT o_orderkey, 'b' AS origin FROM orders WHERE o_totalprice > 200000)
SELECT o_orderkey, min(origin) AS origin FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1""")
def combined_samples(t):
    a = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", F.lit("a").alias("origin"))
    b = t.orders.filter(F.col("o_totalprice") > 200000).select("o_orderkey", F.lit("b").alias("origin"))
    return S.first_of_each([a, b], "o_orderkey")


@query("sample_distribution", """
SELECT 'o_orderstatus' AS field, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def sample_distribution(t):
    return S.distribution(t.orders, "o_orderstatus", "o_orderpriority")


@query("random_sample", f"SELECT o_orderkey FROM orders ORDER BY {H}, o_orderkey LIMIT 100")
def random_sample(t):
    return S.random_rows(t.orders, "o_orderkey", 100).select("o_orderkey")


