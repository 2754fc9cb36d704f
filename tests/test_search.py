import math
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from casequarry.operators import search as H

WORDS = "disk memory boot error fan raid cpu network bios café x1 y_2".split()


def words(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}_]+", text.lower()) if w]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(11)
    docs = []
    for i in range(120):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 30)))
        vec = None if i % 10 == 0 else [rng.gauss(0, 1) for _ in range(6)]
        docs.append((i, text.title() if i % 3 else text, vec, f"p{i % 17}", f"f{i % 4}"))
    queries = [(f"q{i}", " ".join(rng.choice(WORDS) for _ in range(3)), [rng.gauss(0, 1) for _ in range(6)], f"p{i}", f"f{i % 5}")
               for i in range(7)]
    corpus = spark.createDataFrame(docs, "id int, text string, vec array<float>, product string, family string")
    asked = spark.createDataFrame(queries, "query_id string, text string, vector array<float>, product string, family string")
    return docs, queries, corpus.repartition(3), asked


def brute(docs, query, vector, alpha, keep=lambda d: True, limit=10):
    tokens = {d[0]: words(d[1]) for d in docs}
    n, avgdl = len(docs), sum(len(t) for t in tokens.values()) / len(docs)
    raw, sem = {}, {}
    for d in docs:
        if not keep(d):
            continue
        score = 0.0
        for w in set(words(query)):
            df = sum(w in t for t in tokens.values())
            tf, dl = tokens[d[0]].count(w), len(tokens[d[0]])
            score += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))
        raw[d[0]] = score
        if d[2] is not None:
            a, b = np.array(vector, np.float32).astype(float), np.array(d[2], np.float32).astype(float)
            sem[d[0]] = (1 + a @ b / np.linalg.norm(a) / np.linalg.norm(b)) / 2
    top = max(raw.values(), default=0)
    out = []
    for i, score in raw.items():
        k = score / top if top else 0
        total = round(alpha * sem.get(i, 0) + (1 - alpha) * k, 9)
        wanted = i in sem if alpha >= 1 else (k > 0 if alpha <= 0 else k > 0 or i in sem)
        if wanted:
            out.append((-total, i))
    return [i for _, i in sorted(out)[:limit]]


@pytest.mark.parametrize("alpha", [0.0, 0.6, 1.0])
def test_block_and_single_search_equal_brute_force(data, alpha):
    docs, queries, corpus, asked = data
    rows = H.search_all(corpus, asked.withColumn("alpha", F.lit(alpha)), "id", "text", "vec").collect()
    kind = {0.0: "bm25", 0.6: "hybrid", 1.0: "vector"}[alpha]
    for name, text, vector, _, _ in queries:
        wanted = brute(docs, text, vector, alpha)
        assert [r["id"] for r in sorted((r for r in rows if r["query_id"] == name), key=lambda r: r["rank"])] == wanted
        if name in ("q0", "q3"):
            single = H.search(corpus, "id", "text", "vec", text, F.array(*[F.lit(x) for x in vector]).cast("array<float>"),
                              kind, alpha=alpha)
            assert [r["id"] for r in single.collect()] == wanted


def test_blocks_do_not_change_results(data):
    _, _, corpus, asked = data
    whole = H.search_all(corpus, asked, "id", "text", "vec")
    parts = H.search_all(corpus, asked, "id", "text", "vec", block=2)
    shown = ["query_id", "rank", "id", "score"]
    assert whole.select(shown).exceptAll(parts.select(shown)).count() == 0 and whole.count() == parts.count()


def test_limits_thresholds_and_filters_per_query(data):
    docs, queries, corpus, asked = data
    varied = asked.withColumn("limit", F.when(F.col("query_id") == "q0", 3).otherwise(8)).withColumn(
        "filter_on", F.lit("family")).withColumn("filter_value", F.lit("f2"))
    rows = H.search_all(corpus, varied, "id", "text", "vec", ["family"]).collect()
    for name, text, vector, _, _ in queries:
        wanted = brute(docs, text, vector, 0.75, lambda d: d[4] == "f2", 3 if name == "q0" else 8)
        assert [r["id"] for r in sorted((r for r in rows if r["query_id"] == name), key=lambda r: r["rank"])] == wanted
    high = H.search_all(corpus, asked.withColumn("least", F.lit(0.7)), "id", "text", "vec")
    assert high.filter("score < 0.7").count() == 0 and high.count() > 0


def test_fallback_by_count(data):
    docs, queries, corpus, asked = data
    found = H.fallback_by_count(corpus, asked, "id", "text", "vec", "product", "family").collect()
    for name, text, vector, product, family in queries:
        if sum(d[3] == product for d in docs) >= 5:
            stage, keep, alpha = 1, (lambda d: d[3] == product), 0.75
        elif sum(d[4] == family for d in docs) >= 5:
            stage, keep, alpha = 2, (lambda d: d[4] == family), 0.75
        else:
            stage, keep, alpha = 3, (lambda d: True), 0.6
        mine = sorted((r for r in found if r["query_id"] == name), key=lambda r: r["rank"])
        assert {r["stage"] for r in mine} == {stage}
        assert [r["id"] for r in mine] == brute(docs, text, vector, alpha, keep, 5)


def test_fallback_counts_results_not_candidates(spark):
    """Six rows of the product have neither a vector nor a query word."""
    rows = [(f"a{i}", "nothing here", None, "p", "f") for i in range(6)]
    rows += [(f"b{i}", "boot fails", [1.0, 0.0], "other", "f") for i in range(6)]
    corpus = spark.createDataFrame(rows, "id string, text string, vec array<float>, product string, family string")
    asked = spark.createDataFrame([("q", "boot", [1.0, 0.0], "p", "f")],
                                  "query_id string, text string, vector array<float>, product string, family string")
    found = H.fallback_by_count(corpus, asked, "id", "text", "vec", "product", "family").collect()
    assert {r["stage"] for r in found} == {2} and len(found) == 5


def test_fallback_by_score_takes_the_first_good_stage(data):
    docs, queries, corpus, asked = data
    found = H.fallback_by_score(corpus, asked, "id", "text", "vec", "product", "family").collect()
    for name, text, vector, product, family in queries:
        mine = sorted((r for r in found if r["query_id"] == name), key=lambda r: r["rank"])
        stage = mine[0]["stage"]
        keep = {1: lambda d: d[3] == product, 2: lambda d: d[4] == family, 3: lambda d: True}[stage]
        alpha, limit, bar = H.BY_SCORE[stage]
        assert [r["id"] for r in mine] == brute(docs, text, vector, alpha, keep, limit)
        assert bar is None or mine[0]["score"] > bar


def test_ann_reaches_a_recall_floor(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8)) * 4
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=8)]) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, vec array<float>")
    queries = df.filter("id < 20").select(F.col("id").alias("query_id"), F.col("vec").alias("vector"))
    exact = H.search_all(df, queries.withColumn("alpha", F.lit(1.0)), "id", None, "vec")
    near = H.approximate(df, queries, "id", "vec", cells=6, probes=2)
    hits = exact.join(near.select("query_id", "id"), ["query_id", "id"], "left_semi").count()
    assert hits / exact.count() > 0.9


def test_filters(spark):
    df = spark.createDataFrame([(1, "A", "x, y1", "High", "Closed"), (2, "B", None, "Low", "New")],
                               "id int, productFamily string, errorCodes string, priority string, status string")
    ids = lambda c: [r["id"] for r in df.filter(c).collect()]
    assert H.metadata_filter({}) is None
    assert ids(H.metadata_filter({"errorCodes": ["y"], "priority": ["High", "Low"]})) == [1]
    assert ids(H.nested_filter({"or": [{"status": "New"}, {"id": {"$lt": 1}}], "priority": {"$in": ["Low"]}})) == [2]
    assert ids(H.has_code(F.col("errorCodes"), ["y1"])) == [1]


def test_after_search(spark):
    df = spark.createDataFrame([("q", r, r, 1.0 - r / 10) for r in range(1, 8)], "query_id string, rank int, id int, score double")
    assert [r["id"] for r in H.page(df, 2, 3).orderBy("rank").collect()] == [4, 5, 6]
    top = H.rerank(df, "query_id", "id", [(F.col("id") == 7, 10.0)], final=2).orderBy("rank").collect()
    assert [r["id"] for r in top] == [7, 1]
    merged = H.combine(df.filter("id < 4"), df.filter("id > 2"), "id", "weighted").collect()
    assert merged[0]["id"] == 3 and merged[0]["score"] == pytest.approx(0.7)
    labels = [r["m"] for r in df.select(H.match_type(F.col("score")).alias("m")).collect()]
    assert labels[0] == "Strong semantic similarity" and labels[-1] == "Metadata match"


def test_query_classes(spark):
    rows = [("part 867055-B21", "sku"), ("error code 218004", "specific"), ("what causes crashes", "conceptual"),
            ("memory patterns", "technical")]
    df = spark.createDataFrame(rows, "t string, k string")
    assert df.filter(H.query_class(F.col("t")) != F.col("k")).count() == 0


def test_conjunctions_per_query(spark):
    rows = [(i, "boot", "Closed" if i % 2 else "New", None if i == 3 else f"E{i % 3},E9", str(i * 10)) for i in range(12)]
    corpus = spark.createDataFrame(rows, "id int, text string, status string, codes string, age string")
    asked = spark.createDataFrame([("a", "Closed", "E1"), ("b", None, "E2"), ("c", "New", None)],
                                  "query_id string, status string, code string").withColumns({
        "text": F.lit("boot"), "alpha": F.lit(0.0), "limit": F.lit(20)})
    tests = H.all_of(H.test("status", "in", F.col("status")), F.when(F.col("code").isNotNull(), H.test(
        "codes", "contains", F.col("code"))), H.test("age", "above", 30), H.test("age", "below", 110))
    ready = asked.withColumn("tests", tests)
    found = H.search_all(corpus, ready, "id", "text", None, ["status", "codes", "age"]).collect()
    got = {q: {r["id"] for r in found if r["query_id"] == q} for q in "abc"}
    assert got == {"a": {7}, "b": set(), "c": {4, 6, 8, 10}}
    with pytest.raises(ValueError, match="not among the filters"):
        H.search_all(corpus, ready, "id", "text", None, ["status"])
