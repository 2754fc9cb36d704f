"""Vector and search queries over documents and embeddings."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import functions as F

from casequarry.functions import text as T
from casequarry.functions import vectors as V
from casequarry.operators import cells as C
from casequarry.operators import search as H
from casequarry.operators.term_index import TermIndex
from casequarry.plans.registry import query
from casequarry.plans.text_queries import PART_FAMILIES
from casequarry.session import checkpoint_dir

# -- vectors -------------------------------------------------------------------


@query("vector_profile", """
SELECT vec_id, label, len(embedding) AS dims,
  round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 4) AS magnitude,
  round(list_min(embedding)::DOUBLE, 4) AS smallest, round(list_max(embedding)::DOUBLE, 4) AS largest
FROM embeddings""")
def vector_profile(t):
    out = V.profile(t.embeddings, "embedding")
    return out.select("vec_id", "label", "dims", *[
        F.round(c, 4).alias(c) for c in ("magnitude", "smallest", "largest")])


@query("vector_validate", """
SELECT label, count(*) AS vectors, count(*) FILTER (WHERE vec_id % 2 = 0) AS wrong
FROM embeddings GROUP BY 1""")
def vector_validate(t):
    v = F.when(F.col("vec_id") % 2 == 0, F.slice("embedding", 1, 60)).otherwise(F.col("embedding"))
    return t.embeddings.groupBy("label").agg(
        F.count("*").alias("vectors"),
        F.count_if(V.vector_error(V.as_double(v), 64).isNotNull()).alias("wrong"))


@query("vector_pad", """
SELECT vec_id, 80 AS dims, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total
FROM embeddings""")
def vector_pad(t):
    padded = V.pad(V.as_double(F.col("embedding")), 80)
    return t.embeddings.withColumn("p", padded).select(
        "vec_id", F.size("p").alias("dims"),
        F.round(F.aggregate("p", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query("vector_normalized", """
WITH n AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS m
  FROM embeddings)
SELECT vec_id, round(embedding[1]::DOUBLE / m, 6) AS first, round(embedding[64]::DOUBLE / m, 6) AS last,
  round(list_sum(list_transform(embedding, lambda x, i: i * x::DOUBLE / m)), 4) AS all_values FROM n""")
def vector_normalized(t):
    unit = V.l2_normalize(V.as_double(F.col("embedding")))
    return t.embeddings.withColumn("u", unit).select(
        "vec_id", F.round(F.get("u", F.lit(0)), 6).alias("first"),
        F.round(F.get("u", F.lit(63)), 6).alias("last"),
        F.round(F.aggregate(F.transform("u", lambda x, i: (i + 1) * x), F.lit(0.0), lambda a, x: a + x), 4).alias("all_values"))


@query("embedding_success_rate", """
SELECT count(*) AS vectors, round(avg(CASE WHEN len(embedding) = 64 THEN 1.0 ELSE 0.0 END), 6) AS success_rate,
  count(*) FILTER (WHERE len(embedding) <> 64) AS wrong_dimensions FROM embeddings""")
def embedding_success_rate(t):
    return V.success_rate(t.embeddings, "embedding", 64)


@query("provider_fallback", """
SELECT CASE WHEN label < 3 THEN 'backup' ELSE 'primary' END AS embedding_model, count(*) AS n,
  round(sum(embedding[1]::DOUBLE), 4) AS first_sum FROM embeddings GROUP BY 1""")
def provider_fallback(t):
    v = V.as_double(F.col("embedding"))
    rows = t.embeddings.select(*V.with_fallback(
        F.when(F.col("label") >= 3, v), F.when(F.col("label") < 3, F.slice(v, 1, 48)), 64,
        ("primary", "backup")))
    return rows.groupBy("embedding_model").agg(
        F.count("*").alias("n"), F.round(F.sum(F.get("embedding", F.lit(0))), 4).alias("first_sum"))


@query("embed_documents", r"""
SELECT doc_id, 256 AS dims, CASE WHEN regexp_matches(coalesce(text, ''), '[\p{L}\p{N}_]') THEN 1.0::DOUBLE ELSE 0.0 END AS magnitude,
  NULL::VARCHAR AS embedding_error FROM documents""")
def embed_documents(t):
    embedder = V.HashingEmbedder(256)
    out = V.embed_distinct(t.documents.select("doc_id", "text"), "text", embedder, 256)
    return out.select("doc_id", F.size("embedding").alias("dims"),
                      F.round(V.norm(V.as_double(F.col("embedding"))), 4).alias("magnitude"),
                      "embedding_error")


# -- search ----------------------------------------------------------------------

def vectors_of(t):
    return t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")


def corpus(t):
    return t.documents.join(vectors_of(t), "doc_id", "left")


def golden(t):
    """Benchmark texts as queries, each with the vector of the same number."""
    vectors = t.embeddings.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return t.benchmark.select(F.col("item_id").alias("query_id"), "text").join(vectors, "query_id", "left")


def bm25_sql(queries: str = "SELECT item_id, text FROM benchmark", where: str = "true") -> str:
    """CTEs ``kw`` (item_id, doc_id, keyword) and ``sem``. ``queries`` gives
    item_id and text; ``where`` limits the candidates, not the statistics."""
    return rf"""
asked AS ({queries}),
tok AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '{T.NOT_TOKEN}'), lambda x: x <> '') AS t
  FROM documents),
dl AS (SELECT doc_id, len(t) AS dl FROM tok),
st AS (SELECT count(*)::DOUBLE AS n, avg(dl) AS avgdl FROM dl),
qt AS (SELECT DISTINCT item_id, unnest(list_filter(regexp_split_to_array(lower(text), '{T.NOT_TOKEN}'),
  lambda x: x <> '')) AS term FROM asked),
post AS (SELECT doc_id, term, count(*)::DOUBLE AS tf FROM (SELECT doc_id, unnest(t) AS term FROM tok)
  WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2),
df AS (SELECT term, count(*)::DOUBLE AS df FROM post GROUP BY 1),
bm AS (SELECT item_id, doc_id, sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
    / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))) AS raw
  FROM qt JOIN post USING (term) JOIN df USING (term) JOIN dl USING (doc_id), st GROUP BY 1, 2),
kw AS (SELECT item_id, doc_id, raw / max(raw) OVER (PARTITION BY item_id) AS keyword
  FROM bm JOIN documents USING (doc_id) WHERE {where}),
sem AS (SELECT q.vec_id AS item_id, d.vec_id AS doc_id,
  (1 + list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[])) / 2 AS semantic
  FROM embeddings q, embeddings d JOIN documents ON doc_id = d.vec_id
  WHERE q.vec_id IN (SELECT item_id FROM asked) AND {where})"""


BM25_SQL = bm25_sql()


def ranked_sql(score: str, source: str, limit: int) -> str:
    return f"""
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM (SELECT item_id, doc_id, round({score}, 9) AS score FROM {source}))
SELECT item_id AS query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= {limit}"""


def shown(df):
    return df.select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


@query("bm25_topk", f"WITH {BM25_SQL}, {ranked_sql('keyword', 'kw', 10)}")
def bm25_topk(t):
    queries = golden(t).withColumn("alpha", F.lit(0.0))
    return shown(H.search_all(t.documents, queries, "doc_id", "text"))


@query("cosine_topk", f"""
WITH sem AS (SELECT q.vec_id AS item_id, d.vec_id AS doc_id,
  (1 + list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[])) / 2 AS semantic
  FROM embeddings q, embeddings d WHERE q.vec_id IN (SELECT item_id FROM benchmark)),
{ranked_sql('semantic', 'sem', 10)}""")
def cosine_topk(t):
    rows = t.embeddings.withColumnRenamed("vec_id", "doc_id")
    queries = golden(t).select("query_id", "vector").withColumn("alpha", F.lit(1.0))
    return shown(H.search_all(rows, queries, "doc_id", None, "embedding"))


@query("cosine_threshold", """
SELECT label, count(*) AS n FROM embeddings, (SELECT embedding AS q FROM embeddings WHERE vec_id = 7)
WHERE (1 + round(list_cosine_similarity(q::DOUBLE[], embedding::DOUBLE[]), 9)) / 2 >= 0.55 GROUP BY 1""")
def cosine_threshold(t):
    target = H.vector_of(t.embeddings, "vec_id", "embedding", 7)
    v = V.as_double(F.col("embedding"))
    close = t.embeddings.withColumn("q", target).filter(
        V.certainty(F.round(V.cosine(v, V.as_double(F.col("q"))), 9)) >= 0.55)
    return close.groupBy("label").agg(F.count("*").alias("n"))


@query("similar_items", """
SELECT vec_id, round(c, 6) AS cosine FROM (SELECT vec_id,
  round(list_cosine_similarity(q::DOUBLE[], embedding::DOUBLE[]), 9) AS c
  FROM embeddings, (SELECT embedding AS q FROM embeddings WHERE vec_id = 7) WHERE vec_id <> 7)
ORDER BY c DESC, vec_id LIMIT 5""")
def similar_items(t):
    return H.similar_to(t.embeddings, "vec_id", "embedding", 7, 5).select(
        "vec_id", F.round("cosine", 6).alias("cosine"))


HYBRID_SQL = f"""{BM25_SQL},
hy AS (SELECT coalesce(kw.item_id, sem.item_id) AS item_id, coalesce(kw.doc_id, sem.doc_id) AS doc_id,
  coalesce(semantic, 0) AS semantic, coalesce(keyword, 0) AS keyword
  FROM kw FULL OUTER JOIN sem ON kw.item_id = sem.item_id AND kw.doc_id = sem.doc_id)"""
FUSED = "0.75::DOUBLE * semantic + 0.25::DOUBLE * keyword"


@query("hybrid_fusion_topk", f"WITH {HYBRID_SQL}, {ranked_sql(FUSED, 'hy', 10)}")
def hybrid_fusion_topk(t):
    return shown(H.search_all(corpus(t), golden(t), "doc_id", "text", "embedding"))


WORDS = "les that und information"
ONE = f"SELECT 0 AS item_id, '{WORDS}' AS text"


def token_table(t, name="tokens", fill=None):
    """A token table of the folder's documents, written once per application."""
    key = hashlib.md5(t.folder.encode()).hexdigest()
    index = TermIndex(t.spark, f"{checkpoint_dir(t.spark)}/{name}-{t.spark.sparkContext.applicationId}-{key}")
    if index.manifest()[0] < 0:
        index.put(t.documents, "doc_id", "text", "embedding", ["lang", "source", "n_chars"], 0, vectors_of(t))
    if fill:
        fill(index)
    return index


@query("token_table_terms", rf"""
WITH tok AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '{T.NOT_TOKEN}'), lambda x: x <> '') AS t FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM tok) GROUP BY 1, 2)
SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf, max(tf) AS most FROM p GROUP BY 1""")
def token_table_terms(t):
    """What the stored postings say of every word."""
    return token_table(t).postings().groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf"), F.max("tf").cast("long").alias("most"))


@query("hybrid_one_query", f"""
WITH {bm25_sql(ONE)},
hy AS (SELECT 0 AS item_id, coalesce(kw.doc_id, sem.doc_id) AS doc_id, coalesce(semantic, 0) AS semantic,
  coalesce(keyword, 0) AS keyword FROM kw FULL OUTER JOIN sem ON kw.doc_id = sem.doc_id)
SELECT doc_id, round(score, 6) AS score FROM (SELECT doc_id, round({FUSED}, 9) AS score FROM hy)
ORDER BY score DESC, doc_id LIMIT 10""")
def hybrid_one_query(t):
    """One request against the stored token table."""
    target = H.vector_of(t.embeddings, "vec_id", "embedding", 0)
    return token_table(t).search(WORDS, target).select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


@query("hybrid_filtered_query", f"""
WITH {bm25_sql(ONE, "lang = 'en' AND n_chars > 500")},
hy AS (SELECT 0 AS item_id, coalesce(kw.doc_id, sem.doc_id) AS doc_id, coalesce(semantic, 0) AS semantic,
  coalesce(keyword, 0) AS keyword FROM kw FULL OUTER JOIN sem ON kw.doc_id = sem.doc_id)
SELECT doc_id, round(score, 6) AS score FROM (SELECT doc_id, round({FUSED}, 9) AS score FROM hy)
ORDER BY score DESC, doc_id LIMIT 10""")
def hybrid_filtered_query(t):
    target = H.vector_of(t.embeddings, "vec_id", "embedding", 0)
    wanted = H.nested_filter({"lang": "en", "n_chars": {"$gt": 500}})
    return token_table(t).search(WORDS, target, candidates=wanted).select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


HYBRID_ONE_SQL = f"""
WITH {bm25_sql(ONE)},
hy AS (SELECT 0 AS item_id, coalesce(kw.doc_id, sem.doc_id) AS doc_id, coalesce(semantic, 0) AS semantic,
  coalesce(keyword, 0) AS keyword FROM kw FULL OUTER JOIN sem ON kw.doc_id = sem.doc_id)
SELECT doc_id, round(score, 6) AS score FROM (SELECT doc_id, round({FUSED}, 9) AS score FROM hy)
ORDER BY score DESC, doc_id LIMIT 10"""


@query("hybrid_one_scan", HYBRID_ONE_SQL)
def hybrid_one_scan(t):
    """The same request over the texts themselves, without an index."""
    target = H.vector_of(t.embeddings, "vec_id", "embedding", 0)
    return H.search(corpus(t), "doc_id", "text", "embedding", WORDS, target).select("doc_id", F.round("score", 6).alias("score"))


def staged_corpus(t):
    return corpus(t).withColumn("product", F.concat_ws("/", "source", "lang")).withColumn(
        "family", F.col("lang"))


def staged_queries(t):
    context = t.documents.select(
        F.col("doc_id").alias("query_id"), F.concat_ws("/", "source", "lang").alias("product"),
        F.col("lang").alias("family"))
    return golden(t).join(context, "query_id")


@query("hybrid_fallback_stage", f"""
WITH {HYBRID_SQL},
ctx AS (SELECT b.item_id, d.source || '/' || d.lang AS p, d.lang AS f FROM benchmark b
  JOIN documents d ON d.doc_id = b.item_id),
sg(stage, a) AS (VALUES (1, 0.75::DOUBLE), (2, 0.75), (3, 0.6)),
c AS (SELECT hy.item_id, hy.doc_id, semantic, sg.stage, a, bm.raw FROM hy JOIN ctx USING (item_id)
  JOIN documents d ON d.doc_id = hy.doc_id LEFT JOIN bm ON bm.item_id = hy.item_id AND bm.doc_id = hy.doc_id, sg
  WHERE sg.stage = 3 OR (sg.stage = 1 AND source || '/' || lang = p) OR (sg.stage = 2 AND lang = f)),
s AS (SELECT *, coalesce(raw / max(raw) OVER (PARTITION BY item_id, stage), 0) AS keyword FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id, stage
  ORDER BY round(a * semantic + (1 - a) * keyword, 9) DESC, doc_id) AS rank FROM s),
g AS (SELECT item_id, coalesce(min(stage) FILTER (n >= 5), 3) AS stage
  FROM (SELECT item_id, stage, count(*) AS n FROM r GROUP BY 1, 2) GROUP BY 1)
SELECT r.item_id AS query_id, r.stage, rank, doc_id, round(a * semantic + (1 - a) * keyword, 6) AS score
FROM r JOIN g ON g.item_id = r.item_id AND g.stage = r.stage WHERE rank <= 5""")
def hybrid_fallback_stage(t):
    found = H.fallback_by_count(staged_corpus(t), staged_queries(t), "doc_id", "text", "embedding",
                                "product", "family")
    return found.select("query_id", "stage", "rank", "doc_id", F.round("score", 6).alias("score"))


@query("hybrid_fallback_score", f"""
WITH {HYBRID_SQL},
ctx AS (SELECT b.item_id, d.source || '/' || d.lang AS p, d.lang AS f FROM benchmark b
  JOIN documents d ON d.doc_id = b.item_id),
sg(stage, a, most, bar) AS (VALUES (1, 0.8::DOUBLE, 5, 0.85::DOUBLE), (2, 0.8, 10, 0.75), (3, 0.6, 20, -1.0)),
c AS (SELECT hy.item_id, hy.doc_id, semantic, sg.stage, a, most, bar, bm.raw FROM hy JOIN ctx USING (item_id)
  JOIN documents d ON d.doc_id = hy.doc_id LEFT JOIN bm ON bm.item_id = hy.item_id AND bm.doc_id = hy.doc_id, sg
  WHERE sg.stage = 3 OR (sg.stage = 1 AND source || '/' || lang = p) OR (sg.stage = 2 AND lang = f)),
s AS (SELECT *, coalesce(raw / max(raw) OVER (PARTITION BY item_id, stage), 0) AS keyword FROM c),
r AS (SELECT *, round(a * semantic + (1 - a) * keyword, 9) AS score, row_number() OVER (PARTITION BY item_id, stage
  ORDER BY round(a * semantic + (1 - a) * keyword, 9) DESC, doc_id) AS rank FROM s),
g AS (SELECT item_id, min(stage) AS stage FROM r WHERE rank = 1 AND score > bar GROUP BY 1)
SELECT r.item_id AS query_id, r.stage, rank, doc_id, round(score, 6) AS score FROM r JOIN g ON g.item_id = r.item_id
  AND g.stage = r.stage WHERE rank <= most""")
def hybrid_fallback_score(t):
    return H.fallback_by_score(staged_corpus(t), staged_queries(t), "doc_id", "text", "embedding",
                               "product", "family").select(
        "query_id", "stage", "rank", "doc_id", F.round("score", 6).alias("score"))


@query("combined_lists", """
WITH c AS (SELECT vec_id, round(list_cosine_similarity((SELECT embedding FROM embeddings WHERE vec_id = 7)::DOUBLE[],
    embedding::DOUBLE[]), 9) AS a, round(list_cosine_similarity((SELECT embedding FROM embeddings WHERE vec_id = 8)::DOUBLE[],
    embedding::DOUBLE[]), 9) AS b FROM embeddings),
x AS (SELECT vec_id, a FROM c ORDER BY a DESC, vec_id LIMIT 20),
y AS (SELECT vec_id, b FROM c ORDER BY b DESC, vec_id LIMIT 20)
SELECT vec_id, round(greatest(a, b), 6) AS score FROM x FULL OUTER JOIN y USING (vec_id)
ORDER BY round(greatest(a, b), 9) DESC, vec_id LIMIT 10""")
def combined_lists(t):
    def one(i):
        return H.nearest(t.embeddings, "vec_id", "embedding",
                         H.vector_of(t.embeddings, "vec_id", "embedding", i), 20
                         ).withColumnRenamed("cosine", "score")
    return H.combine(one(7), one(8), "vec_id").withColumn("score", F.round("score", 6))


TWO_VECTORS_SQL = """p AS (SELECT e.vec_id, e.embedding::DOUBLE[] AS i, r.embedding::DOUBLE[] AS r
  FROM embeddings e LEFT JOIN embeddings r ON r.vec_id = e.vec_id + 1),
q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 7)"""


def two_vectors(t):
    """Each vector as an issue, the next one as its resolution; the last has none."""
    following = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("resolution_vector"))
    return t.embeddings.select("vec_id", F.col("embedding").alias("issue_vector")).join(following, "vec_id", "left")


@query("issue_resolution_search", f"""
WITH {TWO_VECTORS_SQL},
x AS (SELECT vec_id, round(list_cosine_similarity(v, i), 9) AS a FROM p, q ORDER BY a DESC, vec_id LIMIT 20),
y AS (SELECT vec_id, round(list_cosine_similarity(v, r), 9) AS b FROM p, q WHERE r IS NOT NULL ORDER BY b DESC, vec_id LIMIT 20)
SELECT vec_id, round(0.5 * coalesce(a, 0) + 0.5 * coalesce(b, 0), 6) AS score FROM x FULL OUTER JOIN y USING (vec_id)
ORDER BY round(0.5 * coalesce(a, 0) + 0.5 * coalesce(b, 0), 9) DESC, vec_id LIMIT 10""")
def issue_resolution_search(t):
    target = H.vector_of(t.embeddings, "vec_id", "embedding", 7)
    return H.search_issue_and_resolution(two_vectors(t), "vec_id", "issue_vector", "resolution_vector", target,
                                         how="weighted").withColumn("score", F.round("score", 6))


@query("similar_resolutions", f"""
WITH {TWO_VECTORS_SQL}
SELECT vec_id, round(list_cosine_similarity((SELECT r FROM p WHERE vec_id = 7), r), 6) AS cosine FROM p
WHERE vec_id <> 7 AND r IS NOT NULL
ORDER BY round(list_cosine_similarity((SELECT r FROM p WHERE vec_id = 7), r), 9) DESC, vec_id LIMIT 5""")
def similar_resolutions(t):
    return H.similar_resolutions(two_vectors(t), "vec_id", "resolution_vector", 7).select(
        "vec_id", F.round("cosine", 6).alias("cosine"))


@query("result_projection", f"""
WITH {HYBRID_SQL},
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM (SELECT item_id, doc_id, round({FUSED}, 9) AS score FROM hy))
SELECT item_id AS query_id, rank, r.doc_id, lang, source,
  CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS text,
  CASE WHEN score > 0.9 THEN 'Exact semantic match' WHEN score > 0.8 THEN 'Strong semantic similarity'
    WHEN score > 0.7 THEN 'Moderate similarity' ELSE 'Metadata match' END AS match_type
FROM r JOIN documents d ON d.doc_id = r.doc_id WHERE rank > 5 AND rank <= 10""")
def result_projection(t):
    found = H.search_all(corpus(t), golden(t), "doc_id", "text", "embedding")
    rows = H.present_results(H.page(found, 2, 5), t.documents, "doc_id", ["text"], ["lang", "source"])
    return rows.select("query_id", "rank", "doc_id", "lang", "source", "text", "match_type")


@query("boosted_rerank", f"""
WITH {HYBRID_SQL},
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM (SELECT item_id, doc_id, round({FUSED}, 9) AS score FROM hy)),
b AS (SELECT item_id, r.doc_id, round(score * CASE WHEN lang = 'en' THEN 1.2::DOUBLE ELSE 1 END
  * CASE WHEN quality = 1 THEN 1.1::DOUBLE ELSE 1 END, 9) AS score FROM r JOIN documents d ON d.doc_id = r.doc_id
  LEFT JOIN labels l ON l.doc_id = r.doc_id WHERE rank <= 50),
n AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM b)
SELECT item_id AS query_id, rank, doc_id, round(score, 6) AS score FROM n WHERE rank <= 10""")
def boosted_rerank(t):
    queries = golden(t).withColumn("limit", F.lit(50))
    found = H.search_all(corpus(t), queries, "doc_id", "text", "embedding")
    rows = (found.join(t.documents.select("doc_id", "lang"), "doc_id")
            .join(t.labels.select("doc_id", "quality"), "doc_id", "left"))
    boosts = [(F.col("lang") == "en", 1.2), (F.col("quality") == 1, 1.1)]
    return shown(H.rerank(rows, "query_id", "doc_id", boosts))


@query("recommend_parts", """
WITH s AS (SELECT p_partkey, CASE WHEN p_brand = 'Brand#2' THEN 2.0::DOUBLE ELSE 0 END
  + CASE WHEN p_type = 'PROMO' THEN 1.0::DOUBLE ELSE 0 END + CASE WHEN p_size < 10 THEN 0.5::DOUBLE ELSE 0 END AS score FROM part)
SELECT p_partkey, score FROM s WHERE score > 0 ORDER BY score DESC, p_partkey LIMIT 10""")
def recommend_parts(t):
    return H.recommend(t.part, "p_partkey", {"p_brand": "Brand#2", "p_type": "PROMO"},
                       {"p_brand": 2.0, "p_type": 1.0, "success": 0.5}, F.col("p_size") < 10
                       ).select("p_partkey", "score")


@query("metadata_filter", """
SELECT p_partkey, p_name FROM part WHERE p_type = 'PROMO' AND p_name LIKE '%ring%'
  AND (p_brand LIKE '%#2%' OR p_brand LIKE '%#14%')""")
def metadata_filter(t):
    rows = t.part.withColumnsRenamed({"p_type": "status", "p_brand": "errorCodes"}).withColumn(
        "productFamily", F.col("p_name"))
    test = H.metadata_filter({"status": "PROMO", "productFamily": "ring", "errorCodes": ["#2", "#14"]})
    return rows.filter(test).select("p_partkey", "p_name")


@query("metadata_filter_dates", """
SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-03-31'""")
def metadata_filter_dates(t):
    rows = t.orders.withColumnsRenamed({"o_orderstatus": "status", "o_orderpriority": "priority",
                                        "o_orderdate": "createdDate"})
    test = H.metadata_filter({"status": "F", "priority": ["1-URGENT", "2-HIGH"],
                              "dateRange": {"start": "1996-01-01", "end": "1996-03-31"}})
    return rows.filter(test).select("o_orderkey")


@query("nested_filter", """
SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_totalprice > 400000)
  AND NOT (o_orderpriority = '5-LOW') AND o_totalprice >= 100000""")
def nested_filter(t):
    test = H.nested_filter({"and": [
        {"or": [{"o_orderstatus": "F"}, {"o_totalprice": {"$gt": 400000}}]},
        {"not": {"o_orderpriority": "5-LOW"}}, {"o_totalprice": {"$gte": 100000}}]})
    return t.orders.filter(test).select("o_orderkey")


@query("error_code_search", """
SELECT p_partkey FROM part WHERE p_brand LIKE '%#1%' OR p_type LIKE '%#1%'""")
def error_code_search(t):
    codes = F.concat_ws(", ", "p_type", "p_brand")
    return t.part.filter(H.has_code(codes, ["#1"])).select("p_partkey")


@query("facet_counts", """
WITH f AS (SELECT 'status' AS field, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
  UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2
  UNION ALL SELECT 'account', cast(o_custkey AS VARCHAR), count(*) FROM orders GROUP BY 2),
r AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS rank FROM f)
SELECT field, value, n, rank FROM r WHERE rank <= 10""")
def facet_counts(t):
    rows = t.orders.withColumnsRenamed({"o_orderstatus": "status", "o_orderpriority": "priority",
                                        "o_custkey": "account"})
    return H.facets(rows, ["status", "priority", "account"])


@query("date_facet", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS period, count(*) AS n FROM orders GROUP BY 1""")
def date_facet(t):
    return H.date_facet(t.orders, "o_orderdate").withColumn(
        "period", F.date_format("period", "yyyy-MM"))


@query("filter_values", """
SELECT DISTINCT 'brand' AS field, p_brand AS value FROM part UNION ALL
SELECT DISTINCT 'type', p_type FROM part UNION ALL SELECT DISTINCT 'size', cast(p_size AS VARCHAR) FROM part""")
def filter_values(t):
    rows = t.part.withColumnsRenamed({"p_brand": "brand", "p_type": "type", "p_size": "size"})
    return H.filter_values(rows, ["brand", "type", "size"])


@query("results_by_group", f"""
WITH {HYBRID_SQL},
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM (SELECT item_id, doc_id, round({FUSED}, 9) AS score FROM hy))
SELECT lang, count(*) OVER (PARTITION BY lang) AS n, item_id AS query_id, rank, r.doc_id
FROM r JOIN documents d ON d.doc_id = r.doc_id WHERE rank <= 10""")
def results_by_group(t):
    found = H.search_all(corpus(t), golden(t), "doc_id", "text", "embedding")
    rows = found.join(t.documents.select("doc_id", "lang"), "doc_id")
    return H.by_group(rows, "lang", "doc_id")


@query("query_strategies", r"""
WITH c AS (SELECT item_id, CASE WHEN item_id % 4 = 0 THEN 'part 867055-B21' WHEN item_id % 4 = 1 THEN
    'error code 218004' WHEN item_id % 4 = 2 THEN 'what ' || text ELSE text END AS q FROM benchmark),
k AS (SELECT item_id, CASE WHEN regexp_matches(q, '\b\d{6}-[A-Z]\d{2}\b') THEN 'sku'
  WHEN regexp_matches(q, '(?i)\berror code\b|\b\d{4,}\b|\b\w+_\w+\b') THEN 'specific'
  WHEN regexp_matches(q, '(?i)^\s*(what|why|how|when|which)\b|\?\s*$') THEN 'conceptual' ELSE 'technical' END AS kind FROM c)
SELECT item_id, kind, CASE kind WHEN 'sku' THEN 0.25::DOUBLE WHEN 'specific' THEN 0.45::DOUBLE
  WHEN 'conceptual' THEN 0.85::DOUBLE ELSE 0.725::DOUBLE END AS alpha,
  CASE kind WHEN 'conceptual' THEN 20 ELSE 10 END AS preset_limit FROM k""")
def query_strategies(t):
    kind = F.col("item_id") % 4
    text = (F.when(kind == 0, "part 867055-B21").when(kind == 1, "error code 218004")
            .when(kind == 2, F.concat(F.lit("what "), "text")).otherwise(F.col("text")))
    rows = t.benchmark.select("item_id", H.query_class(text).alias("kind"))
    preset = F.when(F.col("kind") == "conceptual", "broad").when(
        F.col("kind") == "specific", "error_code").otherwise("product")
    joined = H.with_strategy(rows.withColumn("strategy", preset), "strategy")
    return joined.select("item_id", "kind", H.alpha_for(F.col("kind")).alias("alpha"),
                         F.col("limit").alias("preset_limit"))


@query("threshold_adjustment", """
SELECT p_brand, count(*) AS n, CASE WHEN count(*) < 75 THEN 0.65::DOUBLE WHEN count(*) > 90 THEN 0.75::DOUBLE
  ELSE 0.7::DOUBLE END AS threshold FROM part GROUP BY 1""")
def threshold_adjustment(t):
    return t.part.groupBy("p_brand").agg(F.count("*").alias("n")).select(
        "p_brand", "n", F.round(H.adjusted_threshold(F.col("n"), few=75, many=90), 4).alias("threshold"))


@query("trend_and_stale", """
SELECT o_orderpriority, count(*) AS cases,
  count(*) FILTER (WHERE o_orderstatus = 'O' AND epoch(TIMESTAMP '2000-06-15') - epoch(o_orderdate) > 30 * 86400) AS stale
FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '2000-06-15' GROUP BY 1""")
def trend_and_stale(t):
    from casequarry.functions.enrich import case_age_days
    rows = t.orders.withColumnRenamed("o_orderdate", "createdDate").filter(H.metadata_filter(
        {"dateRange": {"start": "1999-01-01", "end": "2000-06-15"}}))
    # Age counts whole days; more than 30 * 86400 seconds is the same test at midnight.
    old = case_age_days(F.col("createdDate"), F.to_timestamp(F.lit("2000-06-15"))) > 30
    return rows.groupBy("o_orderpriority").agg(
        F.count("*").alias("cases"),
        F.count_if((F.col("o_orderstatus") == "O") & old).alias("stale"))


@query("ann_recall")
def ann_recall(t):
    """Share of the exact ten nearest that the search by bounded cells gives, and the share of all pairs that it scored."""
    rows = t.embeddings.withColumnRenamed("vec_id", "doc_id")
    queries = golden(t).select("query_id", "vector").filter(F.col("vector").isNotNull())
    exact = H.search_all(rows, queries.withColumn("alpha", F.lit(1.0)), "doc_id", None, "embedding")
    near, scored = C.search(C.build(rows, "doc_id", "embedding"), queries)
    both = exact.join(near.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_semi")
    total = exact.agg(F.count("*")).scalar()
    pairs = queries.count() * rows.count()
    return both.agg(F.count("*").alias("found")).select(
        "found", (F.col("found") / total).alias("recall"), F.lit(scored / max(pairs, 1)).alias("scored_share"))


@query("part_families_search", f"""
WITH p AS (SELECT p_partkey, CASE WHEN regexp_matches(p_name, '(?i)small.*') THEN 'Small goods'
  WHEN regexp_matches(p_name, '(?i)red.*') THEN 'Red goods' WHEN regexp_matches(p_name, '(?i).*ring') THEN 'Rings'
  WHEN regexp_matches(p_name, '(?i).*widget.*') THEN 'Widgets' WHEN regexp_matches(p_name, '(?i).*bolt.*') THEN 'Bolts'
  ELSE 'Other' END AS family, p_brand FROM part)
SELECT family, p_brand, count(*) AS n FROM p GROUP BY 1, 2""")
def part_families_search(t):
    from casequarry.functions.enrich import product_family
    return t.part.groupBy(product_family(F.col("p_name"), PART_FAMILIES).alias("family"), "p_brand"
                          ).agg(F.count("*").alias("n"))


# -- searches with filters per query -------------------------------------------------

def filtered_sql(fields: str, wanted: str, fused: str, kept: str) -> str:
    """``fields`` are columns per document, ``wanted`` per query; ``fused`` is the
    score and ``kept`` the condition on (score, rank) and both."""
    return f"""
WITH {BM25_SQL},
w AS (SELECT item_id, {wanted} FROM benchmark),
f AS (SELECT doc_id, {fields} FROM documents),
pairs AS (SELECT w.*, f.* FROM w, f WHERE {kept}),
c AS (SELECT p.*, semantic, raw FROM pairs p LEFT JOIN sem ON sem.item_id = p.item_id AND sem.doc_id = p.doc_id
  LEFT JOIN bm ON bm.item_id = p.item_id AND bm.doc_id = p.doc_id WHERE semantic IS NOT NULL OR raw > 0),
k AS (SELECT *, coalesce(raw / max(raw) OVER (PARTITION BY item_id), 0) AS keyword FROM c),
s AS (SELECT *, round({fused}, 9) AS score FROM k)"""


CASE_FIELDS_SQL = """lang AS "productFamily", CASE WHEN doc_id % 3 = 0 THEN 'Closed' ELSE 'New' END AS status,
  CASE doc_id % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'Critical' WHEN 2 THEN 'Low' ELSE 'Medium' END AS priority,
  source AS category, 'E' || (doc_id % 7) || ',E' || (doc_id % 11) AS "errorCodes",
  strftime(DATE '2024-01-01' + (doc_id % 366)::INTEGER, '%Y-%m-%d') AS "createdDate", doc_id % 90 AS age"""


def case_corpus(t):
    """Documents and their vectors with the metadata of a case."""
    i = F.col("doc_id")
    return corpus(t).withColumns({
        "productFamily": F.col("lang"), "status": F.when(i % 3 == 0, "Closed").otherwise("New"),
        "priority": F.when(i % 4 == 0, "High").when(i % 4 == 1, "Critical").when(i % 4 == 2, "Low").otherwise("Medium"),
        "category": F.col("source"),
        "errorCodes": F.concat(F.lit("E"), (i % 7).cast("string"), F.lit(",E"), (i % 11).cast("string")),
        "createdDate": F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (i % 366).cast("int")), "yyyy-MM-dd"),
        "age": i % 90})


@query("strategy_search", f"""{filtered_sql(CASE_FIELDS_SQL, '''item_id % 5 AS kind, CASE item_id % 5 WHEN 0 THEN 0.9::DOUBLE
  WHEN 1 THEN 0.75 WHEN 4 THEN 0.85 ELSE 0.6 END AS a, CASE item_id % 5 WHEN 0 THEN 20 WHEN 1 THEN 10 WHEN 2 THEN 10
  WHEN 3 THEN 50 ELSE 30 END AS most, CASE item_id % 5 WHEN 0 THEN 0.6::DOUBLE WHEN 2 THEN 0.65 WHEN 3 THEN 0.5 ELSE 0.7 END AS least''',
"a * coalesce(semantic, 0) + (1 - a) * keyword", '''kind = 0
  OR (kind = 1 AND "productFamily" = 'en' AND status = 'Closed' AND priority IN ('High', 'Critical'))
  OR (kind = 2 AND contains("errorCodes", 'E5'))
  OR (kind = 3 AND "createdDate" BETWEEN '2024-03-01' AND '2024-10-31')
  OR (kind = 4 AND status = 'Closed')''')},
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score >= least)
SELECT item_id AS query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= most""")
def strategy_search(t):
    """Each query runs with a preset, filtered by what the preset filters by."""
    kind = F.col("query_id") % 5
    name = F.lit(None).cast("string")
    for i, preset in enumerate(H.STRATEGIES):
        name = F.when(kind == i, preset[0]).otherwise(name)
    wanted = F.create_map(*[F.lit(x) for x in (
        "productFamily", "en", "status", "Closed", "priority", "High,Critical", "errorCodes", "E5",
        "dateRange", "2024-03-01/2024-10-31")])
    asked = golden(t).withColumns({"strategy": name, "wanted": wanted})
    return shown(H.search_by_strategy(case_corpus(t), asked, "doc_id", "text", "embedding", "strategy", "wanted"))


@query("stale_case_search", f"""{filtered_sql(CASE_FIELDS_SQL, "0.6::DOUBLE AS a", "a * coalesce(semantic, 0) + (1 - a) * keyword",
"status = 'New' AND priority IN ('High', 'Critical') AND age > 30")},
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT item_id AS query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10""")
def stale_case_search(t):
    """Open urgent cases above an age, ranked by relevance."""
    tests = H.all_of(H.test("status", "in", "New"), H.test("priority", "in", *H.URGENT), H.test("age", "above", 30))
    asked = golden(t).withColumns({"alpha": F.lit(0.6), "tests": tests})
    return shown(H.search_all(case_corpus(t), asked, "doc_id", "text", "embedding", ["status", "priority", "age"]))


@query("error_code_hybrid", f"""{filtered_sql(CASE_FIELDS_SQL, "'E' || (item_id % 7) AS code, 0.3::DOUBLE AS a",
"a * coalesce(semantic, 0) + (1 - a) * keyword", '''status = 'Closed' AND contains("errorCodes", code)''')},
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT item_id AS query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 5""")
def error_code_hybrid(t):
    """A different code for each query, closed cases only, keyword-heavy."""
    code = F.concat(F.lit("E"), (F.col("query_id") % 7).cast("string"))
    tests = H.all_of(H.test("status", "in", "Closed"), H.test("errorCodes", "contains", code))
    asked = golden(t).withColumns({"alpha": F.lit(0.3), "limit": F.lit(5), "tests": tests})
    return shown(H.search_all(case_corpus(t), asked, "doc_id", "text", "embedding", ["status", "errorCodes"]))


@query("product_word_search", f"""{filtered_sql(CASE_FIELDS_SQL, "CASE WHEN regexp_matches(text, '(?i)information') THEN 'en' WHEN regexp_matches(text, '(?i)les') THEN 'fr' END AS family",
"0.75::DOUBLE * coalesce(semantic, 0) + 0.25::DOUBLE * keyword", '''family IS NULL OR "productFamily" = family''')},
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT item_id AS query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10""")
def product_word_search(t):
    """A word in the query that names a family limits the search to it."""
    tests = H.all_of(H.family_test(F.col("text"), [("information", "en"), ("les", "fr")]))
    return shown(H.search_all(case_corpus(t), golden(t).withColumn("tests", tests), "doc_id", "text", "embedding",
                              ["productFamily"]))


@query("adjusted_search", f"""
WITH {HYBRID_SQL},
s AS (SELECT item_id, doc_id, round({FUSED}, 9) AS score FROM hy),
n AS (SELECT item_id, count(*) FILTER (score >= 0.55) AS n FROM s GROUP BY 1),
g AS (SELECT item_id, CASE WHEN n < 5 THEN 0.5::DOUBLE WHEN n > 12 THEN 0.6 ELSE 0.55 END AS threshold FROM n),
r AS (SELECT s.*, threshold, row_number() OVER (PARTITION BY s.item_id ORDER BY score DESC, doc_id) AS rank
  FROM s JOIN g USING (item_id) WHERE score >= threshold)
SELECT item_id AS query_id, threshold, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10""")
def adjusted_search(t):
    """Too few results widen the search, too many tighten it."""
    found = H.search_adjusting(corpus(t), golden(t), "doc_id", "text", "embedding", 0.55, 0.05, 5, 12)
    return found.select("query_id", "threshold", "rank", "doc_id", F.round("score", 6).alias("score"))


@query("hybrid_fallback_priority", f"""
WITH {HYBRID_SQL},
ctx AS (SELECT b.item_id, d.source || '/' || d.lang AS p, d.lang AS f FROM benchmark b
  JOIN documents d ON d.doc_id = b.item_id),
sg(stage, a, most, bar) AS (VALUES (1, 0.8::DOUBLE, 5, 0.85::DOUBLE), (2, 0.8, 10, 0.75), (3, 0.6, 20, -1.0)),
c AS (SELECT hy.item_id, hy.doc_id, semantic, sg.stage, a, most, bar, bm.raw FROM hy JOIN ctx USING (item_id)
  JOIN documents d ON d.doc_id = hy.doc_id LEFT JOIN bm ON bm.item_id = hy.item_id AND bm.doc_id = hy.doc_id, sg
  WHERE sg.stage = 3 OR (sg.stage = 1 AND source || '/' || lang = p AND d.doc_id % 4 < 2) OR (sg.stage = 2 AND lang = f)),
s AS (SELECT *, coalesce(raw / max(raw) OVER (PARTITION BY item_id, stage), 0) AS keyword FROM c),
r AS (SELECT *, round(a * semantic + (1 - a) * keyword, 9) AS score, row_number() OVER (PARTITION BY item_id, stage
  ORDER BY round(a * semantic + (1 - a) * keyword, 9) DESC, doc_id) AS rank FROM s),
g AS (SELECT item_id, min(stage) AS stage FROM r WHERE rank = 1 AND score > bar GROUP BY 1)
SELECT r.item_id AS query_id, r.stage, rank, doc_id, round(score, 6) AS score FROM r JOIN g ON g.item_id = r.item_id
  AND g.stage = r.stage WHERE rank <= most""")
def hybrid_fallback_priority(t):
    """Stage 1 asks for the product and an urgent priority."""
    rows = case_corpus(t).withColumns({"product": F.concat_ws("/", "source", "lang"), "family": F.col("lang")})
    return H.fallback_by_score(rows, staged_queries(t), "doc_id", "text", "embedding", "product", "family",
                               "priority").select("query_id", "stage", "rank", "doc_id", F.round("score", 6).alias("score"))


@query("ann_two_cells", """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
cell AS (SELECT a.vec_id, c.vec_id AS cell, row_number() OVER (PARTITION BY a.vec_id
  ORDER BY round(list_cosine_similarity(a.e, c.e), 12) DESC, c.vec_id) AS place FROM v a, v c WHERE c.vec_id < 8),
near AS (SELECT q.vec_id AS item_id, d.vec_id AS doc_id, round((1 + list_cosine_similarity(q.e, d.e)) / 2, 9) AS score
  FROM cell p JOIN cell r ON r.cell = p.cell AND r.place = 1 AND p.place <= 2 JOIN v q ON q.vec_id = p.vec_id
  JOIN v d ON d.vec_id = r.vec_id WHERE p.vec_id IN (SELECT item_id FROM benchmark)),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM near)
SELECT item_id AS query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10""")
def ann_two_cells(t):
    """Two cells of eight are searched; eight rows are the given centres."""
    rows = t.embeddings.withColumnRenamed("vec_id", "doc_id")
    centres = rows.filter("doc_id < 8").select(F.col("doc_id").alias("cell"), F.col("embedding").alias("centre"))
    asked = golden(t).select("query_id", "vector").filter(F.col("vector").isNotNull())
    return shown(H.approximate(rows, asked, "doc_id", "embedding", probes=2, centres=centres))


EXACT_TEN = f"""
WITH sem AS (SELECT q.vec_id AS item_id, d.vec_id AS doc_id,
  (1 + list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[])) / 2 AS semantic
  FROM embeddings q, embeddings d WHERE q.vec_id IN (SELECT item_id FROM benchmark)),
{ranked_sql('semantic', 'sem', 10)}"""


@query("ann_topk", EXACT_TEN)
def ann_topk(t):
    """Cells with bounds around eight given centres: the exact ten of every query."""
    rows = t.embeddings.withColumnRenamed("vec_id", "doc_id")
    centres = rows.filter("doc_id < 8").select(F.col("doc_id").alias("cell"), F.col("embedding").alias("centre"))
    asked = golden(t).select("query_id", "vector")
    return shown(C.search(C.build(rows, "doc_id", "embedding", centres=centres), asked)[0])


@query("ann_stored_cells", EXACT_TEN)
def ann_stored_cells(t):
    """The same from an index written by cell and read again, with centres found by k-means."""
    rows = t.embeddings.withColumnRenamed("vec_id", "doc_id")
    folder = f"{checkpoint_dir(t.spark)}/cells-{uuid.uuid4().hex}"
    C.build(rows, "doc_id", "embedding").write(folder)
    asked = golden(t).select("query_id", "vector")
    return shown(C.search(C.CellIndex.read(t.spark, folder, "doc_id"), asked)[0])


# -- the stored token table after changes ----------------------------------------------

CHANGED_SQL = r"""
WITH base AS (SELECT doc_id, CASE WHEN b.text IS NOT NULL THEN coalesce(d.text, '') || ' ' || b.text ELSE d.text END AS text
  FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
documents AS (SELECT * FROM base UNION ALL SELECT -1 - item_id, text FROM benchmark),"""


def changes(docs, vectors, items, labels):
    """All benchmark texts are appended to the documents of their number and added as rows; toxic documents go."""
    def fill(table):
        texts = F.concat_ws(" ", F.coalesce("text", F.lit("")), "more")
        more = docs.join(items.select(F.col("item_id").alias("doc_id"), F.col("text").alias("more")), "doc_id").withColumn("text", texts).drop("more")
        table.put(more, "doc_id", "text", "embedding", ["lang", "source", "n_chars"], 1, vectors)
        table.put(items.select((-1 - F.col("item_id")).alias("doc_id"), "text"), "doc_id", "text", number=2)
        table.remove(labels.filter("toxic = 1").select("doc_id"), "doc_id", 3)
    return fill


def changed_table(t, compacted=False):
    def fill(table):
        changes(t.documents, vectors_of(t), t.benchmark, t.labels)(table)
        if compacted:
            table.compact(4)
    return token_table(t, "tokens-compacted" if compacted else "tokens-changed", fill)


@query("token_table_changed", f"""{CHANGED_SQL} {bm25_sql(ONE)},
hy AS (SELECT 0 AS item_id, coalesce(kw.doc_id, sem.doc_id) AS doc_id, coalesce(semantic, 0) AS semantic,
  coalesce(keyword, 0) AS keyword FROM kw FULL OUTER JOIN sem ON kw.doc_id = sem.doc_id)
SELECT doc_id, round(score, 6) AS score FROM (SELECT doc_id, round({FUSED}, 9) AS score FROM hy)
ORDER BY score DESC, doc_id LIMIT 50""")
def token_table_changed(t):
    """Changed, new and removed texts are found, or not, without writing the rest again."""
    target = H.vector_of(t.embeddings, "vec_id", "embedding", 0)
    return changed_table(t).search(WORDS, target, limit=50).select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


@query("token_table_compacted", f"""{CHANGED_SQL}
tok AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '{T.NOT_TOKEN}'), lambda x: x <> '') AS t FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM tok) GROUP BY 1, 2)
SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf, (SELECT count(*) FROM documents) AS n,
  (SELECT sum(len(t))::BIGINT FROM tok) AS total FROM p GROUP BY 1""")
def token_table_compacted(t):
    """All live postings after the changes were merged into one segment, and the manifest's statistics."""
    table = changed_table(t, compacted=True)
    _, segments, n, _, length = table.manifest()
    assert len(segments) == 1
    return table.postings().groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf")).withColumns(
        {"n": F.lit(n).cast("long"), "total": F.lit(length).cast("long")})
