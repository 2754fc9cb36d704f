"""Hybrid search: vector similarity, BM25, metadata filters, fusion, fallback.

One query is scored inside Spark with array expressions. A table of queries is
scored in blocks: each task multiplies its rows with the whole block and keeps
the best few per query, so query and document are never paired as rows.

Choices where the behaviour leaves room: k1 = 1.2, b = 0.75, idf =
ln(1 + (N - df + 0.5) / (df + 0.5)), statistics over the whole collection;
semantic score (1 + cos) / 2; keyword score divided by the best one among the
candidates; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from casequarry.functions import text as T
from casequarry.functions import vectors as V
from casequarry.session import cut
from casequarry.skew import salt_of, salts, top_n

K1, B = 1.2, 0.75
DEFAULT_ALPHA, DEFAULT_LIMIT = 0.75, 10
DIGITS = 9


# -- one query, inside Spark ------------------------------------------------------

def bm25(length: Column, counts: Column, terms: int, stats: Column) -> Column:
    """Score of one text from its length and its count of each query word;
    ``stats`` has n, avgdl and, per word, df of the whole collection."""
    norm = K1 * (1 - B + B * F.coalesce(F.try_divide(length, stats["avgdl"]), F.lit(0.0)))
    total = F.lit(0.0)
    for i in range(terms):
        df, tf = F.get(stats["df"], F.lit(i)), F.get(counts, F.lit(i))
        idf = F.log(1 + (stats["n"] - df + 0.5) / (df + 0.5))
        total = total + idf * tf * (K1 + 1) / (tf + norm)
    return total


def _equals(word: str):
    return lambda t: t == F.lit(word)


def query_terms(query: str) -> list[str]:
    import regex
    return sorted({w for w in regex.split(r"[^\p{L}\p{N}_]+", query.lower()) if w})


def scored(corpus: DataFrame, doc_id: str, text: str, vector: str, query: str, query_vector: Column,
           candidates: Column | None = None) -> DataFrame:
    """``doc_id``, ``semantic`` and ``keyword`` (0 to 1) of the candidate rows.

    One pass reads and tokenises the collection and keeps a few numbers per row
    (checkpointed); term statistics over the whole collection, the best score
    among the candidates and the scores themselves come from those.
    """
    terms = query_terms(query)
    wanted = F.lit(True) if candidates is None else F.coalesce(candidates, F.lit(False))
    v = V.as_double(F.col(vector))
    target = V.as_double(F.col("__q"))
    rows = corpus.withColumn("__q", query_vector).select(
        doc_id, F.xxhash64(text).alias("__row"), wanted.alias("__wanted"), T.tokens(F.col(text)).alias("__t"),
        F.when(F.col(vector).isNotNull() & wanted, V.certainty(V.cosine(v, target))).alias("semantic"))
    # One look at each token; the query's words are then counted among the few that are left.
    rows = rows.select(doc_id, "__row", "__wanted", "semantic", F.size("__t").alias("__length"),
                       F.filter("__t", lambda t: t.isin(terms)).alias("__hits"))
    small = cut(rows.select(
        doc_id, "__row", "__wanted", "semantic", "__length",
        F.array(*[F.size(F.filter("__hits", _equals(w))) for w in terms]).cast("array<int>").alias("__tf")))
    stats = small.agg(F.count("*").alias("n"), F.avg("__length").alias("avgdl"),
                      F.array(*[F.count_if(F.get("__tf", F.lit(i)) > 0) for i in range(len(terms))]).alias("df"))
    weighed = small.filter("__wanted").withColumn("__s", stats.select(F.struct("*")).scalar()).withColumn(
        "__kw", bm25(F.col("__length"), F.col("__tf"), len(terms), F.col("__s")))
    best = weighed.agg(F.max("__kw")).scalar()
    return weighed.withColumn("keyword", F.when(best > 0, F.col("__kw") / best).otherwise(F.lit(0.0))
                              ).select(doc_id, "__row", "semantic", "keyword")


def fuse(semantic: Column, keyword: Column, alpha: float | Column) -> Column:
    a = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    return a * F.coalesce(semantic, F.lit(0.0)) + (1 - a) * F.coalesce(keyword, F.lit(0.0))


def search(corpus: DataFrame, doc_id: str, text: str, vector: str, query: str,
           query_vector: Column, search_type: str = "hybrid", limit: int = DEFAULT_LIMIT,
           alpha: float = DEFAULT_ALPHA, candidates: Column | None = None,
           least: float | None = None) -> DataFrame:
    """Best rows for one query, by ``hybrid``, ``vector`` or ``bm25``."""
    weights = {"hybrid": alpha, "vector": 1.0, "bm25": 0.0}
    if search_type not in weights:
        raise ValueError(f"unknown search type {search_type}")
    weight = weights[search_type]
    rows = scored(corpus, doc_id, text, vector, query, query_vector, candidates)
    wanted = {"hybrid": F.col("semantic").isNotNull() | (F.col("keyword") > 0),
              "vector": F.col("semantic").isNotNull(), "bm25": F.col("keyword") > 0}[search_type]
    rows = rows.filter(wanted).withColumn(
        "score", F.round(fuse(F.col("semantic"), F.col("keyword"), weight), DIGITS))
    if least is not None:
        rows = rows.filter(F.col("score") >= least)
    best = rows.orderBy(F.desc("score"), doc_id).limit(limit).distinct().withColumnRenamed(doc_id, "__id")
    # At most ``limit`` rows: a bounded broadcast brings the other columns back.
    keyed = corpus.withColumn("__row", F.xxhash64(text))
    return (keyed.join(F.broadcast(best), (keyed[doc_id] == best["__id"]) & (keyed["__row"] == best["__row"]))
            .select(*[keyed[c] for c in corpus.columns], "semantic", "keyword", "score")
            .orderBy(F.desc("score"), doc_id).limit(limit))


def nearest(corpus: DataFrame, doc_id: str, vector: str, query_vector: Column,
            limit: int = DEFAULT_LIMIT, least: float | None = None) -> DataFrame:
    """Exact cosine top-k; ``least`` is a minimum certainty."""
    v = V.as_double(F.col(vector))
    rows = (corpus.filter(F.col(vector).isNotNull()).withColumn("__q", query_vector)
            .withColumn("cosine", F.round(V.cosine(v, V.as_double(F.col("__q"))), DIGITS))
            .drop("__q"))
    if least is not None:
        rows = rows.filter(V.certainty(F.col("cosine")) >= least)
    return rows.orderBy(F.desc("cosine"), doc_id).limit(limit)


def vector_of(corpus: DataFrame, doc_id: str, vector: str, value) -> Column:
    """The vector of one row as a scalar."""
    return corpus.filter(F.col(doc_id) == value).agg(F.first(vector)).scalar()


def similar_to(corpus: DataFrame, doc_id: str, vector: str, value, limit: int = 5) -> DataFrame:
    """Rows like the given one, without it."""
    return nearest(corpus.filter(F.col(doc_id) != value), doc_id, vector,
                   vector_of(corpus, doc_id, vector, value), limit)


# -- many queries at once ------------------------------------------------------------

@dataclass
class Block:
    """A bounded set of queries in the form the tasks use. Queries that differ
    only in weight, limit or filter share one line of ``texts`` or ``vectors``."""
    ids: list
    text_line: np.ndarray
    vector_line: np.ndarray
    texts: list[list[int]]             # per line: term codes
    vectors: np.ndarray | None         # per line: unit vector, zero if none
    alpha: np.ndarray
    limit: np.ndarray
    least: np.ndarray
    tests: list[tuple]                 # per query: (column, op, values) that must all hold
    idf: dict[int, float] = field(default_factory=dict)
    avgdl: float = 1.0
    best_keyword: np.ndarray | None = None

    def prepare(self) -> "Block":
        self.codes = np.array(sorted({c for t in self.texts for c in t}), dtype=np.int64)
        self.weights = np.zeros((len(self.texts), max(1, len(self.codes))))
        for line, terms in enumerate(self.texts):
            for code in terms:
                self.weights[line, np.searchsorted(self.codes, code)] = self.idf.get(code, 0.0)
        self.step = max(64, min(1024, 1_000_000 // max(1, len(self.ids))))
        self.filtered = [i for i, t in enumerate(self.tests) if t]
        return self

    def keyword(self, rows: pa.RecordBatch) -> np.ndarray:
        """Raw BM25, one line per query and one column per row."""
        hits, n, width = rows.column("__hits"), rows.num_rows, self.weights.shape[1]
        sizes = pc.fill_null(pc.list_value_length(hits), 0).to_numpy(zero_copy_only=False)
        found = np.searchsorted(self.codes, hits.flatten().to_numpy(zero_copy_only=False))
        cells = np.repeat(np.arange(n, dtype=np.int64), sizes) * width + found
        tf = np.bincount(cells, minlength=n * width).reshape(n, width).astype(float)
        length = rows.column("__dl").to_numpy(zero_copy_only=False).astype(float)
        norm = K1 * (1 - B + B * length / self.avgdl)
        return (self.weights @ (tf * (K1 + 1) / (tf + norm[:, None])).T)[self.text_line]

    def semantic(self, rows: pa.RecordBatch) -> np.ndarray:
        """(1 + cos) / 2, NaN where the row or the query has no vector."""
        out = np.full((len(self.ids), rows.num_rows), np.nan)
        if self.vectors is None or "__vec" not in rows.schema.names:
            return out
        column, size = rows.column("__vec"), self.vectors.shape[1]
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        have = sizes == size
        if have.any():
            matrix = column.filter(pa.array(have)).flatten().to_numpy(zero_copy_only=False)
            matrix = matrix.reshape(-1, size).astype(float)
            length = np.linalg.norm(matrix, axis=1, keepdims=True)
            matrix = np.where(length > 0, matrix / np.where(length > 0, length, 1), 0.0)
            lines = (1 + self.vectors @ matrix.T) / 2
            lines[np.abs(self.vectors).sum(axis=1) == 0] = np.nan
            out[:, have] = lines[self.vector_line]
        return out

    def allowed(self, rows: pa.RecordBatch) -> np.ndarray:
        mask = np.ones((len(self.ids), rows.num_rows), dtype=bool)
        held: dict = {}
        for line in self.filtered:
            for test in self.tests[line]:
                if test not in held:
                    held[test] = _holds(rows.column(test[0]), *test[1:])
                mask[line] &= held[test]
        return mask

    def best(self, rows: pa.RecordBatch, ids: str) -> pd.DataFrame:
        """The best rows of this batch for every query."""
        keyword, semantic = self.keyword(rows), self.semantic(rows)
        known = ~np.isnan(semantic)
        top = self.best_keyword[:, None]
        keyword = np.divide(keyword, top, out=np.zeros_like(keyword), where=top > 0)
        alpha = self.alpha[:, None]
        total = np.round(alpha * np.nan_to_num(semantic) + (1 - alpha) * keyword, DIGITS)
        wanted = np.where(alpha >= 1, known, (keyword > 0) | (known & (alpha > 0)))
        wanted &= total >= self.least[:, None]
        if self.filtered:
            wanted &= self.allowed(rows)
        total = np.where(wanted, total, -np.inf)
        most = int(self.limit.max())
        if total.shape[1] > most:
            edge = np.partition(total, total.shape[1] - most, axis=1)[:, total.shape[1] - most]
            wanted &= total >= edge[:, None]
        line, column = np.nonzero(wanted)
        names = rows.column(ids).to_numpy(zero_copy_only=False)
        return pd.DataFrame({
            "__q": line, ids: names[column], "score": total[line, column],
            "semantic": semantic[line, column], "keyword": keyword[line, column]})

    def keep(self, found: pd.DataFrame, ids: str) -> pd.DataFrame:
        ordered = found.sort_values(["__q", "score", ids], ascending=[True, False, True])
        place = ordered.groupby("__q").cumcount().to_numpy()
        return ordered[place < self.limit[ordered["__q"].to_numpy()]]

    def slices(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, self.step):
                yield rows.slice(at, self.step)


def _holds(column: pa.Array, op: str, values: tuple[str, ...]) -> np.ndarray:
    """Where one test of a query holds; nulls on either side hold nowhere."""
    if op == "in":
        found = pc.is_in(column, value_set=pa.array(values, pa.string()), skip_nulls=True)
    elif op == "contains":
        found = reduce(pc.or_, [pc.match_substring(column, v) for v in values if v is not None],
                       pa.array(np.zeros(len(column), dtype=bool)))
    elif op in ("from", "to"):
        found = (pc.greater_equal if op == "from" else pc.less_equal)(column, values[0])
    elif op in ("above", "below"):
        found = (pc.greater if op == "above" else pc.less)(pc.cast(column, pa.float64()), float(values[0]))
    else:
        raise ValueError(f"unknown test {op}")
    return pc.fill_null(found, False).to_numpy(zero_copy_only=False)


def _hits(words: Sequence[str]) -> str:
    """SQL for the hashes of a row's query words. Membership is tested on the
    words themselves; the hash only makes them cheap to hand to Python."""
    if not words:
        return "cast(array() as array<bigint>)"
    quoted = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)
    return f"transform(filter(__tok, t -> t IN ({quoted})), t -> xxhash64(t))"


def _lines(values: list) -> tuple[list, np.ndarray]:
    """Distinct values in order, and the line of each value."""
    place: dict = {}
    lines = np.array([place.setdefault(v, len(place)) for v in values], dtype=np.int64)
    return list(place), lines


def _block_of(rows: list) -> Block:
    texts, text_line = _lines([tuple(r["codes"] or ()) for r in rows])
    vectors, vector_line = _lines([None if r["vector"] is None else tuple(r["vector"]) for r in rows])
    matrix, size = None, max((len(v) for v in vectors if v is not None), default=0)
    if size:
        matrix = np.array([v if v is not None else [0.0] * size for v in vectors], dtype=float)
        length = np.linalg.norm(matrix, axis=1, keepdims=True)
        matrix = np.where(length > 0, matrix / np.where(length > 0, length, 1), 0.0)
    return Block(
        [r["query_id"] for r in rows], text_line, vector_line, [list(t) for t in texts], matrix,
        np.array([float(r["alpha"]) for r in rows]), np.array([int(r["limit"]) for r in rows]),
        np.array([float(r["least"]) for r in rows]),
        [tuple((t["column"], t["op"], tuple(t["values"])) for t in r["tests"]) for r in rows])


TESTS = "array<struct<column:string,op:string,values:array<string>>>"


def test(column: str, op: str, *values) -> Column:
    """One test for ``tests``: ``in`` (equals one of), ``contains`` (any of),
    ``from`` and ``to`` (text order, so times as ISO text), ``above`` and
    ``below`` (numbers)."""
    return F.struct(F.lit(column).alias("column"), F.lit(op).alias("op"), F.array(*[
        (v if isinstance(v, Column) else F.lit(v)).cast("string") for v in values]).alias("values"))


def all_of(*tests: Column) -> Column:
    """The conjunction of the tests; a null one is not made."""
    return F.array_compact(F.array(*tests)).cast(TESTS)


QUERY_DEFAULTS = {"text": ("string", None), "vector": ("array<double>", None),
                  "alpha": ("double", DEFAULT_ALPHA), "limit": ("int", DEFAULT_LIMIT),
                  "least": ("double", -1.0), "filter_on": ("string", None),
                  "filter_value": ("string", None)}


def search_all(corpus: DataFrame, queries: DataFrame, doc_id: str, text: str | None = None,
               vector: str | None = None, filters: Sequence[str] = (), block: int = 2500
               ) -> DataFrame:
    """Ranked results of every query: query_id, rank, id, score, semantic, keyword.

    ``queries`` has ``query_id`` and any of ``text, vector, alpha, limit, least,
    tests, filter_on, filter_value``. ``tests`` (see ``test``) is a conjunction
    per query over the columns named in ``filters``, ``filter_on`` a single column
    that must equal a value; they limit the candidates, not the statistics. Queries
    travel to the tasks in blocks of bounded size; every block reads and
    tokenises the collection once. A task hands on at most ``limit`` rows per
    query.
    """
    given = queries.columns
    none = F.array().cast(TESTS)
    tests = F.coalesce(F.col("tests").cast(TESTS), none) if "tests" in given else none
    full = queries.select("query_id", *[
        (F.col(c).cast(kind) if c in given else F.lit(default).cast(kind)).alias(c)
        for c, (kind, default) in QUERY_DEFAULTS.items()], tests.alias("tests"))
    single = F.struct(F.col("filter_on").alias("column"), F.lit("in").alias("op"), F.array("filter_value").alias("values"))
    full = full.withColumn("tests", F.concat("tests", all_of(F.when(F.col("filter_on").isNotNull(), single))))
    terms = F.array_distinct(T.tokens(F.col("text"))) if text else F.array().cast("array<string>")
    full = cut(full.withColumn("terms", terms).withColumn(
        "codes", F.transform("terms", lambda w: F.xxhash64(w))).drop("text"))
    blocks = max(1, -(-full.count() // block))
    numbered = full.withColumn("__b", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    results = []
    for number in range(blocks):
        # At most about ``block`` queries at a time reach the driver.
        rows = numbered.filter(F.col("__b") == number).orderBy("query_id").collect()
        if rows:
            results.append(_search_block(corpus, rows, queries, doc_id, text, vector, filters))
    return reduce(DataFrame.unionByName, results)


def _search_block(corpus: DataFrame, asked: list, queries: DataFrame, doc_id: str,
                  text: str | None, vector: str | None, filters: Sequence[str]) -> DataFrame:
    spark, block = corpus.sparkSession, _block_of(asked)
    unknown = {t[0] for tests in block.tests for t in tests} - set(filters)
    if unknown:
        raise ValueError(f"columns {sorted(unknown)} are tested but not among the filters")
    words = dict(pair for r in asked for pair in zip(r["terms"] or [], r["codes"] or []))
    if len(set(words.values())) != len(words):
        raise ValueError("two query words share a hash; use smaller blocks")
    tokens = T.tokens(F.col(text)) if text else F.array().cast("array<string>")
    columns = [F.col(doc_id), F.size("__tok").alias("__dl"), F.expr(_hits(sorted(words))).alias("__hits"),
               *[F.col(f).cast("string").alias(f) for f in filters]]
    if vector:
        columns.append(F.col(vector).alias("__vec"))
    rows = corpus.withColumn("__tok", tokens).select(*columns)

    if words:
        # A few numbers per row (and its vector) are kept: texts are tokenised once, not by each pass below.
        rows = cut(rows)
        # One row per term, and one under null for the collection as a whole.
        seen = rows.select("__dl", F.explode(F.concat(
            F.array(F.lit(None).cast("bigint")), F.array_distinct("__hits"))).alias("code"))
        counts = {r["code"]: r for r in seen.groupBy("code").agg(
            F.count("*").alias("n"), F.avg("__dl").alias("avgdl")).collect()}
        total = counts.pop(None, None)
        if total is not None:
            block.avgdl = float(total["avgdl"]) or 1.0
            block.idf = {c: float(np.log(1 + (total["n"] - r["n"] + 0.5) / (r["n"] + 0.5)))
                         for c, r in counts.items()}
    block.prepare()
    block.best_keyword = np.ones(len(block.ids))

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.zeros(len(block.ids))
        for part in block.slices(batches):
            score = block.keyword(part)
            if block.filtered:
                score = np.where(block.allowed(part), score, 0.0)
            top = np.maximum(top, score.max(axis=1, initial=0.0))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(top)), pa.int32()), pa.array(top)],
                                         names=["q", "top"])

    if words and (block.alpha < 1).any():
        lean = rows.drop("__vec") if vector else rows
        tops = lean.mapInArrow(highest, "q int, top double").groupBy("q").agg(F.max("top").alias("top"))
        for r in tops.collect():
            block.best_keyword[r["q"]] = r["top"]

    schema = StructType([
        StructField("query_id", queries.schema["query_id"].dataType),
        StructField(doc_id, corpus.schema[doc_id].dataType),
        *[StructField(c, DoubleType()) for c in ("score", "semantic", "keyword")]])
    arrow = to_arrow_schema(schema)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for part in block.slices(batches):
            found = block.best(part, doc_id)
            kept = block.keep(found if kept is None else pd.concat([kept, found]), doc_id)
        if kept is not None and len(kept):
            asked_by = [block.ids[i] for i in kept["__q"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked_by, arrow.field(0).type), pa.array(kept[doc_id], arrow.field(1).type),
                 *[pa.array(kept[c], pa.float64(), from_pandas=True)
                   for c in ("score", "semantic", "keyword")]], schema=arrow)

    ranked = top_n(rows.mapInArrow(best, schema), ["query_id"], [F.desc("score"), F.asc(doc_id)],
                   int(block.limit.max()), "rank", [doc_id])
    if len(set(block.limit)) > 1:
        limits = spark.createDataFrame(
            list(zip(block.ids, [int(x) for x in block.limit])),
            StructType([schema["query_id"], StructField("__limit", IntegerType())]))
        ranked = ranked.join(F.broadcast(limits), "query_id").filter(F.col("rank") <= F.col("__limit"))
    return ranked.select("query_id", "rank", doc_id, "score", "semantic", "keyword")


# -- metadata filters -------------------------------------------------------------------

# Filter keys by kind of comparison.
EQUAL_KEYS = ["productNumber", "productLine", "issueType", "resolutionCode", "status", "category",
              "caseNumber"]
CONTAINS_KEYS = ["productFamily", "rootCause"]


def metadata_filter(wanted: Mapping, date: str = "createdDate") -> Column | None:
    """A conjunction of the given keys, or None when nothing is asked for."""
    tests = [F.col(k) == wanted[k] for k in EQUAL_KEYS if wanted.get(k)]
    tests += [F.contains(F.col(k), F.lit(wanted[k])) for k in CONTAINS_KEYS if wanted.get(k)]
    if wanted.get("errorCodes"):
        tests.append(reduce(lambda a, b: a | b, [
            F.contains(F.col("errorCodes"), F.lit(code)) for code in wanted["errorCodes"]]))
    if wanted.get("priority"):
        tests.append(F.col("priority").isin(*wanted["priority"]))
    if wanted.get("dateRange"):
        kind = "timestamp_ntz"
        tests.append(F.col(date).between(F.lit(wanted["dateRange"]["start"]).cast(kind),
                                         F.lit(wanted["dateRange"]["end"]).cast(kind)))
    return reduce(lambda a, b: a & b, tests) if tests else None


COMPARISONS = {
    "$eq": lambda c, v: c == v, "$ne": lambda c, v: c != v, "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v, "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v,
    "$in": lambda c, v: c.isin(*v), "$contains": lambda c, v: F.contains(c, F.lit(v)),
}


def nested_filter(node: Mapping) -> Column:
    """``{"and": [...]}``, ``{"or": [...]}``, ``{"not": ...}`` or
    ``{field: value}`` / ``{field: {"$gt": value}}``; several fields mean and."""
    parts = []
    for key, value in node.items():
        if key in ("and", "or"):
            join = (lambda a, b: a & b) if key == "and" else (lambda a, b: a | b)
            parts.append(reduce(join, [nested_filter(n) for n in value]))
        elif key == "not":
            parts.append(~nested_filter(value))
        elif isinstance(value, Mapping):
            parts += [COMPARISONS[op](F.col(key), v) for op, v in value.items()]
        else:
            parts.append(F.col(key) == value)
    return reduce(lambda a, b: a & b, parts)


def has_code(codes: Column, wanted: Sequence[str]) -> Column:
    """Any code of a comma-separated list contains any wanted one."""
    return F.exists(F.split(codes, r",\s*"), lambda c: reduce(
        lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in wanted]))


# -- fallback -------------------------------------------------------------------------------

ENOUGH = 5
# Weight and limit per stage.
BY_COUNT = {1: (0.75, 5), 2: (0.75, 5), 3: (0.6, 5)}
URGENT = ["High", "Critical"]
BY_SCORE = {1: (0.8, 5, 0.85), 2: (0.8, 10, 0.75), 3: (0.6, 20, None)}


def stage_message(stage: Column, product: str, family: str) -> Column:
    return (F.when(stage == 1, F.lit("Results for the exact product"))
            .when(stage == 2, F.concat(F.lit("Results from "), F.col(family),
                                       F.lit(" product family (broadened from "), F.col(product), F.lit(")")))
            .otherwise(F.lit("Results from all products")))


def _at_stage(queries: DataFrame, product: str, family: str, settings: Mapping, first: Sequence[Column]) -> DataFrame:
    def pick(i: int, kind: str) -> Column:
        out = F.lit(None).cast(kind)
        for s, values in settings.items():
            out = F.when(F.col("stage") == s, F.lit(values[i]).cast(kind)).otherwise(out)
        return out
    tests = (F.when(F.col("stage") == 1, all_of(test(product, "in", F.col(product)), *first))
             .when(F.col("stage") == 2, all_of(test(family, "in", F.col(family)))).otherwise(F.array().cast(TESTS)))
    return queries.withColumns({"alpha": pick(0, "double"), "limit": pick(1, "int"), "tests": tests})


def _all_stages(corpus: DataFrame, queries: DataFrame, doc_id: str, text: str, vector: str, product: str,
                family: str, settings: Mapping, first: Sequence[Column] = (), also: Sequence[str] = ()) -> DataFrame:
    """Results of every stage of every query, with ``stage``: the stages run as
    separate queries of one search. Bounded by queries and limits, checkpointed."""
    key = "__stage_query"
    spread = queries.withColumn("stage", F.explode(F.array(*[F.lit(s) for s in settings])))
    spread = _at_stage(spread, product, family, settings, first).withColumn(
        key, F.concat_ws("#", F.col("query_id").cast("string"), F.col("stage").cast("string")))
    found = cut(search_all(corpus, spread.drop("query_id").withColumnRenamed(key, "query_id"), doc_id,
                           text, vector, [product, family, *also]))
    names = spread.select(F.col(key).alias("query_id"), F.col("query_id").alias("__qid"), "stage")
    return found.join(names, "query_id").drop("query_id").withColumnRenamed("__qid", "query_id")


def fallback_by_count(corpus: DataFrame, queries: DataFrame, doc_id: str, text: str, vector: str,
                      product: str, family: str, enough: int = ENOUGH) -> DataFrame:
    """Results of the narrowest stage that has enough of them, else of the
    widest. Results are counted, not candidates: a row of the right product
    without a vector and without a query word is none."""
    settings = {s: (alpha, max(limit, enough)) for s, (alpha, limit) in BY_COUNT.items()}
    found = _all_stages(corpus, queries, doc_id, text, vector, product, family, settings)
    full = (found.groupBy("query_id", "stage").agg(F.count("*").alias("n")).filter(F.col("n") >= enough)
            .groupBy("query_id").agg(F.min("stage").alias("stage")))
    told = queries.join(full, "query_id", "left").withColumn(
        "stage", F.coalesce("stage", F.lit(max(BY_COUNT)))).select(
        "query_id", "stage", stage_message(F.col("stage"), product, family).alias("message"))
    most = F.create_map(*[F.lit(x) for s, v in BY_COUNT.items() for x in (s, v[1])])
    return found.join(told, ["query_id", "stage"]).filter(F.col("rank") <= F.element_at(most, F.col("stage")))


def fallback_by_score(corpus: DataFrame, queries: DataFrame, doc_id: str, text: str, vector: str,
                      product: str, family: str, priority: str | None = None,
                      priorities: Sequence[str] = URGENT) -> DataFrame:
    """Results of the first stage whose best score passes its bar. With a
    ``priority`` column the first stage asks for one of ``priorities`` too."""
    first = [test(priority, "in", *priorities)] if priority else []
    found = _all_stages(corpus, queries, doc_id, text, vector, product, family, BY_SCORE, first,
                        [priority] if priority else [])
    bars = F.create_map(*[F.lit(x) for s, v in BY_SCORE.items() for x in (s, v[2] if v[2] else -1.0)])
    chosen = (found.filter((F.col("rank") == 1) & (F.col("score") > F.element_at(bars, F.col("stage"))))
              .groupBy("query_id").agg(F.min("stage").alias("stage")))
    return found.join(chosen, ["query_id", "stage"])


def adjusted_threshold(counts: Column, base: float = 0.7, step: float = 0.05, few: int = 5,
                       many: int = 50) -> Column:
    """Widen when there are fewer than ``few`` results, tighten above ``many``."""
    return F.when(counts < few, base - step).when(counts > many, base + step).otherwise(F.lit(base))


def search_adjusting(corpus: DataFrame, queries: DataFrame, doc_id: str, text: str | None = None,
                     vector: str | None = None, base: float = 0.7, step: float = 0.05, few: int = 5,
                     many: int = 50, limit: int = DEFAULT_LIMIT, filters: Sequence[str] = ()) -> DataFrame:
    """Search above ``base``; a query with too few results is widened by
    ``step``, one with too many tightened. One search at the widest threshold
    answers all three cases. Adds the ``threshold`` that was used."""
    wide = queries.withColumn("least", F.lit(base - step)).withColumn("limit", F.lit(max(limit, many + 1)))
    found = cut(search_all(corpus, wide, doc_id, text, vector, filters))
    counts = found.groupBy("query_id").agg(F.count_if(F.col("score") >= base).alias("__n")).select(
        "query_id", F.round(adjusted_threshold(F.col("__n"), base, step, few, many), DIGITS).alias("threshold"))
    return found.join(counts, "query_id").filter(
        (F.col("score") >= F.col("threshold")) & (F.col("rank") <= limit))


# -- after the search ---------------------------------------------------------------------------

def combine(left: DataFrame, right: DataFrame, doc_id: str, how: str = "max",
            weights: tuple[float, float] = (0.5, 0.5), limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Merge two result lists (issue and resolution search) into one."""
    both = left.select(doc_id, F.col("score").alias("a"), F.lit(None).cast("double").alias("b")).unionByName(
        right.select(doc_id, F.lit(None).cast("double").alias("a"), F.col("score").alias("b")))
    merged = both.groupBy(doc_id).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    score = (F.greatest("a", "b") if how == "max" else
             weights[0] * F.coalesce("a", F.lit(0.0)) + weights[1] * F.coalesce("b", F.lit(0.0)))
    return (merged.select(doc_id, F.round(score, DIGITS).alias("score"))
            .orderBy(F.desc("score"), doc_id).limit(limit))


def search_issue_and_resolution(corpus: DataFrame, doc_id: str, issue: str, resolution: str, query_vector: Column,
                                limit: int = DEFAULT_LIMIT, each: int = 20, how: str = "max",
                                weights: tuple[float, float] = (0.5, 0.5), least: float | None = None) -> DataFrame:
    """One query against both vectors of the cases: the best ``each`` by issue
    and by resolution, merged into one list."""
    lists = [nearest(corpus, doc_id, v, query_vector, each, least).select(doc_id, F.col("cosine").alias("score"))
             for v in (issue, resolution)]
    return combine(*lists, doc_id, how, weights, limit)


def similar_resolutions(corpus: DataFrame, doc_id: str, resolution: str, value, limit: int = 5) -> DataFrame:
    """Cases resolved like the given one, without it."""
    return similar_to(corpus, doc_id, resolution, value, limit)


def match_type(score: Column) -> Column:
    return (F.when(score > 0.9, "Exact semantic match").when(score > 0.8, "Strong semantic similarity")
            .when(score > 0.7, "Moderate similarity").otherwise("Metadata match"))


def present_results(results: DataFrame, corpus: DataFrame, doc_id: str, previews: Sequence[str],
                    columns: Sequence[str]) -> DataFrame:
    """Result rows with their metadata, previews and a match label."""
    details = corpus.select(doc_id, *columns, *[T.preview(F.col(p)).alias(p) for p in previews])
    return results.join(details, doc_id).withColumn("match_type", match_type(F.col("score")))


def recommend(corpus: DataFrame, doc_id: str, wanted: Mapping[str, str], weights: Mapping[str, float],
              success: Column, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Weighted matches on the wanted fields plus a weight for success."""
    score = reduce(lambda a, b: a + b, [
        F.when(F.col(k) == v, float(weights.get(k, 1.0))).otherwise(0.0) for k, v in wanted.items()])
    score = score + F.when(success, float(weights.get("success", 1.0))).otherwise(0.0)
    return corpus.withColumn("score", score).filter(F.col("score") > 0).orderBy(
        F.desc("score"), doc_id).limit(limit)


def boosted(results: DataFrame, boosts: Sequence[tuple[Column, float]]) -> DataFrame:
    """Multiply the score by each factor whose condition holds."""
    factor = reduce(lambda a, b: a * b, [F.when(test, float(f)).otherwise(1.0) for test, f in boosts])
    return results.withColumn("score", F.round(F.col("score") * factor, DIGITS))


def rerank(results: DataFrame, query: str, doc_id: str, boosts: Sequence[tuple[Column, float]],
           first: int = 50, final: int = 10) -> DataFrame:
    """Boost the first 50 of each query and keep the best 10."""
    head = boosted(results.filter(F.col("rank") <= first).drop("rank"), boosts)
    order = Window.partitionBy(query).orderBy(F.desc("score"), doc_id)
    return head.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= final)


def page(results: DataFrame, number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) of ranked results."""
    return results.filter((F.col("rank") > (number - 1) * size) & (F.col("rank") <= number * size))


def facets(results: DataFrame, fields: Sequence[str], top: int = 10) -> DataFrame:
    """Most frequent values per field and the true number of distinct rows."""
    long = results.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields
    ])).alias("x")).select("x.*").filter(F.col("value").isNotNull() & (F.col("value") != ""))
    counted = long.groupBy("field", "value").agg(F.count("*").alias("n"))
    return top_n(counted, ["field"], [F.desc("n"), F.asc("value")], top, "rank", ["value"])


def date_facet(results: DataFrame, date: str, unit: str = "month") -> DataFrame:
    return results.groupBy(F.date_trunc(unit, date).alias("period")).agg(F.count("*").alias("n"))


def filter_values(corpus: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Available values per field, one row each."""
    return corpus.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields
    ])).alias("x")).select("x.*").filter(F.col("value").isNotNull()).distinct()


def by_group(results: DataFrame, group: str, doc_id: str) -> DataFrame:
    """Results of a search per group: a row each, with the size ``n`` of its
    group, so no group is gathered however many searches it comes from."""
    sizes = results.groupBy(group).agg(F.count("*").alias("n"))
    return results.join(sizes, group).select(group, "n", "query_id", "rank", doc_id)


# -- strategies ------------------------------------------------------------------------------------

# Weight, result limit, least score and filter keys per use case.
STRATEGIES = [
    ("broad", 0.9, 20, 0.6, []),
    ("product", 0.75, 10, 0.7, ["productFamily", "status", "priority"]),
    ("error_code", 0.6, 10, 0.65, ["errorCodes"]),
    ("trend", 0.6, 50, 0.5, ["dateRange", "category"]),
    ("cross_product", 0.85, 30, 0.7, ["status", "category"]),
]
SKU = r"\b\d{6}-[A-Z]\d{2}\b"
CODE = r"(?i)\berror code\b|\b\d{4,}\b|\b\w+_\w+\b"
CONCEPT = r"(?i)^\s*(what|why|how|when|which)\b|\?\s*$"


def with_strategy(queries: DataFrame, strategy: str) -> DataFrame:
    """Weight, limit and least score from the named preset of each query."""
    presets = queries.sparkSession.createDataFrame(
        STRATEGIES, "name string, alpha double, limit int, least double, filter_keys array<string>")
    return queries.join(F.broadcast(presets), F.col(strategy) == F.col("name"), "left").drop("name")


def wanted_tests(wanted: Column, keys: Column, date: str = "createdDate") -> Column:
    """Tests from a map of filter keys to values. Of the keys only those of
    ``keys`` count; lists are comma-separated, a date range is ``start/end``."""
    def asked(key: str) -> Column:
        return F.when(F.array_contains(keys, key), F.try_element_at(wanted, F.lit(key)))

    def struct(column: str, op: str, values: Column) -> Column:
        return F.when(values.isNotNull(), F.struct(
            F.lit(column).alias("column"), F.lit(op).alias("op"), values.alias("values")))

    tests = [struct(k, "in", F.split(asked(k), ",")) for k in [*EQUAL_KEYS, "priority"]]
    tests += [struct(k, "contains", F.split(asked(k), ",")) for k in [*CONTAINS_KEYS, "errorCodes"]]
    ends = F.split(asked("dateRange"), "/")
    tests += [struct(date, "from", F.slice(ends, 1, 1)), struct(date, "to", F.slice(ends, 2, 1))]
    return all_of(*tests)


def search_by_strategy(corpus: DataFrame, queries: DataFrame, doc_id: str, text: str, vector: str,
                       strategy: str, wanted: str, date: str = "createdDate") -> DataFrame:
    """Every query with its preset's weight, limit and least score, filtered by
    those of its ``wanted`` values that the preset filters by."""
    ready = with_strategy(queries, strategy).withColumn("tests", wanted_tests(F.col(wanted), F.col("filter_keys"), date))
    columns = [c for c in [*EQUAL_KEYS, *CONTAINS_KEYS, "priority", "errorCodes", date] if c in corpus.columns]
    return search_all(corpus, ready, doc_id, text, vector, columns)


def family_test(text: Column, families: Sequence[tuple[str, str]], column: str = "productFamily") -> Column:
    """A test for the family of the product that a query names, null without one."""
    family = F.coalesce(*[F.when(text.rlike("(?i)" + p), F.lit(n)) for p, n in families])
    return F.when(family.isNotNull(), test(column, "in", family))


def query_class(text: Column) -> Column:
    return (F.when(text.rlike(SKU), "sku").when(text.rlike(CODE), "specific")
            .when(text.rlike(CONCEPT), "conceptual").otherwise("technical"))


def alpha_for(kind: Column) -> Column:
    """Middle of the recommended range of each class."""
    return (F.when(kind == "sku", 0.25).when(kind == "specific", 0.45)
            .when(kind == "conceptual", 0.85).otherwise(0.725))


# -- approximate neighbours ----------------------------------------------------------------------------

def kmeans_centres(df: DataFrame, vector: str, cells: int, seed: int = 42) -> DataFrame:
    """``cells`` centres of the collection: cell, centre."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    usable = df.filter(F.col(vector).isNotNull()).select(
        array_to_vector(V.l2_normalize(V.as_double(F.col(vector)))).alias("__features"))
    model = KMeans(k=cells, seed=seed, featuresCol="__features", maxIter=10).fit(usable)
    return df.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cell int, centre array<double>")


def nearest_cells(df: DataFrame, vector: str, centres: DataFrame, probes: int = 1) -> DataFrame:
    """``df`` with ``unit`` (its vector at length 1) and a row for each of the
    ``probes`` nearest ``cell``; the centres, some hundreds at most, ride along
    as one value."""
    table = centres.select("cell", V.l2_normalize(V.as_double(F.col("centre"))).alias("centre")).agg(
        F.sort_array(F.collect_list(F.struct("cell", "centre")))).scalar()
    near = F.slice(F.array_sort(F.transform(F.col("__cells"), lambda c: F.struct(
        (-V.dot(F.col("unit"), c["centre"])).alias("d"), c["cell"].alias("cell")))), 1, probes)
    return (df.filter(F.col(vector).isNotNull()).withColumn("unit", V.l2_normalize(V.as_double(F.col(vector))))
            .withColumn("__cells", table).withColumn("cell", F.explode(F.transform(near, lambda c: c["cell"])))
            .drop("__cells"))


def approximate(corpus: DataFrame, queries: DataFrame, doc_id: str, vector: str, cells: int = 0,
                probes: int = 2, limit: int = DEFAULT_LIMIT, centres: DataFrame | None = None) -> DataFrame:
    """Search only the ``probes`` cells nearest to each query.

    Rows and probes meet by cell, so a row is compared only with the queries
    that probe its cell; a cell is dealt over salts, and the few probes are
    repeated for each. Ranking is in two levels. ``centres`` (cell, centre) are
    given, or found by k-means.
    """
    centres = kmeans_centres(corpus, vector, cells) if centres is None else centres
    n = salts(corpus.sparkSession)
    rows = nearest_cells(corpus.select(doc_id, vector), vector, centres).select(
        doc_id, "cell", F.col("unit").alias("__row"), salt_of([F.col(doc_id)], n).alias("__part"))
    probed = nearest_cells(queries.select("query_id", "vector"), "vector", centres, probes).select(
        "query_id", "cell", "unit", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("__part"))
    near = rows.join(probed, ["cell", "__part"]).select("query_id", doc_id, F.round(
        V.certainty(V.dot(F.col("__row"), F.col("unit"))), DIGITS).alias("score"))
    return top_n(near, ["query_id"], [F.desc("score"), F.asc(doc_id)], limit, "rank", [doc_id])
