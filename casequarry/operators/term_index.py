"""A stored token table: one search reads the postings of its own words and no text.

The table is a folder of segments. A segment has ``postings`` (term, id, tf, length of
the text), in one folder per bucket of the term's hash and sorted by term, and
``docs`` (id, length, hash of the text, the vector and the columns to filter by). A search
for five words opens at most five bucket folders and, in them, the row groups that
hold the words. A manifest, written last, names the segments and has the
statistics over live rows: their number, how many have a text, the texts' total length.

``put`` adds a segment with new and changed rows, ``remove`` one with deletions;
what an id has in older segments is dead from then on, so an update costs what
changed and never rewrites the rest. Texts are taken apart where they are read: only those of
an id that comes more than once move, and postings move by word, not one by one. ``compact`` merges all into one segment. Each writes
under the next number and counts once its manifest is complete; repeating a number
that is complete changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from casequarry.functions import text as T
from casequarry.functions import vectors as V
from casequarry.operators.search import B, DEFAULT_ALPHA, DEFAULT_LIMIT, DIGITS, K1, fuse, query_terms
from casequarry.session import cut
from casequarry.skew import is_small
from casequarry.sources.sinks import current_version, write_version

BUCKETS = 64
PART_BYTES = 8_000_000  # of texts that must meet by id in one task
CHUNK_WORDS = 2_000_000  # of texts whose postings are grouped at once
COLUMNS = ("id", "length", "row", "vector", "deleted")


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _last(rows: DataFrame) -> DataFrame:
    """Of several rows of one id the last by the text's hash."""
    last = Window.partitionBy("id").orderBy(F.desc("row"))
    return rows.withColumn("__r", F.row_number().over(last)).filter("__r = 1").drop("__r")


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` by id in parts of some ``PART_BYTES`` of text, so that parts do not grow with the table."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = rows.select(F.sum(F.octet_length("body"))).first()[0] or 0
    return rows.repartition(max(least, -(-total // PART_BYTES)), "id")


def _single(rows: DataFrame) -> DataFrame:
    """``_last`` of ``rows``, where texts of ids that come once stay where they are, unless too many others are to be looked up."""
    again = cut(rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"))
    if again.isEmpty():
        return rows
    if not is_small(again):
        return _last(_dealt(rows))
    again = F.broadcast(again)
    return rows.join(again, "id", "left_anti").unionByName(_last(_dealt(rows.join(again, "id", "left_semi"))))


def _grouped(texts: DataFrame) -> DataFrame:
    """``texts`` (id, tokens) as term, ids, lengths, tfs: per chunk of texts and word who has it, how long these texts are and how often they have it."""
    def run(batches):
        for batch in batches:
            counts = batch.column("tokens").value_lengths().fill_null(0).to_numpy()
            part = (np.cumsum(counts) - counts) // CHUNK_WORDS
            begins = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
            for at, end in zip(begins, [*begins[1:], len(counts)]):
                words = batch.column("tokens").slice(at, end - at).flatten().dictionary_encode()
                of = np.repeat(np.arange(end - at), counts[at:end])
                pairs, tf = np.unique(words.indices.to_numpy().astype(np.int64) * (end - at) + of, return_counts=True)
                code, of = np.divmod(pairs, end - at)
                ends = pa.array(np.searchsorted(code, np.arange(len(words.dictionary) + 1)).astype(np.int32))
                found = (batch.column("id").slice(at, end - at).take(pa.array(of)), pa.array(counts[at:end][of].astype(np.int32)), pa.array(tf.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([words.dictionary, *(pa.ListArray.from_arrays(ends, f) for f in found)], names=["term", "ids", "lengths", "tfs"])

    return texts.mapInArrow(run, f"term string, ids array<{dict(texts.dtypes)['id']}>, lengths array<int>, tfs array<int>")


@dataclass
class TermIndex:
    spark: SparkSession
    folder: str
    buckets: int = BUCKETS

    # -- what is stored --------------------------------------------------------------

    def manifest(self) -> tuple[int, list[int], int, int, int]:
        """Newest number (-1 if none), its segments; of live rows: how many, with a text, total length."""
        newest = current_version(self.spark, f"{self.folder}/manifests")
        if newest is None:
            return -1, [], 0, 0, 0
        rows = self.spark.read.parquet(newest).collect()  # a line per segment
        return int(newest.rsplit("=", 1)[1]), sorted(r["segment"] for r in rows if r["segment"] is not None), rows[0]["n"], rows[0]["texts"], rows[0]["length"]

    def _path(self, number: int, part: str) -> str:
        return f"{self.folder}/segments/segment={number:08d}/{part}"

    def _union(self, segments: Sequence[int], part: str) -> DataFrame:
        frames = [self._read(s, part).withColumn("segment", F.lit(s)) for s in segments]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def _read(self, segment: int, part: str) -> DataFrame:
        if part == "docs":
            return self.spark.read.parquet(self._path(segment, part))
        # A segment of deletions has no file, so the schema is given.
        key = self._read(segment, "docs").schema["id"].dataType.simpleString()
        schema = f"id {key}, length int, term string, tf int, bucket int"
        return self.spark.read.schema(schema).parquet(self._path(segment, part))

    def _alive(self, rows: DataFrame, segments: Sequence[int]) -> DataFrame:
        """``rows`` without those whose id a later segment speaks of; only later segments are read for that, and one segment alone needs no join."""
        if len(segments) < 2:
            return rows
        latest = self._union(segments[1:], "docs").groupBy("id").agg(F.max("segment").alias("__last"))
        return rows.join(latest, "id", "left").filter(F.col("__last").isNull() | (F.col("segment") == F.col("__last"))).drop("__last")

    def docs(self) -> DataFrame:
        """Live rows."""
        segments = self.manifest()[1]
        return self._alive(self._union(segments, "docs"), segments).filter(~F.col("deleted")).drop("segment", "deleted")

    def postings(self, terms: Sequence[str] | None = None) -> DataFrame:
        """Live postings, of some terms or all."""
        segments = self.manifest()[1]
        rows = self._union(segments, "postings")
        if terms is not None:
            places = [_bucket(F.lit(w), self.buckets) for w in terms]
            rows = rows.filter(F.col("bucket").isin(*places) & F.col("term").isin(*terms)) if terms else rows.limit(0)
        return self._alive(rows, segments).select("term", "id", "tf", "length")

    # -- changes -----------------------------------------------------------------------

    def put(self, rows: DataFrame, doc_id: str, text: str, vector: str | None = None, keep: Sequence[str] = (), number: int | None = None,
            vectors: DataFrame | None = None) -> None:
        """New and changed rows. Of several rows of one id the last by the text's hash counts; null ids are left out.

        ``vectors`` has the column ``vector`` of a table of its own by ``doc_id``: it meets the rows after their texts have been counted.
        """
        if set(keep) & set(COLUMNS):
            raise ValueError(f"{sorted(set(keep) & set(COLUMNS))} are columns of the table itself")
        as_vector = (F.col(vector).cast("array<double>") if vector else F.lit(None).cast("array<double>")).alias("vector")
        fresh = rows.filter(F.col(doc_id).isNotNull()).select(
            F.col(doc_id).alias("id"), F.col(text).alias("body"), F.xxhash64(text).alias("row"), *([as_vector] if vectors is None else []), *keep)
        docs = fresh.withColumn("length", F.size(T.tokens(F.col("body")))).drop("body")
        if vectors is not None:
            docs = docs.join(vectors.select(F.col(doc_id).alias("id"), as_vector), "id", "left")
        self._commit(number, _last(docs).withColumn("deleted", F.lit(False)).select(*COLUMNS, *keep), fresh.select("id", "body", "row"))

    def remove(self, ids: DataFrame, doc_id: str, number: int | None = None) -> None:
        """Ids that are to be found no more; unknown ones do no harm."""
        gone = ids.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id")).distinct()
        self._commit(number, gone.select("id", F.lit(0).alias("length"), F.lit(0).cast("long").alias("row"), F.lit(None).cast("array<double>").alias("vector"),
                                         F.lit(True).alias("deleted")))

    def _commit(self, number: int | None, docs: DataFrame, texts: DataFrame | None = None) -> None:
        done, segments, *stats = self.manifest()
        number = done + 1 if number is None else number
        if done >= number:
            return
        docs.write.mode("overwrite").parquet(self._path(number, "docs"))
        docs = self.spark.read.parquet(self._path(number, "docs"))
        self._write_postings(number, self._taken_apart(docs.limit(0).select("id", F.lit("").alias("body")) if texts is None else _single(texts)))
        counts = (F.count("*"), F.count("length"), F.coalesce(F.sum("length"), F.lit(0)))
        added = docs.filter(~F.col("deleted")).agg(*counts).first()
        replaced = self.docs().select("id", "length").join(docs.select("id"), "id", "left_semi").agg(*counts).first() if segments else (0, 0, 0)
        self._publish(number, [*segments, number], *(old + plus - less for old, plus, less in zip(stats, added, replaced)))

    def _taken_apart(self, texts: DataFrame) -> DataFrame:
        """Postings of ``texts`` (id, body) by bucket."""
        grouped = _grouped(texts.select("id", T.tokens(F.col("body")).alias("tokens"))).withColumn("bucket", _bucket(F.col("term"), self.buckets))
        one = grouped.hint("rebalance", F.col("bucket")).select("term", "bucket", "lengths", "tfs", F.posexplode("ids").alias("at", "id"))
        return one.select("id", F.col("lengths")[F.col("at")].alias("length"), "term", F.col("tfs")[F.col("at")].alias("tf"), "bucket")

    def _write_postings(self, number: int, postings: DataFrame) -> None:
        # Rebalanced before, so a bucket with a very frequent word is several files; sorted, so row groups are read by term.
        postings.sortWithinPartitions("bucket", "term", "id").write.mode("overwrite").partitionBy(
            "bucket").parquet(self._path(number, "postings"))

    def _publish(self, number: int, segments: Sequence[int], n: int, texts: int, length: int) -> None:
        lines = [(s, n, texts, length) for s in segments]
        write_version(self.spark.createDataFrame(lines, "segment int, n long, texts long, length long").coalesce(1), f"{self.folder}/manifests", number)

    def compact(self, number: int | None = None) -> None:
        """One segment of all live rows."""
        done, segments, *stats = self.manifest()
        number = done + 1 if number is None else number
        if done >= number or not segments:
            return
        self.docs().withColumn("deleted", F.lit(False)).write.mode("overwrite").parquet(self._path(number, "docs"))
        self._write_postings(number, self.postings().withColumn("bucket", _bucket(F.col("term"), self.buckets)).hint("rebalance", F.col("bucket")))
        self._publish(number, [number], *stats)

    # -- searches ------------------------------------------------------------------------

    def search(self, query: str, query_vector: Column | None = None, search_type: str = "hybrid", limit: int = DEFAULT_LIMIT,
               alpha: float = DEFAULT_ALPHA, candidates: Column | None = None, least: float | None = None) -> DataFrame:
        """id, semantic, keyword, score of the best rows for one query, as ``search.search`` over the texts gives them.

        ``candidates`` tests columns of ``docs``; statistics are of all live rows. Postings and vectors meet in one
        aggregate by id with map-side combine; a word in every text is spread like any other rows.
        """
        weights = {"hybrid": alpha, "vector": 1.0, "bm25": 0.0}
        if search_type not in weights:
            raise ValueError(f"unknown search type {search_type}")
        _, _, n, texts, length = self.manifest()
        average = length / texts if length else 1.0
        hits = self.postings(query_terms(query))
        frequency = hits.groupBy("term").agg(F.count("*").alias("df")).agg(
            F.map_from_entries(F.collect_list(F.struct("term", "df")))).scalar()  # as many entries as the query has words
        df, tf = F.col("__df")[F.col("term")], F.col("tf")
        idf = F.log(1 + (F.lit(float(n)) - df + 0.5) / (df + 0.5))
        weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.lit(average)))
        keyword = hits.withColumn("__df", frequency).select("id", F.lit(None).cast("boolean").alias("wanted"), F.lit(None).cast("double").alias("semantic"), weight.alias("kw"))
        wanted = F.lit(True) if candidates is None else F.coalesce(candidates, F.lit(False))
        docs = self.docs().filter(wanted)
        if query_vector is not None:
            docs = docs.withColumn("__q", query_vector)
            near = F.when(F.col("vector").isNotNull(), V.certainty(V.cosine(F.col("vector"), V.as_double(F.col("__q")))))
        else:
            near = F.lit(None).cast("double")
        docs = docs.select("id", F.lit(True).alias("wanted"), near.alias("semantic"), F.lit(None).cast("double").alias("kw"))
        if candidates is None:
            docs = docs.filter(F.col("semantic").isNotNull())
        rows = docs.unionByName(keyword).groupBy("id").agg(F.max("wanted").alias("wanted"), F.max("semantic").alias("semantic"), F.sum("kw").alias("kw"))
        if candidates is not None:
            rows = rows.filter("wanted")
        rows = cut(rows.drop("wanted"))
        best = rows.agg(F.max("kw")).scalar()
        rows = rows.withColumn("keyword", F.when(best > 0, F.coalesce(F.col("kw"), F.lit(0.0)) / best).otherwise(F.lit(0.0)))
        keep = {"hybrid": F.col("semantic").isNotNull() | (F.col("keyword") > 0), "vector": F.col("semantic").isNotNull(), "bm25": F.col("keyword") > 0}[search_type]
        rows = rows.filter(keep).withColumn("score", F.round(fuse(F.col("semantic"), F.col("keyword"), weights[search_type]), DIGITS))
        if least is not None:
            rows = rows.filter(F.col("score") >= least)
        return rows.select("id", "semantic", "keyword", "score").orderBy(F.desc("score"), "id").limit(limit)
