"""Near copies for the corpus pipeline: classes of texts whose 5-word shingles have Jaccard 0.8 or more.

Exact, up to equal 64-bit hashes: two shingle sets that alike share one of the
first n - ceil(0.8 n) + 1 values of each, in any one order of all values. The
order puts values that many sampled texts have last, so common passages seldom
stand in such a prefix; it decides cost, not results.

* One pass over the texts gives each row its set's key and prefix. Equal sets are
  one from here on.
* Prefixes, made longer by a tenth of the set, are dealt to parts; parts send each
  value once to its bucket and learn by one bit whether another set has it there
  too. Alike sets share more than some tenth of their values in these longer prefixes,
  so a set with fewer shared ones is done with: that leaves out texts that only have
  a passage in common. Rows per value and set are made of the others' shared values.
* Sets that still share a value are fetched once. Most values are shared by few sets
  (``PAIRED``): all pairs of these are compared once and such values are done with, so
  what follows is as large as the crowded values are. Links are looked for in rounds: first where
  the balls of their SimHash fingerprints meet (``simhash.near_blocks``) and along
  each set's rarest crowded values, then along all of them, each set with the ones next to
  it in an order by size or dealt at random, only where classes differ so far. That connects a large group by a few links a set.
  Fingerprints within ``RADIUS`` bits find most links, but at Jaccard 0.8 some sets are further apart. So at last, per value,
  all remaining pairs across classes, where all but the largest class meet the
  others: first a sixteenth of them, by a hash of the pair, which joins most that are
  linked at all, then what is left; a pair that shares many values is met at the first of them. Sizes and positions
  rule out pairs before sets are compared.

Cases: a null text has no words; texts without words are one class, a text of
fewer words than a shingle is one shingle; each class keeps exactly one row,
that of the smallest (doc_id, hash of the text), null ids last, and of rows equal
in both the one with the smallest hash of all columns; an empty table gives none;
other columns stay, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from casequarry.llm.common import as_bytes, chunks
from casequarry.llm.components import components, fitted
from casequarry.llm.repeats import ANSWER, SENT, answer_values, pack, rows_of, sent, unbits
from casequarry.llm.simhash import SEED, majority, near_blocks, shingle_hashes
from casequarry.session import cut
from casequarry.skew import small_side

SHINGLE = 5
ALIKE = (4, 5)  # Jaccard of at least 4 / 5
RADIUS, BLOCKS = 8, 3  # bits in which fingerprints of the first links may differ, and blocks of theirs that meet by balls
SAMPLE = 40_000  # texts that tell common values
COMMON, MOST = 2, 1 << 20  # of them with the value; so many values at most, the commonest (they order prefixes, no more)
FIRST = 3  # shared values along which a set is linked in the first round
SHARES = (16, 1)  # of the pairs that are left at last: first one in so many, which joins most classes, then all
SEEN = 16  # values of a set by which repeated meetings of one pair are told
TASK_ROWS = 50_000  # rows of a task that only moves numbers
PAIRED = 8  # sets of one value that are all compared at once: at most 28 pairs
CROWD = 4096  # rows of one value that are put in order together
PART_BYTES, BUCKET_BYTES = 2_000_000, 4_000_000


def prefix_size(n, more=False):
    """Two alike sets share one of their first so many values each; with ``more``, at least ``must_share`` of them."""
    up, down = ALIKE
    return n + (-up * n) // down + 1 + (n // 10 if more else 0)


def must_share(n):
    """The least that a set of n values shares with any alike set among both longer prefixes."""
    up, down = ALIKE
    return -(-up * n // down) // 10 + 1


def values(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, shingle), np.uint64))


def key_of(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED) if len(found) else 0).astype(np.int64))


def _rows(batches, columns):
    """Per chunk of texts: record batch, first and end row, one value array per row."""
    for batch in batches:
        text = as_bytes(batch.column("text"))
        for at, end, _, _ in chunks(text):
            yield [batch.column(c).slice(at, end - at) for c in columns], [values(text[i].as_py()) for i in range(at, end)]


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(f) for f in found)], dtype=np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def keyed(docs: DataFrame, sets: bool = False) -> DataFrame:
    """doc_id, h (of the text) and key (of the shingle set) of each row; with the set itself if asked for."""
    names = ["doc_id", "h", "key", *(["terms"] if sets else [])]

    def run(batches):
        for columns, found in _rows(batches, names[:2]):
            key = pa.array([key_of(f) for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, key, *([_lists(found)] if sets else [])], names=names)

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, h long, key long" + ", terms array<long>" * sets
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, schema)


def halves(found: np.ndarray) -> np.ndarray:
    """The upper halves of sorted values: enough to tell how common one is, which decides cost only."""
    return (found >> np.uint64(32)).astype(np.uint32)


def part_counts(table: pa.Table, buckets: int) -> pa.Table:
    """bucket, once (halves that one set of the part has), more (halves and their counts); each set counts once."""
    sets = dict(zip(table.column("key").to_pylist(), table.column("body").to_pylist()))
    names, counts = np.unique(np.frombuffer(b"".join(sets.values()), np.uint32), return_counts=True)
    bucket = names % np.uint32(buckets)
    by = np.argsort(bucket, kind="stable")
    names, counts, bucket = names[by], counts[by], bucket[by]
    found, begins = np.unique(bucket, return_index=True)
    rows = []
    for number, at, end in zip(found.tolist(), begins.tolist(), [*begins[1:].tolist(), len(bucket)]):
        some = counts[at:end] > 1
        more = np.stack([names[at:end][some], counts[at:end][some].astype(np.uint32)])
        rows.append({"bucket": number, "once": names[at:end][~some].tobytes(), "more": more.tobytes()})
    return pa.Table.from_pylist(rows, pa.schema([("bucket", pa.int32()), ("once", pa.binary()), ("more", pa.binary())]))


def bucket_counts(table: pa.Table) -> pa.Table:
    """value, n of the halves of a bucket that ``COMMON`` sets have."""
    once = np.frombuffer(b"".join(table.column("once").to_pylist()), np.uint32)
    more = [np.frombuffer(m, np.uint32).reshape(2, -1) for m in table.column("more").to_pylist()]
    names = np.concatenate([once, *(m[0] for m in more)])
    counts = np.concatenate([np.ones(len(once), np.int64), *(m[1].astype(np.int64) for m in more)])
    order = np.argsort(names, kind="stable")
    names, counts = names[order], counts[order]
    begins = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else np.zeros(0, np.int64)
    total = np.add.reduceat(counts, begins) if len(begins) else counts
    often = total >= COMMON
    return pa.table({"value": names[begins][often].astype(np.int64), "n": total[often]})


def common_values(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted halves of values that at least ``COMMON`` of some ``SAMPLE`` texts have, and how many have them."""
    def run(batches):
        seen = set()  # copies leave a task once
        for _, found in _rows(batches, []):
            sets = {k: f for k, f in ((key_of(f), f) for f in found) if k not in seen}
            seen.update(sets)
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.int64()), pa.array([halves(f).tobytes() for f in sets.values()], pa.binary())],
                                             names=["key", "body"])

    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    share = max(1, rows // SAMPLE)
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (size or 0) // share // PART_BYTES // 2)
    some = docs.where(F.pmod(F.xxhash64("text", F.lit(1)), F.lit(share)) == 0).select("text").mapInArrow(run, "key long, body binary")
    sent_counts = some.groupBy(F.pmod("key", F.lit(parts)).alias("part")).applyInArrow(lambda t: part_counts(t, parts), "bucket int, once binary, more binary")
    often = sent_counts.groupBy("bucket").applyInArrow(bucket_counts, "value long, n long")
    found = often.orderBy(F.desc("n"), "value").limit(MOST).toArrow()  # 16 bytes a value; as rows they took the driver some 200
    names = found.column("value").to_numpy().astype(np.uint32)
    order = np.argsort(names)
    return names[order], found.column("n").to_numpy()[order]


def prefixed(docs: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, h, key of each row; n (size of its set), fp (SimHash of it), body (longer prefix of the set, rare values first; null where its task had the key before)."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        often, counts = shared.value
        had = set()  # copies leave a task with one body
        for columns, found in _rows(batches, ["doc_id", "h"]):
            bodies, keys = [], [key_of(f) for f in found]
            for key, f in zip(keys, found):
                if key in had:
                    bodies.append(None)
                    continue
                had.add(key)
                seen = np.zeros(len(f), np.int64)
                if len(often) and len(f):
                    half = halves(f)
                    spot = np.minimum(np.searchsorted(often, half), len(often) - 1)
                    seen = np.where(often[spot] == half, counts[spot], 0)
                bodies.append(f[np.lexsort((f, seen))][:prefix_size(len(f), True) if len(f) else 0].tobytes())
            counts_of = np.array([len(f) for f in found], np.int64)
            prints = majority(np.concatenate([np.zeros(0, np.uint64), *found]), counts_of).view(np.int64)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(keys, pa.int64()), pa.array(counts_of.astype(np.int32)),
                                              pa.array(prints), pa.array(bodies, pa.binary())], names=["doc_id", "h", "key", "n", "fp", "body"])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, h long, key long, n int, fp long, body binary"
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, schema)


class Prefixes:
    """The prefixes of a part, each key's once and in order of keys, and their different values by bucket."""

    def __init__(self, table: pa.Table, buckets: int):
        columns = [table.column(c).to_pylist() for c in ("key", "n", "body")]
        rows = sorted({key: (key, n, body) for key, n, body in zip(*columns)}.values())
        self.part = table.column("part")[0].as_py()
        self.sizes = sizes = np.array([len(r[2]) // 8 for r in rows], np.int64)
        self.values = np.frombuffer(b"".join(r[2] for r in rows), np.uint64)
        self.key, self.n = (np.repeat(np.array([r[i] for r in rows], np.int64), sizes) for i in (0, 1))
        self.at = np.arange(len(self.values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        unique, of, counts = np.unique(self.values, return_inverse=True, return_counts=True)
        bucket = (unique % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        self.unique, self.several, self.bucket, self.of = unique[by], (counts > 1)[by], bucket[by], rank[of]

    def per_bucket(self):
        names, begins = np.unique(self.bucket, return_index=True)
        yield from zip(names.tolist(), begins.tolist(), [*begins[1:].tolist(), len(self.bucket)])

    def send(self) -> pa.Table:
        return sent((b, self.part, pack(self.unique[a:z], self.several[a:z])) for b, a, z in self.per_bucket())

    def shared(self, answers: pa.Table) -> pa.Table:
        got, more = dict(rows_of(answers, "bucket")), np.zeros(len(self.unique), bool)
        for b, a, z in self.per_bucket():
            more[a:z] = unbits(got[b], z - a)
        keep = more[self.of]
        if len(keep):
            begins = np.cumsum(self.sizes) - self.sizes
            met = np.add.reduceat(keep.astype(np.int64), begins)
            keep &= np.repeat(met >= must_share(self.n[begins]), self.sizes) & (self.at < prefix_size(self.n))
        return pa.table({"value": self.values[keep].view(np.int64), "key": self.key[keep], "n": self.n[keep], "at": self.at[keep].astype(np.int64)})


def shared_values(found: DataFrame, **sizes) -> DataFrame:
    """value, key, n (size of the set), at (place of the value in the order): prefix values of two or more sets that may be alike to others."""
    part_bytes, bucket_bytes = sizes.get("part_bytes", PART_BYTES), sizes.get("bucket_bytes", BUCKET_BYTES)
    # Bodies move once: those of one key, at most one a task, meet in a part and not before.
    distinct = found.where("n > 0 and body is not null").select("key", "n", "body")
    least = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = found.select(F.sum(F.octet_length("body"))).first()[0] or 0
    parts, buckets = max(least, -(-total // part_bytes)), max(least, -(-total // bucket_bytes))
    by_part = distinct.withColumn("part", F.pmod("key", F.lit(parts)).cast("int")).groupBy("part")
    answers = by_part.applyInArrow(lambda t: Prefixes(t, buckets).send(), SENT).groupBy("bucket").applyInArrow(answer_values, ANSWER)
    return by_part.cogroup(answers.groupBy("part")).applyInArrow(
        lambda t, a: Prefixes(t, buckets).shared(a), "value long, key long, n long, at long")


def _may(n, at, m, to):
    """Whether sets of sizes n and m whose first shared values are at ``at`` and ``to`` can be alike."""
    up, down = ALIKE
    most = F.least(n - at, m - to)
    return most * (up + down) >= (n + m) * up


def fetched(docs: DataFrame, found: DataFrame, rows: DataFrame) -> DataFrame:
    """key, terms: the set of each key in ``rows``, made again from one text that has it."""
    heads = found.join(rows.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.min(F.struct("doc_id", "h")).alias("r"))
    wanted = small_side(heads.select(F.col("r.doc_id").alias("_id"), F.col("r.h").alias("_h")))
    mine = docs.select("doc_id", "text").withColumn("h", F.xxhash64("text"))
    mine = mine.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left_semi").select("doc_id", "text")
    return keyed(mine, True).select("key", "terms").dropDuplicates(["key"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are alike."""
    up, down = ALIKE
    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("terms").alias("x")), "a").join(
        sets.select(F.col("key").alias("b"), F.col("terms").alias("y")), "b")
    met = F.size(F.array_intersect("x", "y"))
    return both.where(met * (up + down) >= (F.size("x") + F.size("y")) * up).select("a", "b")


def named(rows: DataFrame, edges: DataFrame | None) -> DataFrame:
    """``rows`` of values that sets of different classes have, with root."""
    if edges is None:
        return rows.withColumn("root", F.col("key"))
    roots = rows.join(components(edges, TASK_ROWS).withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    return roots.join(roots.groupBy("value").agg(F.min("root").alias("_r"), F.max("root").alias("_q")).where("_r != _q").select("value"), "value", "left_semi")


def crowded(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` of values that at most ``PAIRED`` sets have, and the others."""
    many = rows.groupBy("value").agg(F.count("*").alias("c")).where(F.col("c") > PAIRED).select("value")
    return rows.join(many, "value", "left_anti"), rows.join(many, "value", "left_semi")


def paired(rows: DataFrame) -> DataFrame:
    """a, b: all sets that share a value; for values that few sets have."""
    sets = F.sort_array(F.collect_list(F.struct("key", "n", "at")))
    after = lambda x, i: F.filter(F.slice("s", i + 2, F.size("s")), lambda y: _may(x["n"], x["at"], y["n"], y["at"]))
    pairs = F.flatten(F.transform("s", lambda x, i: F.transform(after(x, i), lambda y: F.struct(x["key"].alias("a"), y["key"].alias("b")))))
    return rows.groupBy("value").agg(sets.alias("s")).select(F.explode(pairs).alias("p")).select("p.a", "p.b").distinct()


def neighbours(rows: DataFrame, turn: int) -> DataFrame:
    """a, b: each set with the one before it of another class that has the same value, by size and dealt at random. A crowded value is split."""
    crowds = rows.groupBy("value").agg(F.ceil(F.count("*") / CROWD).alias("_c"))
    split = rows.join(crowds, "value").withColumn("_s", F.pmod(F.xxhash64("key", F.lit(turn)), F.col("_c")))
    met = []
    for order in (["n", "key"], [F.xxhash64("key", "value", F.lit(turn)), "key"]):
        w = Window.partitionBy("value", "_s").orderBy(*order)
        before = split.select("key", "n", "at", "root", *(F.lag(c).over(w).alias(f"_{c}") for c in ("key", "n", "at", "root")))
        met.append(before.where((F.col("_root") != F.col("root")) & _may(F.col("n"), F.col("at"), F.col("_n"), F.col("_at"))).select(
            F.least("key", "_key").alias("a"), F.greatest("key", "_key").alias("b")))
    return met[0].unionByName(met[1]).distinct()


def near_prints(found: DataFrame, rows: DataFrame) -> DataFrame:
    """a, b: sets of ``rows`` whose fingerprints meet in a ball, next to each other, and differ in at most ``RADIUS`` bits."""
    prints = found.join(rows.select("key").distinct(), "key", "left_semi").select("key", "fp").dropDuplicates(["key"])
    return near_blocks(prints, "key", RADIUS, BLOCKS)


def across(rows: DataFrame, share: int = 1) -> DataFrame:
    """a, b: all sets of different classes that share a value; or one in ``share`` of these pairs."""
    parts = rows.groupBy("value", "root").agg(F.count("*").alias("c"))
    most = parts.groupBy("value").agg(F.max(F.struct("c", "root"))["root"].alias("top"))
    # The first values of each set, so that a pair need not come up at each value it shares: not where both have an earlier one.
    first = rows.groupBy("key").agg(F.slice(F.sort_array(F.collect_list(F.struct("at", "value"))), 1, SEEN).alias("f"))
    seen = F.transform(F.filter("f", lambda x: x["at"] < F.col("at")), lambda x: x["value"])
    open_rows = fitted(cut(rows.join(first, "key").withColumn("seen", seen).drop("f").join(most, "value")), TASK_ROWS)
    few = open_rows.where("root != top").select("value", *(F.col(c).alias(f"_{c}") for c in ("key", "n", "at", "root", "seen")))
    met = few.join(open_rows, "value").where(
        ((F.col("root") == F.col("top")) | (F.col("_root") < F.col("root")))
        & _may(F.col("n"), F.col("at"), F.col("_n"), F.col("_at")) & ~F.arrays_overlap("seen", "_seen")
        & (F.pmod(F.xxhash64(F.least("key", "_key"), F.greatest("key", "_key")), F.lit(share)) == 0))
    return met.select(F.least("key", "_key").alias("a"), F.greatest("key", "_key").alias("b")).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, h, key, root (one for each class)."""
    found = cut(prefixed(docs, common_values(docs)))
    rows = fitted(cut(shared_values(found)), TASK_ROWS)
    sets = cut(fetched(docs, found, rows))
    kept = lambda df: fitted(cut(df), TASK_ROWS)
    few, rest = crowded(rows)
    many = kept(rest)
    first = F.row_number().over(Window.partitionBy("key").orderBy("at"))
    rarest = neighbours(kept(named(many.withColumn("_f", first).where(F.col("_f") <= FIRST).drop("_f"), None)), 0)
    edges = kept(verified(near_prints(found, rows).unionByName(paired(few)).unionByName(rarest).distinct(), sets))
    for step in (lambda left: neighbours(left, 1), *(lambda left, share=share: across(left, share) for share in SHARES)):
        left = kept(named(many, edges))
        if left.isEmpty():
            break
        edges = kept(edges.unionByName(verified(step(left), sets)))
    joined = components(edges, TASK_ROWS).withColumnRenamed("node", "key")
    return found.select("doc_id", "h", "key").join(joined, "key", "left").withColumn("root", F.coalesce("root", "key"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class; all columns of the input."""
    return first_rows(docs, classes(docs))


def first_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of each root in ``found`` (doc_id, h, root) the row of the smallest (doc_id, h), null ids last."""
    found = cut(found)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    stay = found.groupBy("root").agg(F.min(order).alias("r")).select("r.doc_id", "r.h")
    columns = docs.columns
    rows = docs.select(F.struct("*").alias("row")).withColumn("h", F.xxhash64("row.text"))
    kept = rows.alias("x").join(stay.alias("y"), F.col("x.row.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.h") == F.col("y.h")), "left_semi")
    if found.groupBy("doc_id", "h").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        first = Window.partitionBy("row.doc_id", "h").orderBy(F.xxhash64(F.to_json("row")))
        kept = kept.withColumn("r", F.row_number().over(first)).where("r = 1")
    return kept.select(*(F.col("row").getField(c).alias(c) for c in columns))
