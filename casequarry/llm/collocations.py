"""Phrase collocations per language by SON partitioning.

Shards are mined completely at a proportionally lowered support: of the support S
a shard with the share b/B of all text bytes needs S * b/B. If a phrase stays
below that in every shard, it stays below S, so the union of what is frequent in
some shard holds every frequent phrase. Those candidates are then counted over
all shards, exactly.

An absolute support on ever more text would leave shards of one task less than
one occurrence, and mining them would keep every phrase. So the number of shards
is fixed (``SHARDS``) and a shard is mined by many tasks, phrase length by phrase
length. Texts move once, to parts of bounded size; a part belongs to one shard.
For each length

* a part counts its phrases whose both shorter parts are candidates and sends
  hash and count once per different phrase to the hash's bucket;
* a bucket has all counts of its phrases: it adds up per shard, compares with the
  shard's support, unites what passes, and adds up the candidates over all shards;
* parts get one bit per phrase: candidate; one part gets the count of a phrase
  that reaches S and spells it out at the end.

A phrase in every text is one entry per part. Phrases are told apart by 96 bits
of two hashes (exact up to equal ones of those). Scores are exact decimals.

Cases: a null text is empty, a null language is ``und``; empty texts have no
words; rows that repeat count each time; phrases never cross a piece or a
document; equal scores and counts rank by phrase in byte order; an empty table
gives no rows; columns other than text, lang and doc_id are ignored. Texts of
any length are read whole; rows equal in id, language and text share a part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casequarry.llm import rolling
from casequarry.llm.common import as_bytes, layout
from casequarry.llm.repeats import ANSWER, SENT, _ANSWER, pack, pass_note, read_note, rows_of, sent, unpack
from casequarry.session import cut
from casequarry.skew import small_side, top_n

LONGEST, SUPPORT, TOP = 5, 100, 2000
SHARDS = 16
PART_BYTES, BUCKET_BYTES = 6_000_000, 12_000_000
_INSIDE = np.ones(256, bool)
_INSIDE[[32, 9, *b".,;:!?", *range(10, 14)]] = False
_PIECE_END = np.zeros(256, np.int32)
_PIECE_END[[*b".,;:!?", *range(10, 14)]] = 1
_OTHER = rolling.LOWER ^ np.uint8(0xA5)  # a second hash: other random values for the same bytes


def grouped(h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal (h, check) together, and which of them begin a group."""
    order = np.argsort(h, kind="stable")
    h, check = h[order], check[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    if (~new[1:] & (check[1:] != check[:-1])).any():
        again = np.lexsort((check, h))
        order, h, check = order[again], h[again], check[again]
        new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
    return order, new


class Words:
    """The words of a part, in one order whatever order its rows come in."""

    def __init__(self, table: pa.Table):
        self.number = table.column("part")[0].as_py()
        langs = [x.encode() for x in table.column("lang").to_pylist()]
        texts = as_bytes(table.column("text"))
        plain = texts.to_pylist()
        order = sorted(range(len(plain)), key=lambda i: (langs[i], plain[i]))
        self.langs = [langs[i] for i in order]
        del plain
        self.data, offsets = layout(texts.take(pa.array(order, pa.int64())))
        self.begins, self.ends, rows = rolling.words(self.data[:offsets[-1]], offsets, _INSIDE)
        self.rows = rows
        names = sorted(set(self.langs))
        salt = np.array([hash_of(x) for x in names], np.uint64)[np.searchsorted(np.array(names, object), np.array(self.langs, object))]
        n = len(self.begins)
        self.first, self.second = (
            rolling.mix(rolling.word_hashes(self.data, self.begins, self.ends, fold) ^ salt[rows]) if n else np.zeros(0, np.uint64)
            for fold in (rolling.LOWER, _OTHER))
        # Number of the first word behind each word's piece.
        stops = np.concatenate([[0], np.cumsum(_PIECE_END[self.data], dtype=np.int64)])
        last = np.ones(n, bool)
        last[:-1] = (stops[self.begins[1:]] != stops[self.ends[:-1]]) | (rows[1:] != rows[:-1])
        edges = np.flatnonzero(last) + 1
        self.piece_end = edges[np.searchsorted(edges, np.arange(n), "right")] if n else np.zeros(0, np.int64)

    def spelled(self, at: int, n: int) -> str:
        return " ".join(bytes(self.data[b:e]).lower().decode() for b, e in zip(self.begins[at:at + n], self.ends[at:at + n]))


def hash_of(name: bytes) -> int:
    data = np.frombuffer(name, np.uint8)
    return int(rolling.word_hashes(data, np.zeros(1, np.int64), np.array([len(data)]))[0]) if len(data) else 1


class Phrases:
    """The different phrases of ``n`` words of a part, by bucket and hash; ``shorter``: per word, n - 1 words from here are a candidate."""

    def __init__(self, words: Words, n: int, shorter: np.ndarray | None, buckets: int):
        at = np.arange(len(words.begins))
        at = at[at + n <= words.piece_end]
        if shorter is not None:
            at = at[shorter[at] & shorter[at + 1]]
        h = rolling.windows(words.first, n)[at]
        check = (rolling.windows(words.second, n)[at] >> np.uint64(32)).astype(np.uint32)
        order, new = grouped(h, check)
        group = np.cumsum(new) - 1
        heads = order[new]
        counts = np.bincount(group, minlength=len(heads)).astype(np.uint32)
        bucket = (h[heads] % np.uint64(buckets)).astype(np.int64)
        by = np.lexsort((check[heads], h[heads], bucket))
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        self.at, self.of = at, np.empty(len(at), np.int64)
        self.of[order] = rank[group] if len(group) else group
        self.h, self.check, self.counts, self.bucket = h[heads][by], check[heads][by], counts[by], bucket[by]
        # The first place, which is the same in every run since words have one order.
        self.head = np.full(len(by), len(words.begins))
        np.minimum.at(self.head, self.of, at)

    def per_bucket(self):
        names, begins = np.unique(self.bucket, return_index=True)
        yield from zip(names.tolist(), begins.tolist(), [*begins[1:].tolist(), len(self.bucket)])

    def rows(self, part: int):
        for bucket, a, z in self.per_bucket():
            yield bucket, part, pack(self.h[a:z], self.check[a:z], self.counts[a:z])


def answer(table: pa.Table, support: int, lowered: list[int]) -> pa.Table:
    """Per part: bits of its phrases that are candidates; numbers and counts of frequent ones that it is to spell."""
    passed = pass_note(table)
    if passed is not None:
        return passed
    bucket = table.column("bucket")[0].as_py()
    got = [(p, *unpack(body, np.uint64, np.uint32, np.uint32)) for p, body in rows_of(table, "part")]
    sizes = np.array([len(x[1]) for x in got])
    h, check, counts = (np.concatenate(x) for x in list(zip(*got))[1:])
    order, new = grouped(h, check)
    of = np.empty(len(h), np.int64)
    of[order] = np.cumsum(new) - 1
    total = np.bincount(of, counts).astype(np.int64)
    # Local supports: counts per phrase and shard.
    shards = len(lowered)
    pair = of * shards + np.repeat(np.array([x[0] % shards for x in got]), sizes)
    pairs, into = np.unique(pair, return_inverse=True)
    local = np.bincount(into, counts).astype(np.int64)
    candidate = np.zeros(len(total), bool)
    candidate[pairs[local >= np.array(lowered, np.int64)[pairs % shards]] // shards] = True
    frequent = candidate & (total >= support)
    # The first part that has a phrase spells it: rows are in order of parts.
    speaks = np.zeros(len(h), bool)
    speaks[np.unique(of, return_index=True)[1]] = True
    speaks &= frequent[of]
    out, at = [], 0
    for (part, *_), n in zip(got, sizes.tolist()):
        mine = np.flatnonzero(speaks[at:at + n])
        out.append((part, bucket, pack(np.packbits(candidate[of[at:at + n]]), mine.astype(np.uint32), total[of[at + mine]])))
        at += n
    return sent(out, _ANSWER)


class State:
    """What a part knows after a length: per word, whether a candidate begins there; what it is to spell."""

    def __init__(self, begins_candidate: np.ndarray | None, at, length, count):
        self.flags, self.at, self.length, self.count = begins_candidate, at, length, count

    @classmethod
    def first(cls):
        return cls(None, np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.int64))

    def note(self, part: int):
        flags = np.zeros(0, bool) if self.flags is None else self.flags
        return -1 - part, part, pack(np.packbits(flags), self.at, self.length, self.count)

    @classmethod
    def read(cls, words: Words, answers: pa.Table, n: int, buckets: int) -> "State":
        """The state after length ``n`` from the answers to it."""
        bits, at, length, count = read_note(words, answers, np.uint8, np.int64, np.int8, np.int64)
        shorter = np.unpackbits(bits, count=len(words.begins)).astype(bool) if n > 1 else None
        phrases = Phrases(words, n, shorter, buckets)
        got = dict(rows_of(answers, "bucket"))
        kept = np.zeros(len(phrases.h), bool)
        spell, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for bucket, a, z in phrases.per_bucket():
            flags, mine, c = unpack(got[bucket], np.uint8, np.uint32, np.int64)
            kept[a:z] = np.unpackbits(flags, count=z - a)
            spell.append(a + mine.astype(np.int64))
            counts.append(c)
        flags = np.zeros(len(words.begins), bool)
        flags[phrases.at] = kept[phrases.of]
        spell = np.concatenate(spell)
        return cls(flags, np.concatenate([at, phrases.head[spell]]), np.concatenate([length, np.full(len(spell), n, np.int8)]),
                   np.concatenate([count, *counts]))


def frequent(docs: DataFrame, longest: int = LONGEST, support: int = SUPPORT, shards: int = SHARDS,
             part_bytes: int = PART_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """lang, phrase, n (words), f: every phrase of up to ``longest`` words with f >= support; n = 0: all words of a language."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    key = F.xxhash64("doc_id", lang, F.xxhash64("text"))
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, buckets = max(least, -(-total // part_bytes)), max(least, -(-total // bucket_bytes))
    dealt = docs.select(F.pmod(key, F.lit(parts)).cast("int").alias("part"), lang.alias("lang"), "text")
    share = {r["s"]: r["b"] or 0 for r in dealt.groupBy((F.col("part") % shards).alias("s")).agg(F.sum(F.octet_length("text")).alias("b")).collect()}
    lowered = [max(1, -(-support * share.get(s, 0) // max(total, 1))) for s in range(shards)]

    def send(words: Words, state: State, n: int) -> pa.Table:
        return sent([*Phrases(words, n, state.flags, buckets).rows(words.number), state.note(words.number)])

    def begin(table: pa.Table) -> pa.Table:
        return send(Words(table), State.first(), 1)

    def step(n: int):
        def run(table: pa.Table, answers: pa.Table) -> pa.Table:
            words = Words(table)
            return send(words, State.read(words, answers, n - 1, buckets), n)
        return run

    def spell(table: pa.Table, answers: pa.Table) -> pa.Table:
        words = Words(table)
        state = State.read(words, answers, longest, buckets)
        names = [x.decode() for x in words.langs]
        rows = [(names[words.rows[at]], words.spelled(at, n), n, f)
                for at, n, f in zip(state.at.tolist(), state.length.tolist(), state.count.tolist())]
        many = np.bincount(words.rows, minlength=len(names)).tolist() if len(names) else []
        each: dict[str, int] = {}
        for name, n in zip(names, many):
            each[name] = each.get(name, 0) + n
        rows += [(name, None, 0, n) for name, n in each.items()]
        columns = list(zip(*rows)) or [[]] * 4
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int64()))],
                                    names=["lang", "phrase", "n", "f"])

    by_part = dealt.groupBy("part")
    told = by_part.applyInArrow(begin, SENT)
    for n in range(2, longest + 2):
        answers = told.groupBy("bucket").applyInArrow(lambda t: answer(t, support, lowered), ANSWER).groupBy("part")
        told = by_part.cogroup(answers).applyInArrow(*((step(n), SENT) if n <= longest else (spell, "lang string, phrase string, n int, f long")))
    return told


def _joined(words, first, size) -> F.Column:
    return F.array_join(F.slice(words, first, size), " ")


def ranked(found: DataFrame, top: int = TOP, scale: int = 1000, share: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language.

    ``share``: a phrase goes if a longer one that contains it has at least this many hundredths of its occurrences.
    """
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    totals = small_side(found.where("n = 0").groupBy("lang").agg(F.sum("f").alias("total")))
    counted = found.where("n > 0").select("lang", "phrase", F.col("n").alias("size"), "f")
    phrases = counted.where("size > 1").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))
    # A longer phrase as frequent is witnessed by one that is longer by one word.
    inside = F.explode(F.array(_joined(F.col("w"), F.lit(1), F.col("size") - 1), _joined(F.col("w"), F.lit(2), F.col("size") - 1)))
    longer = phrases.where("size > 2").select("lang", inside.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    stay = phrases.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")
    cuts = stay.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined(F.col("w"), F.lit(1), F.col("k")).alias("left"),
                       _joined(F.col("w"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    part = lambda side, f: counted.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    scored = (cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(totals, "lang")
              .withColumn("up", (exact("a") * exact("total")).cast("decimal(38,0)") * F.lit(scale))
              .withColumn("down", (exact("l") * exact("r")).cast("decimal(38,0)"))
              .withColumn("score", F.expr("cast(up as decimal(38,0)) div down")))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "total")).alias("c"))
    rows = best.select("lang", "phrase", F.col("c.a").alias("a"), F.col("c.l").alias("l"), F.col("c.r").alias("r"),
                       F.col("c.total").alias("n"), F.col("c.score").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    return top_n(rows, ["lang"], order, top, tiebreak=["phrase"]).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, longest: int = LONGEST, support: int = SUPPORT, top: int = TOP, **sizes) -> DataFrame:
    return ranked(cut(frequent(docs, longest, support, **sizes)), top)
