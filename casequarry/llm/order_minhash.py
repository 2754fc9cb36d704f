"""Order MinHash fingerprints: sensitive to edit distance, not only to content.

K-mers are runs of ``K`` words; the n-th occurrence of a k-mer in a text is an
element of its own. Each of ``M`` hash functions picks the ``PICKED`` least
elements, puts them back into text order and hashes that tuple. The likeness of
two fingerprints is the share of places where they agree; it estimates how much
of the texts agrees in the same order.

Cases: a null text is empty; a text of 1 to K - 1 words has one k-mer, all of
it; a text without words has the fingerprint of no element, and two such texts
are alike; equal texts have equal fingerprints. Documents are ordered by doc_id
descending, null last, rows of one id by a hash of the text; the one after the
last is the first, and a single document is its own next one. An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casequarry.llm import rolling
from casequarry.llm.common import chunks

K, M, PICKED = 2, 48, 2
_LEAST = -(1 << 63)
_SEEDS = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64)
_TOP = np.uint64((1 << 64) - 1)


def _elements(data, offsets, k):
    """Hash of each occurrence-numbered k-mer in text order, and how many each row has."""
    n = len(offsets) - 1
    begins, ends, rows = rolling.words(data, offsets, rolling.NOT_BLANK)
    hashes = rolling.word_hashes(data, begins, ends)
    counts = np.bincount(rows, minlength=n)
    grams, owner = rolling.windows(hashes, k), rows[:max(0, len(rows) - k + 1)]
    whole = owner == rows[len(rows) - len(owner):]
    grams, owner = grams[whole], owner[whole]
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        first = np.searchsorted(rows, few)
        short = np.array([rolling.mix(hashes[a:a + c].cumsum(dtype=np.uint64)[-1:] + np.uint64(c))[0]
                          for a, c in zip(first, counts[few])], np.uint64)
        grams, owner = np.concatenate([grams, short]), np.concatenate([owner, few])
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
    # Number repeated k-mers within their row.
    tagged = rolling.mix(grams ^ rolling.mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(tagged, kind="stable")
    sorted_tags = tagged[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_tags[1:] != sorted_tags[:-1]
    starts = np.flatnonzero(new)
    number = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = number
    return rolling.mix(grams + occurrence * np.uint64(0xD6E8FEB86659FD93)), np.bincount(owner, minlength=n)


def signatures(data: np.ndarray, offsets: np.ndarray, k: int = K, m: int = M, picked: int = PICKED) -> np.ndarray:
    """An array (texts, m) of 32-bit numbers."""
    n = len(offsets) - 1
    out = np.zeros((n, m), np.uint32)
    elements, counts = _elements(data, offsets, k)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    sizes = counts[some]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    none = len(elements)
    known = np.append(elements, np.uint64(0))
    for j in range(m):
        value = rolling.mix(elements ^ _SEEDS[j])
        chosen = []
        for _ in range(picked):
            least = np.minimum.reduceat(value, starts)
            at = np.flatnonzero(value == np.repeat(least, sizes))
            at = at[np.searchsorted(at, starts)]
            at_value = value[at]
            value[at] = _TOP
            chosen.append(np.where(at_value == _TOP, none, at))
        tuples = np.sort(np.stack(chosen, axis=1), axis=1)
        h = np.full(len(some), np.uint64(j + 1))
        for c in range(picked):
            h = rolling.mix(h * np.uint64(0x9E3779B97F4A7C15) + known[tuples[:, c]])
        out[some, j] = (h >> np.uint64(32)).astype(np.uint32)
    return out


def fingerprints(texts: list[bytes], k: int = K, m: int = M, picked: int = PICKED) -> np.ndarray:
    column = pa.array(texts, pa.large_binary())
    parts = [signatures(data, offsets, k, m, picked) for _, _, data, offsets in chunks(column)]
    return np.concatenate(parts) if parts else np.zeros((0, m), np.uint32)


def edited(text: str, following: str) -> str:
    """The second half (rounded down) replaced by the first characters of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _bounds(docs: DataFrame, n: int) -> np.ndarray:
    """At most ``n`` - 1 ids that cut the table into parts of like size."""
    share = [i / n for i in range(1, n)]
    found = docs.select(F.percentile_approx("doc_id", share, 10_000).alias("x")).first()["x"] if share else None
    return np.unique(np.array(found or [], np.int64))


def _buckets(ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """Part 0 has the largest ids."""
    return len(bounds) - np.searchsorted(bounds, ids.fill_null(_LEAST).to_numpy(zero_copy_only=False), "right")


def neighbours(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """The rows dealt into consecutive ranges of doc_id, sorted in each by falling id.

    Columns: part, follows (1: a copy of the next range's first document, which
    only serves as the next one), doc_id, text. Texts move once; the driver sees
    one id per range.
    """
    n = parts or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(docs, n)

    def heads_of(batches):
        for batch in batches:
            part = _buckets(batch.column(0), bounds)
            ids = batch.column(0).fill_null(_LEAST).to_numpy(zero_copy_only=False)
            order = np.lexsort((-ids.astype(np.float64), part))
            first = order[np.unique(part[order], return_index=True)[1]]
            most = [int(ids[part == p].max()) for p in part[first]]
            yield pa.RecordBatch.from_arrays([pa.array(part[first], pa.int64()), pa.array(most, pa.int64())],
                                             names=["part", "head"])

    heads = {r["part"]: r["head"] for r in docs.select(F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        heads_of, "part long, head long").groupBy("part").agg(F.max("head").alias("head")).collect()}
    filled = sorted(heads)
    before = {heads[p]: filled[i - 1] for i, p in enumerate(filled)}  # a head also ends the range before it

    def deal(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            part = _buckets(ids, bounds)
            plain = ids.fill_null(_LEAST).to_pylist()
            copies = [(i, before[x]) for i, x in enumerate(plain) if x in before]
            take = pa.array([*range(len(plain)), *(i for i, _ in copies)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([*part.tolist(), *(p for _, p in copies)], pa.int64()),
                 pa.array([0] * len(plain) + [1] * len(copies), pa.int32()), ids.take(take),
                 batch.column("text").take(take)], names=["part", "follows", "doc_id", "text"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = narrow.mapInArrow(deal, "part long, follows int, doc_id long, text string")
    return dealt.repartition("part").sortWithinPartitions(
        "part", "follows", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def compare_with_next(docs: DataFrame, parts: int | None = None, k: int = K, m: int = M, picked: int = PICKED) -> DataFrame:
    """Fingerprints of each document and of its edited text, and likeness to that and to the next document."""

    def run(batches):
        carry = None  # part, doc_id, text of the row whose next one has not come yet
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                rows = list(zip(*(some.column(c).to_pylist() for c in ("part", "follows", "doc_id", "text"))))
                pairs = []
                for part, follows, doc_id, text in rows:
                    if carry and carry[0] == part:
                        pairs.append((carry[1], carry[2], text))
                    carry = None if follows else (part, doc_id, text)
                yield _compared(pairs)

    def _compared(pairs):
        texts, place = [], {}

        def at(text):
            raw = text.encode()
            if raw not in place:
                place[raw] = len(texts)
                texts.append(raw)
            return place[raw]

        changed = [edited(text, following) for _, text, following in pairs]
        index = [(at(text), at(new), at(following)) for (_, text, following), new in zip(pairs, changed)]
        prints = fingerprints(texts, k, m, picked)
        hexes = [p.astype(">u4").tobytes().hex() for p in prints]
        alike = lambda a, b: float((prints[a] == prints[b]).mean())
        columns = [[p[0] for p in pairs], [len(p[1]) for p in pairs],
                   [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                   [hexes[a] for a, _, _ in index], [hexes[b] for _, b, _ in index],
                   [alike(a, b) for a, b, _ in index], [alike(a, c) for a, _, c in index]]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                          names=[x.split()[0] for x in RESULT.split(", ")])

    return neighbours(docs, parts).mapInArrow(run, RESULT)
