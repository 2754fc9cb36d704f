"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within radius r (even) share a value within r/2 of both, so
each distinct fingerprint emits every value within r/2 of it, and equal values
meet by a shuffle. All that meet there are within r of each other: at most 65
for r = 2, and linking each to the next in order keeps the group connected, so
no pairs are expanded. Each link is verified, repeated links go, and components
of the rest join by star operations. Copies count as one fingerprint throughout,
so a group of any size is one row until the last join.

Fingerprint: bit by bit majority of XXH64 (seed 42) over 3-word shingles of the
text with A-Z folded; a text of fewer words is one shingle, one without words
has fingerprint zero and links like any other.

Cases: a null text has no words; equal texts and repeated rows share a class;
null ids get a class but name it only if a class has no other (then it is null);
an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from casequarry.llm.common import as_bytes, chunks
from casequarry.llm.components import components
from casequarry.session import cut

SHINGLE = 3
RADIUS = 2
SEED = 42

# For each byte its eight bits, one in each byte of a 64-bit number.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    pieces = text.lower().split()  # bytes: A-Z only, blank and \t-\r only
    joined, digest = b" ".join(pieces), xxhash.xxh64_intdigest
    if len(pieces) <= size:
        return [digest(joined, SEED)] if pieces else []
    begins, ends, at = [], [], 0
    for piece in pieces:
        begins.append(at)
        at += len(piece)
        ends.append(at)
        at += 1
    return [digest(joined[b:e], SEED) for b, e in zip(begins, ends[size - 1:])]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint per row; ``counts`` says how many hashes each row has."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    ends = np.cumsum(counts[some])
    begins = ends - counts[some]
    # Sums of at most 255 hashes fit the byte lanes; rows are cut accordingly.
    cuts = [np.arange(b, e, 255) for b, e in zip(begins, ends)]
    first = np.cumsum([0, *(len(c) for c in cuts[:-1])])
    lanes = _LANES[np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, np.concatenate(cuts), axis=0).view(np.uint8).reshape(-1, 64)
    ones = np.add.reduceat(sums.astype(np.int64), first, axis=0)
    bits = ones * 2 > counts[some][:, None]
    out[some] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""
    def run(batches):
        for batch in batches:
            text = as_bytes(batch.column("text"))
            parts = [np.zeros(0, np.uint64)]
            for at, end, _, _ in chunks(text):
                rows = [shingle_hashes(text[i].as_py(), shingle) for i in range(at, end)]
                counts = np.array([len(r) for r in rows], np.int64)
                parts.append(majority(np.array([h for r in rows for h in r], np.uint64), counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(parts).view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, fp long")


def masks(distance: int) -> list[int]:
    """All 64-bit masks with at most ``distance`` bits, as longs."""
    out = [sum(1 << b for b in bits) for n in range(distance + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified links a, b that connect all distinct ``fp`` within ``radius`` of each other."""
    if radius % 2:
        raise ValueError("the radius must be even")
    flips = F.array(*(F.lit(m) for m in masks(radius // 2)))
    balls = prints.select("fp", F.explode(flips).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("value"))
    near = balls.select(F.col("fp").alias("a"), F.lag("fp").over(Window.partitionBy("value").orderBy("fp")).alias("b"))
    return near.where(F.col("b").isNotNull() & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).distinct()


def near_blocks(prints: DataFrame, key: str, radius: int, blocks: int) -> DataFrame:
    """a, b: ``key`` of rows (key, fp) that meet in a ball of a block of the fingerprint, next to each other, within ``radius`` bits.

    Of prints within the radius some block differs in at most radius / blocks bits, so
    balls of half that in each block share a value: wider than balls of all 64 bits can be, at as many
    rows. Unlike in ``links`` not all that meet are near, so each row meets the one before it only.
    """
    ends, half = [64 * i // blocks for i in range(blocks + 1)], -(-(radius // blocks) // 2)
    balls = []
    for block, (low, high) in enumerate(zip(ends, ends[1:])):
        bits = sum(1 << b for b in range(low, high))
        inside = F.col("fp").bitwiseAND(F.lit(bits - (1 << 64) if bits >> 63 else bits))
        balls += [F.struct(F.lit(block).alias("block"), inside.bitwiseXOR(F.lit(m)).alias("value"))
                  for m in masks(half) if (m & (1 << 64) - 1) | bits == bits]
    met = prints.select(key, "fp", F.explode(F.array(*balls)).alias("m")).select(key, "fp", "m.block", "m.value")
    order = Window.partitionBy("block", "value").orderBy("fp", key)
    near = met.select(F.col(key).alias("x"), "fp", F.lag(key).over(order).alias("y"), F.lag("fp").over(order).alias("other"))
    near = near.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius)
    return near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def classes(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest id reachable)."""
    each = cut(fingerprints(docs, shingle))
    prints = cut(each.groupBy("fp").agg(F.min("doc_id").alias("least")))
    joined = components(links(prints.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = prints.join(joined, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return each.join(rooted.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The documents that name their class, one row for each; all columns of the input.

    Of repeated rows of one id the first by a hash of the text stays; a class
    without any id keeps all of its rows, since none of them names it.
    """
    found = classes(docs, radius, shingle)
    stay = found.groupBy("component_id").agg(F.count("*").alias("__n")).where("component_id is not null").select(
        F.col("component_id").alias("__id"))
    nameless = found.where("component_id is null").limit(1).count()
    kept = docs.join(stay, docs["doc_id"] == stay["__id"], "left_semi")
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    if repeated:
        kept = kept.withColumn("__h", F.xxhash64("text"))
        first = Window.partitionBy("doc_id").orderBy("__h")
        kept = kept.withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__h", "__r")
    return kept.unionByName(docs.where("doc_id is null")) if nameless else kept
