"""Benchmark decontamination with a broadcast hash set of test n-grams.

The windows of all benchmark items become a sorted array of 64-bit hashes and a
map from the window itself to its items. Tasks roll a hash over the words of
their texts, look it up, compare the words of every hit, and mark what the
window covers. No row moves. A benchmark beyond ``BLOCK_BYTES`` is cut into
blocks of that size by a hash of the item; the texts then pass one block after
the other and hits add up in a column, so what is broadcast has a fixed bound.

Cases: a null text has no words and null stays null in the cleaned text; an item
without words has no window; items without id are ignored; repeated items count
once by id; repeated documents are judged each for itself; other columns are
never read by ``scan`` and pass unchanged through ``clean``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casequarry.llm import rolling
from casequarry.llm.common import as_bytes, chunks, sliced

WINDOW = 10
BLOCK_BYTES = 16_000_000
# Fixed by the task's definition of a word: digits, lower-case letters, all beyond ASCII.
INSIDE = np.zeros(256, bool)
INSIDE[0x30:0x3A] = INSIDE[0x41:0x5B] = INSIDE[0x61:0x7B] = INSIDE[0x80:] = True

RESULT = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
_HITS = "__hits"  # begin and length in words, and item ids, of what earlier blocks found


class Grams:
    """Windows of some benchmark items, by length in words."""

    def __init__(self, rows: list[tuple[str, str]], window: int):
        self.items: dict[bytes, set[str]] = {}
        by_length: dict[int, list[np.ndarray]] = {}
        for item, text in rows:
            data = np.frombuffer((text or "").encode(), np.uint8)
            begins, ends, _ = rolling.words(data, np.array([0, len(data)]), INSIDE)
            n = min(window, len(begins))
            if not n:
                continue
            folded = rolling.LOWER[data]
            pieces = [folded[b:e].tobytes() for b, e in zip(begins, ends)]
            for i in range(len(pieces) - n + 1):
                self.items.setdefault(b" ".join(pieces[i:i + n]), set()).add(item)
            hashes = rolling.windows(rolling.word_hashes(data, begins, ends, rolling.LOWER), n)
            by_length.setdefault(n, []).append(hashes)
        self.by_length = {n: np.unique(np.concatenate(h)) for n, h in by_length.items()}

    def hits(self, data, begins, ends, rows) -> Iterator[tuple[int, int, set[str]]]:
        """First word, length and items of each window that occurs."""
        if not self.by_length or not len(begins):
            return
        hashes = rolling.word_hashes(data, begins, ends, rolling.LOWER)
        folded = None
        for n, wanted in self.by_length.items():
            rolled = rolling.windows(hashes, n)
            if not len(rolled):
                continue
            marks = np.zeros(1 << 16, bool)
            marks[wanted >> np.uint64(48)] = True
            at = np.flatnonzero(marks[rolled >> np.uint64(48)] & (rows[n - 1:] == rows[:len(rolled)]))
            place = np.searchsorted(wanted, rolled[at])
            at = at[wanted[np.minimum(place, len(wanted) - 1)] == rolled[at]]
            for i in at.tolist():
                if folded is None:
                    folded = rolling.LOWER[data].tobytes()
                key = b" ".join(folded[b:e] for b, e in zip(begins[i:i + n].tolist(), ends[i:i + n].tolist()))
                items = self.items.get(key)
                if items:
                    yield i, n, items


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> list:
    """Broadcast variables of at most about ``block_bytes`` of item text each.

    An item's windows hold each of its words up to ``window`` times, so blocks
    are sized by that.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).where(
        "i is not null and t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total * window // block_bytes))
    context = benchmark.sparkSession.sparkContext
    out = []
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("i"), F.lit(n)) == k).collect()
        out.append(context.broadcast(Grams([tuple(r) for r in rows], window)))
    return out


def _found(batch: pa.RecordBatch, text: pa.LargeBinaryArray, grams: Grams):
    """Per row of the batch: word begins and ends (chunk-relative), and its hits so far."""
    old = batch.column(_HITS).to_pylist() if _HITS in batch.schema.names else None
    for at, end, data, offsets in chunks(text):
        begins, ends, rows = rolling.words(data, offsets, INSIDE)
        first = np.searchsorted(rows, np.arange(end - at + 1))
        hits: list[list[tuple[int, int, set[str]]]] = [[] for _ in range(end - at)]
        for i, n, items in grams.hits(data, begins, ends, rows):
            row = int(rows[i])
            hits[row].append((i - int(first[row]), n, items))
        for row in range(end - at):
            mine = hits[row]
            if old is not None:
                mine = mine + [(h["b"], h["n"], set(h["items"])) for h in old[at + row] or []]
            words = slice(first[row], first[row + 1])
            yield at + row, begins[words] - offsets[row], ends[words] - offsets[row], mine


def _covered(count: int, hits) -> np.ndarray:
    steps = np.zeros(count + 1, np.int64)
    for b, n, _ in hits:
        steps[b] += 1
        steps[b + n] -= 1
    return np.cumsum(steps[:-1]) > 0


def _collect(docs: DataFrame, block) -> DataFrame:
    schema = pa.list_(pa.struct([("b", pa.int64()), ("n", pa.int64()), ("items", pa.list_(pa.string()))]))

    def run(batches):
        for batch in batches:
            text = as_bytes(batch.column("text"))
            hits = [[{"b": b, "n": n, "items": sorted(items)} for b, n, items in mine]
                    for _, _, _, mine in _found(batch, text, block.value)]
            keep = [c for c in batch.schema.names if c != _HITS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(hits, schema)], names=keep + [_HITS])

    fields = [f"`{c}` {t}" for c, t in docs.dtypes if c != _HITS]
    return docs.mapInArrow(run, ", ".join([*fields, f"{_HITS} array<struct<b:long,n:long,items:array<string>>>"]))


def _with_all_but_last(docs: DataFrame, blocks: list) -> DataFrame:
    for block in blocks[:-1]:
        docs = _collect(docs, block)
    return docs


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: words, hit words, items met and a digest of their ids."""
    blocks = _blocks(benchmark, window, block_bytes)
    last = blocks[-1]

    def run(batches):
        for batch in batches:
            out = []
            for _, begins, _, hits in _found(batch, as_bytes(batch.column("text")), last.value):
                items = sorted(set().union(*(i for _, _, i in hits))) if hits else []
                n_hit = int(_covered(len(begins), hits).sum()) if hits else 0
                out.append((len(begins), n_hit, len(items),
                            hashlib.sha256(",".join(items).encode()).hexdigest(), n_hit > 0))
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", *(x.split()[0] for x in RESULT.split(", "))])

    narrow = _with_all_but_last(docs.select("doc_id", "text"), blocks)
    return narrow.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {RESULT}")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with the words of every occurring window cut out of ``text``.

    A run of hit words goes from its first byte to its last; what stands around
    it stays. All columns of the input are returned.
    """
    blocks = _blocks(benchmark, window, block_bytes)
    last = blocks[-1]

    def run(batches):
        for batch in sliced(batches):
            column = batch.column("text")
            text = as_bytes(column)
            new = column.to_pylist()
            for row, begins, ends, hits in _found(batch, text, last.value):
                if not hits:
                    continue
                hit = np.flatnonzero(np.diff(np.r_[0, _covered(len(begins), hits).view(np.int8), 0]))
                raw, at, kept = text[row].as_py(), 0, []
                for first, end in hit.reshape(-1, 2):
                    kept.append(raw[at:begins[first]])
                    at = int(ends[end - 1])
                new[row] = b"".join([*kept, raw[at:]]).decode()
            names = [c for c in batch.schema.names if c != _HITS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, column.type) if c == "text" else batch.column(c) for c in names], names=names)

    return _with_all_but_last(docs, blocks).mapInArrow(run, docs.schema)
