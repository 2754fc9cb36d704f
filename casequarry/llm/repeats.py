"""Finding every window that also stands earlier in the corpus, exactly and without moving all windows.

A text is a sequence of units (bytes or words); a window is ``window``
consecutive units. Texts are dealt into parts of bounded size. In a part:

* Each window is represented by the least hash of the ``gram``-unit stretches in
  it. Windows in a row with the same least hash form a run. Equal windows have
  equal representatives, so whatever happens to a window can be decided among the
  runs of one value, and a run costs one number instead of one per window.
* ``prune`` (first exchange): the values of all runs go to buckets by value, once
  per part; what stands only once in the corpus is done with.
* The rest, ``elements`` (runs, or several runs that always stand together),
  go to the bucket of their value as strings: once per part and content, with the
  first place they stand at. A bucket finds the first place of each window and
  answers one bit per window of each string: is there an earlier place elsewhere?
* The part covers its texts by these bits and what it knows of its own places.

Only strings of repeated passages and numbers move; texts move once, to their
part, and are read there by each step (one exchange, used again). All that a part
sends, and keeps for later steps, is by sorted value or content, never by place
in the table, so a step that reads or computes its rows again may get them in any
order. Hot passages are one entry per part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from casequarry.llm import rolling
from casequarry.llm.common import as_bytes, chunks

LEAST = -(1 << 63)
PART_BYTES = 4_000_000
BUCKET_BYTES = 6_000_000
CHUNK = 1 << 19
ANSWER = "part int, bucket int, body binary"
SENT = "bucket int, part int, body binary"
_SENT = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("body", pa.binary())])
_ANSWER = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("body", pa.binary())])


class Bytes:
    """Units are bytes; a place is a document."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram

    def units(self, data, offsets):
        rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        at = np.arange(len(data))
        return at, at + 1, rows

    def values(self, data, begins, ends):
        return rolling.byte_values(data)

    def plain(self, data, begins, ends):
        """Bytes of the units as elements spell them, and where each begins and ends there."""
        return data.tobytes(), begins, ends

    spelled = units
    step = 0  # a window deeper in an element is no later a place


class Words:
    """Units are words, spelled with one blank between; a place is a document and a word number."""

    def __init__(self, window: int, gram: int):
        self.window, self.gram = window, gram

    def units(self, data, offsets):
        return rolling.words(data, offsets, rolling.NOT_BLANK)

    def values(self, data, begins, ends):
        return rolling.word_hashes(data, begins, ends)

    def plain(self, data, begins, ends):
        sizes = ends - begins
        before = np.concatenate([[0], np.cumsum(sizes)])
        starts = before[:-1] + np.arange(len(sizes))
        out = np.full(int(before[-1]) + len(sizes), 32, np.uint8)
        inside = np.arange(int(before[-1]))
        out[inside + np.repeat(starts - before[:-1], sizes)] = data[inside + np.repeat(begins - before[:-1], sizes)]
        return out.tobytes(), starts, starts + sizes

    spelled = units
    step = 1


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


class Runs:
    """Runs of windows with one representative: first window, number of windows, value, row, own repeats."""

    def __init__(self, values, rows, kind, count_inside: bool):
        L, k = kind.window, kind.gram
        n = len(values) - L + 1
        parts = []
        for at in range(0, max(0, n), CHUNK):  # a chunk of whole rows fits; only a longer row is cut, always alike
            parts.append(self._block(values[at:at + CHUNK + L - 1], rows[at:at + CHUNK + L - 1], L, k, count_inside, at))
        empty = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)]
        self.first, self.count, self.value, self.row, self.inside = (
            [np.concatenate(x) for x in zip(*parts)] if parts else empty)

    @staticmethod
    def _block(values, rows, L, k, count_inside, base):
        grams = rolling.windows(values, k)
        width = L - k + 1
        least = sliding_least(grams, width)
        n = len(least)
        whole = rows[:n] == rows[L - 1:]
        cut = np.ones(n, bool)
        cut[1:] = (least[1:] != least[:-1]) | ~whole[:-1]
        first = np.flatnonzero(whole & cut)
        breaks = np.append(np.flatnonzero(cut | ~whole), n)
        count = breaks[np.searchsorted(breaks, first, "right")] - first if len(first) else first
        value = np.maximum(least[first], np.uint64(1))  # 0 means "none"
        inside = np.zeros(len(first), bool)
        if count_inside and len(first):
            # A run in which its value stands twice may repeat windows of its own.
            sizes = count + width - 1
            begins = np.cumsum(sizes) - sizes
            index = np.arange(int(sizes.sum())) + np.repeat(first - begins, sizes)
            inside = np.add.reduceat((grams[index] == np.repeat(least[first], sizes)).astype(np.int64), begins) > 1
        return first + base, count, value, rows[first].astype(np.int64), inside


class Chunk:
    def __init__(self, at, data, offsets, kind, count_inside):
        self.at, self.data, self.offsets = at, data, offsets
        self.begins, self.ends, self.rows = kind.units(data, offsets)
        values = kind.values(data, self.begins, self.ends)
        self.runs = Runs(values, self.rows, kind, count_inside)
        self.head = np.searchsorted(self.rows, np.arange(len(offsets)))  # first unit of each row


class Part:
    """The texts of a part and their runs."""

    def __init__(self, table: pa.Table, kind, count_inside: bool):
        self.kind = kind
        self.number = table.column("part")[0].as_py()
        self.doc_ids = table.column("doc_id").combine_chunks()
        self.ids = self.doc_ids.fill_null(LEAST).to_numpy(zero_copy_only=False)
        text = as_bytes(table.column("text"))
        self.chunks = [Chunk(at, data, offsets, kind, count_inside) for at, _, data, offsets in chunks(text, CHUNK)]
        self.values = (np.concatenate([c.runs.value for c in self.chunks]) if self.chunks else np.zeros(0, np.uint64))
        self.unique, self.index = np.unique(self.values, return_inverse=True)

    def split(self, per_run: np.ndarray) -> list[np.ndarray]:
        return np.split(per_run, np.cumsum([len(c.runs.first) for c in self.chunks])[:-1])

    def by_bucket(self, buckets: int, some: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Bucket and places in ``unique``, in order; each bucket that has any."""
        places = np.arange(len(self.unique)) if some is None else some
        bucket = (self.unique[places] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        names, begins = np.unique(bucket[order], return_index=True)
        for name, mine in zip(names.tolist(), np.split(places[order], begins[1:])):
            yield name, mine


def rows_of(table: pa.Table, first: str) -> list[tuple[int, bytes]]:
    return sorted(zip(table.column(first).to_pylist(), table.column("body").to_pylist()))


def sent(rows: Iterable[tuple[int, int, bytes]], schema=_SENT) -> pa.Table:
    columns = list(zip(*rows)) or [[], [], []]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays behind one another, with their lengths, compressed."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def unpack(body: bytes, *types) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8)
    at, out = 8 * (n + 1), []
    for size, kind in zip(sizes.tolist(), types):
        out.append(np.frombuffer(raw[at:at + size], kind))
        at += size
    return out


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(bool)).tobytes()


def unbits(body: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(body, np.uint8), count=n).astype(bool)


# First exchange: which values stand more than once.

def send_values(part: Part, buckets: int, several: np.ndarray) -> pa.Table:
    """``several``: per unique value, whether the part alone has it more than once."""
    return sent((b, part.number, pack(part.unique[mine], several[mine])) for b, mine in part.by_bucket(buckets))


def answer_values(table: pa.Table) -> pa.Table:
    bucket = table.column("bucket")[0].as_py()
    got = [(p, *unpack(body, np.uint64, bool)) for p, body in rows_of(table, "part")]
    values = np.concatenate([v for _, v, _ in got])
    several = np.concatenate([s for _, _, s in got])
    _, index, counts = np.unique(values, return_inverse=True, return_counts=True)
    repeated = np.bincount(index, several, len(counts)) + counts > 1
    flags = np.split(repeated[index], np.cumsum([len(v) for _, v, _ in got])[:-1])
    return sent(((p, bucket, bits(f)) for (p, _, _), f in zip(got, flags)), _ANSWER)


def read_values(part: Part, answers: pa.Table, buckets: int) -> np.ndarray:
    """Per unique value: repeated in the corpus."""
    out = np.zeros(len(part.unique), bool)
    got = dict(rows_of(answers, "bucket"))
    for bucket, mine in part.by_bucket(buckets):
        out[mine] = unbits(got[bucket], len(mine))
    return out


def note(part: Part, *arrays: np.ndarray) -> tuple[int, int, bytes]:
    """A row that comes back to this part with the answers."""
    return -1 - part.number, part.number, pack(*arrays)


def pass_note(table: pa.Table) -> pa.Table | None:
    """The answer to a note is the note."""
    bucket = table.column("bucket")[0].as_py()
    return sent([(-1 - bucket, bucket, table.column("body")[0].as_py())], _ANSWER) if bucket < 0 else None


def read_note(part: Part, answers: pa.Table, *types) -> list[np.ndarray]:
    return unpack(dict(rows_of(answers, "bucket"))[-1 - part.number], *types)


# Elements: strings that have to be compared.

class Elements:
    """The repeated stretches of a part: per occurrence its place, per content a number.

    ``joined[r]``: run r and the one after it are one element.
    """

    def __init__(self, part: Part, repeated: np.ndarray, joined: np.ndarray | None, buckets: int):
        L = part.kind.window
        self.part, self.buckets = part, buckets
        per_chunk = part.split(repeated[part.index])
        joins = part.split(joined) if joined is not None else [None] * len(per_chunk)
        self.first, self.count, strings, values, docs, places = [], [], [], [], [], []
        for chunk, keep, join in zip(part.chunks, per_chunk, joins):
            runs = chunk.runs
            opens = keep.copy()
            if join is not None and len(keep):
                opens[1:] &= ~join[:-1]
            begin = np.flatnonzero(opens)
            group = np.cumsum(opens) - 1
            count = np.bincount(group[keep], runs.count[keep], len(begin)).astype(np.int64) if len(begin) else begin
            first = runs.first[begin]
            self.first.append(first)
            self.count.append(count)
            if not len(begin):
                continue
            text, b, e = part.kind.plain(chunk.data, chunk.begins, chunk.ends)
            strings += [text[x:y] for x, y in zip(b[first].tolist(), e[first + count + L - 2].tolist())]
            values.append(runs.value[begin])
            docs.append(part.ids[chunk.at + runs.row[begin]])
            places.append((first - chunk.head[runs.row[begin]]) * part.kind.step)
        none = np.zeros(0, np.int64)
        values = np.concatenate(values) if values else np.zeros(0, np.uint64)
        self.docs, self.places = (np.concatenate(x) if x else none for x in (docs, places))
        bucket_of = dict(zip(strings, (values % np.uint64(buckets)).tolist()))
        self.contents = sorted(bucket_of, key=lambda s: (bucket_of[s], s))
        number = {s: i for i, s in enumerate(self.contents)}
        self.of = np.fromiter(map(number.__getitem__, strings), np.int64, len(strings))
        self.bucket = np.array([bucket_of[s] for s in self.contents], np.int64)
        # First place of each content in this part, and its windows.
        order = np.lexsort((self.places, self.docs, self.of))
        head = order[np.searchsorted(self.of[order], np.arange(len(self.contents)))] if len(order) else order
        self.least_doc, self.least_place = self.docs[head], self.places[head]
        counts = np.concatenate(self.count) if self.count else none
        self.windows = counts[head] if len(head) else none

    def rows(self) -> Iterator[tuple[int, int, bytes]]:
        """A sorted, front-coded run of contents for each bucket."""
        edges = np.flatnonzero(np.diff(self.bucket)) + 1
        for mine in np.split(np.arange(len(self.contents)), edges):
            if len(mine):
                own = self.contents[mine[0]:mine[-1] + 1]
                yield (int(self.bucket[mine[0]]), self.part.number,
                       pack(*front_coded(own), self.least_doc[mine], self.least_place[mine]))

    def covered(self, answers: pa.Table) -> Iterator[tuple[Chunk, np.ndarray]]:
        """Per chunk its units that an earlier equal window covers."""
        total = np.concatenate([[0], np.cumsum(self.windows)])
        earlier = np.zeros(int(total[-1]), bool)
        got = dict(rows_of(answers, "bucket"))
        edges = np.flatnonzero(np.diff(self.bucket)) + 1
        for mine in np.split(np.arange(len(self.contents)), edges):
            if len(mine):
                a, b = total[mine[0]], total[mine[-1] + 1]
                earlier[a:b] = unbits(got[int(self.bucket[mine[0]])], int(b - a))
        at = 0
        for chunk, first, count in zip(self.part.chunks, self.first, self.count):
            here = slice(at, at + len(first))
            at += len(first)
            of, docs, places = self.of[here], self.docs[here], self.places[here]
            later = (docs > self.least_doc[of]) | ((docs == self.least_doc[of]) & (places > self.least_place[of]))
            begins = np.cumsum(count) - count
            deep = np.arange(int(count.sum())) - np.repeat(begins, count)
            gone = earlier[np.repeat(total[of], count) + deep] | np.repeat(later, count)
            starts = (np.repeat(first, count) + deep)[gone]
            steps = np.zeros(len(chunk.begins) + 1, np.int32)
            np.add.at(steps, starts, 1)
            np.subtract.at(steps, starts + self.part.kind.window, 1)
            yield chunk, np.cumsum(steps[:-1]) > 0


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, known to be at least ``at``."""
    n = min(len(a), len(b))
    while at + 16 <= n and a[at:at + 16] == b[at:at + 16]:
        at += 16
    while at < n and a[at] == b[at]:
        at += 1
    return at


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted strings: prefix shared with the one before, length of the rest, the rests."""
    shared, before = [], b""
    for s in strings:
        shared.append(common_prefix(before, s))
        before = s
    rests = [s[n:] for s, n in zip(strings, shared)]
    return (np.array(shared, np.uint32), np.array([len(r) for r in rests], np.uint32),
            np.frombuffer(b"".join(rests), np.uint8))


def front_decoded(shared: np.ndarray, sizes: np.ndarray, rests: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """The strings again, each with the prefix it shares with the one before."""
    text, at, before = rests.tobytes(), 0, b""
    for n, size in zip(shared.tolist(), sizes.tolist()):
        before = before[:n] + text[at:at + size]
        at += size
        yield before, n


Gathered = tuple[list[bytes], np.ndarray, np.ndarray, list[np.ndarray]]


def answer_elements(table: pa.Table, kind, gather: Callable[[list], Gathered]) -> pa.Table:
    """Per part one bit for each window of its contents: does it stand earlier than this content does there?

    ``gather`` takes, per part, an iterator of (content, shared prefix) and gives
    the different contents and per part the numbers of its own ones.
    """
    passed = pass_note(table)
    if passed is not None:
        return passed
    bucket = table.column("bucket")[0].as_py()
    got = [(p, unpack(body, np.uint32, np.uint32, np.uint8, np.int64, np.int64)) for p, body in rows_of(table, "part")]
    contents, numbers = gather([front_decoded(*x[:3]) for _, x in got])
    own_docs, own_places = [x[3] for _, x in got], [x[4] for _, x in got]
    # The first place of each content.
    flat, docs, places = np.concatenate(numbers), np.concatenate(own_docs), np.concatenate(own_places)
    order = np.lexsort((places, docs, flat))
    head = order[np.searchsorted(flat[order], np.arange(len(contents)))]
    docs, places = docs[head], places[head]
    # Contents by place, so that the first of equal windows is the earliest.
    by_place = np.lexsort((places, docs))
    earliest, owner, deep = first_windows([contents[i] for i in by_place], kind)
    g_doc = docs[by_place][owner[earliest]]
    g_place = places[by_place][owner[earliest]] + deep[earliest] * kind.step
    sizes = np.bincount(owner, minlength=len(contents))
    rank = np.empty(len(contents), np.int64)
    rank[by_place] = np.arange(len(contents))
    begin = np.cumsum(sizes) - sizes
    out = []
    for (p, _), mine, d, q in zip(got, numbers, own_docs, own_places):
        n = sizes[rank[mine]]
        into = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(begin[rank[mine]], n) + into
        d, q = np.repeat(d, n), np.repeat(q, n) + into * kind.step
        out.append((p, bucket, bits((g_doc[at] < d) | ((g_doc[at] == d) & (g_place[at] < q)))))
    return sent(out, _ANSWER)


def first_windows(contents: list[bytes], kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of the contents in order: the first equal window, its content, its place there.

    Windows are grouped by hash; then each stretch of windows that equals a
    stretch further up is compared with it byte by byte.
    """
    L = kind.window
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in contents])]).astype(np.int64)
    text = b"".join(contents)
    data = np.frombuffer(text, np.uint8)
    begins, ends, rows = kind.spelled(data, offsets)
    hashes = rolling.windows(kind.values(data, begins, ends), L)
    whole = np.flatnonzero(rows[:len(hashes)] == rows[L - 1:])
    owner = rows[whole].astype(np.int64)
    deep = whole - np.searchsorted(rows, np.arange(len(contents)))[owner]
    h = hashes[whole]
    order = np.argsort(h, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    heads = order[np.flatnonzero(new)]
    earliest = np.empty(len(order), np.int64)
    earliest[order] = heads[np.cumsum(new) - 1]
    moved = np.flatnonzero(earliest != np.arange(len(order)))
    if len(moved):
        to = earliest[moved]
        cut = np.ones(len(moved), bool)
        cut[1:] = ((moved[1:] != moved[:-1] + 1) | (to[1:] != to[:-1] + 1)
                   | (owner[moved[1:]] != owner[moved[:-1]]) | (owner[to[1:]] != owner[to[:-1]]))
        a = np.flatnonzero(cut)
        z = np.append(a[1:], len(moved)) - 1
        spans = zip(begins[whole[moved[a]]].tolist(), ends[whole[moved[z]] + L - 1].tolist(),
                    begins[whole[to[a]]].tolist(), ends[whole[to[z]] + L - 1].tolist())
        if any(text[b:e] != text[x:y] for b, e, x, y in spans):
            earliest = _first_windows_by_text(text, begins[whole], ends[whole + L - 1])
    return earliest, owner, deep


def _first_windows_by_text(text: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same without hashes, for the case that two different windows share one."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(text[b:e], i) for i, (b, e) in enumerate(zip(begins.tolist(), ends.tolist()))], np.int64)


def deal(docs: DataFrame, part_bytes: int = PART_BYTES, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """part, doc_id, text; and the number of buckets. Both numbers follow the size of the texts.

    Rows are dealt by id and text, so only rows that repeat both must share a part.
    """
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts, buckets = max(least, -(-total // part_bytes)), max(least, -(-total // bucket_bytes))
    number = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(parts)).cast("int")
    return docs.select(number.alias("part"), F.col("doc_id").cast("long").alias("doc_id"), "text"), buckets
