"""Substring dedup over words by compacting a graph of repeated stretches.

The graph is a sparse de Bruijn graph: an edge is a run of 20-word windows with
one representative (see ``repeats``), a node where one edge follows another in a
text. Only edges that stand more than once in the corpus matter. Compaction joins
each edge's occurrences (its followers and predecessors, from all parts) and
tells whether all of them go on alike: if every occurrence of e is followed by f
and every one of f preceded by e, the path does not branch there and the two are
one. A text end counts as a branch, so each occurrence of a compacted path is
whole and the path has one name everywhere, its first edge.

Paths then meet by name with their source coordinates (document, word). Windows
of a path get the first coordinates that have them, and each repeated stretch is
compared word for word with its source before anything is removed.

Cases: a null text has no words; null ids come before all others; rows of one id
count as one document (an earlier start in any of them counts, the same start
does not); repeated rows get equal results; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casequarry.llm import repeats

WINDOW = 20
GRAM = 8


def _neighbours(part: repeats.Part) -> tuple[np.ndarray, np.ndarray]:
    """Value of the run behind and before each run; 0 where the text ends."""
    following, previous = [], []
    for chunk in part.chunks:
        r = chunk.runs
        touch = np.zeros(len(r.first) + 1, bool)
        touch[1:-1] = r.first[1:] == r.first[:-1] + r.count[:-1]
        value = np.concatenate([[np.uint64(0)], r.value, [np.uint64(0)]]).astype(np.uint64)
        following.append(np.where(touch[1:], value[2:], np.uint64(0)))
        previous.append(np.where(touch[:-1], value[:-2], np.uint64(0)))
    return np.concatenate(following), np.concatenate(previous)


def _single(index: np.ndarray, other: np.ndarray, n: int) -> np.ndarray:
    """Per group the one value all its members have, or 0."""
    order = np.lexsort((other, index))
    begins = np.searchsorted(index[order], np.arange(n))
    ends = np.append(begins[1:], len(order)) - 1
    low, high = other[order[begins]], other[order[ends]]
    return np.where(low == high, low, np.uint64(0))


def _send_edges(part: repeats.Part, repeated: np.ndarray, buckets: int):
    some = np.flatnonzero(repeated)
    if len(some):
        keep = repeated[part.index]
        following, previous = (x[keep] for x in _neighbours(part))
        index = np.searchsorted(some, part.index[keep])
        after, before = _single(index, following, len(some)), _single(index, previous, len(some))
        place = np.zeros(len(part.unique), np.int64)
        place[some] = np.arange(len(some))
        for bucket, mine in part.by_bucket(buckets, some):
            yield bucket, part.number, repeats.pack(part.unique[mine], after[place[mine]], before[place[mine]])
    yield repeats.note(part, repeated)


def _compact(table: pa.Table) -> pa.Table:
    """Per edge of a part: do all occurrences in the corpus have one follower, one predecessor?"""
    passed = repeats.pass_note(table)
    if passed is not None:
        return passed
    bucket = table.column("bucket")[0].as_py()
    got = [(p, *repeats.unpack(body, np.uint64, np.uint64, np.uint64)) for p, body in repeats.rows_of(table, "part")]
    edges, after, before = (np.concatenate([g[i] for g in got]) for i in (1, 2, 3))
    unique, index = np.unique(edges, return_inverse=True)
    ahead, behind = _single(index, after, len(unique)) != 0, _single(index, before, len(unique)) != 0
    out, at = [], 0
    for p, mine, _, _ in got:
        here = index[at:at + len(mine)]
        at += len(mine)
        out.append((p, bucket, repeats.bits(np.concatenate([ahead[here], behind[here]]))))
    return repeats.sent(out, repeats._ANSWER)


def _read_flags(part: repeats.Part, repeated: np.ndarray, answers: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Per unique value: one follower everywhere, one predecessor everywhere."""
    ahead, behind = np.zeros(len(part.unique), bool), np.zeros(len(part.unique), bool)
    got = dict(repeats.rows_of(answers, "bucket"))
    for bucket, mine in part.by_bucket(buckets, np.flatnonzero(repeated)):
        flags = repeats.unbits(got[bucket], 2 * len(mine))
        ahead[mine], behind[mine] = flags[:len(mine)], flags[len(mine):]
    return ahead, behind


def _joined(part: repeats.Part, repeated: np.ndarray, ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Per run, in this task's order of texts: it and the one behind it are one path."""
    out = []
    for chunk, index in zip(part.chunks, part.split(part.index)):
        r = chunk.runs
        join = np.zeros(len(r.first), bool)
        if len(join):
            join[:-1] = ((r.first[1:] == r.first[:-1] + r.count[:-1]) & repeated[index[:-1]] & repeated[index[1:]]
                         & ahead[index[:-1]] & behind[index[1:]])
        out.append(join)
    return np.concatenate(out) if out else np.zeros(0, bool)


def _gather(runs):
    """Contents by name; copies from different parts meet in a dictionary."""
    seen: dict[bytes, int] = {}
    numbers = [np.array([seen.setdefault(text, len(seen)) for text, _ in run], np.int64) for run in runs]
    return list(seen), numbers


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_kept: bool = False, **sizes) -> DataFrame:
    """Per document: n_words, n_removed, kept_sha256 (kept words with one blank between), and these words if asked for."""
    kind = repeats.Words(window, gram)
    dealt, buckets = repeats.deal(docs, **sizes)

    def values(table: pa.Table) -> pa.Table:
        part = repeats.Part(table, kind, True)
        inside = np.concatenate([c.runs.inside for c in part.chunks]) if part.chunks else np.zeros(0, bool)
        n = np.bincount(part.index, 1 + inside, len(part.unique)) if len(part.unique) else np.zeros(0)
        return repeats.send_values(part, buckets, n > 1)

    def edges(table: pa.Table, answers: pa.Table) -> pa.Table:
        part = repeats.Part(table, kind, False)
        return repeats.sent(_send_edges(part, repeats.read_values(part, answers, buckets), buckets))

    def paths(table: pa.Table, answers: pa.Table) -> pa.Table:
        part = repeats.Part(table, kind, False)
        repeated, = repeats.read_note(part, answers, bool)
        ahead, behind = _read_flags(part, repeated, answers, buckets)
        elements = repeats.Elements(part, repeated, _joined(part, repeated, ahead, behind), buckets)
        return repeats.sent([*elements.rows(), repeats.note(part, repeated, ahead, behind)])

    def sources(table: pa.Table) -> pa.Table:
        return repeats.answer_elements(table, kind, _gather)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        part = repeats.Part(table, kind, False)
        repeated, ahead, behind = repeats.read_note(part, answers, bool, bool, bool)
        joined = _joined(part, repeated, ahead, behind)
        out = []
        for chunk, gone in repeats.Elements(part, repeated, joined, buckets).covered(answers):
            text, begins, ends = kind.plain(chunk.data, chunk.begins, chunk.ends)
            for row in range(len(chunk.offsets) - 1):
                a, b = int(chunk.head[row]), int(chunk.head[row + 1])
                mine = gone[a:b]
                n = int(mine.sum())
                if n:
                    stay = (np.flatnonzero(~mine) + a)
                    kept = b" ".join(text[x:y] for x, y in zip(begins[stay].tolist(), ends[stay].tolist()))
                else:
                    kept = text[begins[a]:ends[b - 1]] if b > a else b""
                out.append((b - a, n, hashlib.sha256(kept).hexdigest(), kept.decode() if with_kept else None))
        columns = list(zip(*out)) or [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        n = 4 if with_kept else 3
        return pa.Table.from_arrays([part.doc_ids, *(pa.array(c, k) for c, k in zip(columns[:n], kinds))], names=names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_kept
    names = [x.split()[0] for x in schema.split(", ")]
    by_part = dealt.groupBy("part")
    marks = by_part.applyInArrow(values, repeats.SENT).groupBy("bucket").applyInArrow(repeats.answer_values, repeats.ANSWER)
    graph = by_part.cogroup(marks.groupBy("part")).applyInArrow(edges, repeats.SENT)
    flags = graph.groupBy("bucket").applyInArrow(_compact, repeats.ANSWER)
    sent = by_part.cogroup(flags.groupBy("part")).applyInArrow(paths, repeats.SENT)
    answers = sent.groupBy("bucket").applyInArrow(sources, repeats.ANSWER)
    return by_part.cogroup(answers.groupBy("part")).applyInArrow(finish, schema)
