"""Suffix dedup: byte strings that an earlier document has, by a distributed merge sort of suffix runs.

The suffixes that can repeat (see ``repeats``; a suffix is sampled at the run of
windows it represents and ends with them) are sorted in their part. Each part
sends one sorted, front-coded run per bucket; a bucket merges the runs with a
loser tree that knows, for each candidate, the prefix it shares with the last
string put out. Candidates with different prefixes are ordered by that number
alone, equal ones are compared from there on, and a run's next string brings its
prefix from the front coding, so no known prefix is compared again. Equal
suffixes come out behind one another; their 50-byte windows get the first
document that has them.

Cases: a null text has no bytes; null ids are one document before all others;
rows of one id are one document, so they never remove from each other; repeated
rows get equal results; an empty table gives no rows; other columns are ignored.
Cutting may split a character, so kept texts are binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casequarry.llm import repeats
from casequarry.llm.repeats import common_prefix

WINDOW = 50
GRAM = 24


def merged(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int, int]]:
    """All strings of the sorted runs in order: string, prefix shared with the one before, run.

    A run gives (string, prefix shared with its string before).
    """
    size = 1
    while size < len(runs):
        size *= 2
    now: list[bytes] = [b""] * size
    known = [-1] * size  # prefix shared with the last string put out; -1: the run is empty
    for i, run in enumerate(runs):
        first = next(run, None)
        if first is not None:
            now[i], known[i] = first[0], 0

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's known prefix becomes the one it shares with the winner."""
        x, y = known[a], known[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        s, t = now[a], now[b]
        n = common_prefix(s, t, x)
        if n == len(s) or (n < len(t) and s[n] < t[n]):
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    losers = [0] * size
    level = list(range(size))
    node = size
    while len(level) > 1:
        node //= 2
        up = []
        for k in range(0, len(level), 2):
            win, lose = play(level[k], level[k + 1])
            losers[node + k // 2] = lose
            up.append(win)
        level = up
    win = level[0]
    while known[win] >= 0:
        yield now[win], known[win], win
        following = next(runs[win], None) if win < len(runs) else None
        if following is None:
            known[win] = -1
        else:
            now[win], known[win] = following
        node = (win + size) // 2
        while node:
            win, losers[node] = play(win, losers[node])
            node //= 2


def _gather(runs):
    contents: list[bytes] = []
    numbers: list[list[int]] = [[] for _ in runs]
    for text, shared, run in merged(runs):
        if not contents or not len(text) == shared == len(contents[-1]):
            contents.append(text)
        numbers[run].append(len(contents) - 1)
    return contents, [np.array(n, np.int64) for n in numbers]


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_kept: bool = False, **sizes) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for."""
    kind = repeats.Bytes(window, gram)
    dealt, buckets = repeats.deal(docs, **sizes)

    def values(table: pa.Table) -> pa.Table:
        part = repeats.Part(table, kind, False)
        ids = np.concatenate([part.ids[c.at + c.runs.row] for c in part.chunks]) if part.chunks else part.ids[:0]
        order = np.lexsort((ids, part.index))
        begins = np.searchsorted(part.index[order], np.arange(len(part.unique)))
        ends = np.append(begins[1:], len(order)) - 1
        several = ids[order[begins]] < ids[order[ends]] if len(order) else np.zeros(0, bool)
        return repeats.send_values(part, buckets, several)

    def suffixes(table: pa.Table, answers: pa.Table) -> pa.Table:
        part = repeats.Part(table, kind, False)
        repeated = repeats.read_values(part, answers, buckets)
        return repeats.sent([*repeats.Elements(part, repeated, None, buckets).rows(), repeats.note(part, repeated)])

    def merge(table: pa.Table) -> pa.Table:
        return repeats.answer_elements(table, kind, _gather)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        part = repeats.Part(table, kind, False)
        repeated, = repeats.read_note(part, answers, bool)
        out = []
        for chunk, gone in repeats.Elements(part, repeated, None, buckets).covered(answers):
            for row in range(len(chunk.offsets) - 1):
                a, b = chunk.offsets[row], chunk.offsets[row + 1]
                mine = gone[a:b]
                n = int(mine.sum())
                kept = (chunk.data[a:b][~mine] if n else chunk.data[a:b]).tobytes()
                spans = int(mine[:1].sum() + (mine[1:] & ~mine[:-1]).sum()) if n else 0
                out.append((int(b - a), n, spans, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        n = 5 if with_kept else 4
        return pa.Table.from_arrays([part.doc_ids, *(pa.array(c, k) for c, k in zip(columns[:n], kinds))], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    names = [x.split()[0] for x in schema.split(", ")]
    by_part = dealt.groupBy("part")
    marks = by_part.applyInArrow(values, repeats.SENT).groupBy("bucket").applyInArrow(repeats.answer_values, repeats.ANSWER)
    sent = by_part.cogroup(marks.groupBy("part")).applyInArrow(suffixes, repeats.SENT)
    answers = sent.groupBy("bucket").applyInArrow(merge, repeats.ANSWER)
    return by_part.cogroup(answers.groupBy("part")).applyInArrow(finish, schema)
