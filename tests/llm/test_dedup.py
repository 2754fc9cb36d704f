"""Span and suffix dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from casequarry.llm import repeats, span_dedup, suffix_dedup
from tests.llm.tables import docs  # noqa: F401

LEAST = -(1 << 63)


def order(doc_id):
    return LEAST if doc_id is None else doc_id


def brute_words(rows, window=20):
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - window + 1):
            key, at = tuple(w[k:k + window]), (order(i), k)
            first[key] = min(first.get(key, at), at)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < (order(i), k):
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def brute_bytes(rows, window=50):
    first = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for k in range(len(b) - window + 1):
            key = b[k:k + window]
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - window + 1):
            if first[b[k:k + window]] < order(i):
                gone[k:k + window] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((i, len(b), int(gone[:-1].sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    """Texts of few words with shared passages, copies, loops, nulls, empties, repeated rows and ids."""
    r = random.Random(seed)
    vocabulary = ["a", "bb", "the", "é", "日本", "x" * 9, "of", "q1"]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(15, 60))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(r.randint(0, 4)):
            kind = r.random()
            if kind < 0.4:
                p = r.choice(passages)
                a = r.randint(0, 10)
                words += p[a:len(p) - r.randint(0, 10)]
            elif kind < 0.5:
                words += [r.choice(vocabulary)] * r.randint(10, 50)
            elif kind < 0.6:
                words += r.choice(passages)[:3] * r.randint(5, 20)
            else:
                words += [r.choice(vocabulary) + str(r.randint(0, 99)) for _ in range(r.randint(1, 40))]
        rows.append((r.randint(-5, 1000) * 10 + i, r.choice([" ", "  ", "\n", "\t "]).join(words)))
    rows += [rows[3], rows[3], (rows[5][0], rows[6][1]), (None, rows[7][1]), (None, None), (7, ""), (8, " \n "), (9, None)]
    rows += [(5000, "loop " * 3000), (5001, "ab" * 400), (5002, "ab" * 300 + " tail")]
    r.shuffle(rows)
    return rows


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_words_equal_brute_force(docs, seed):
    rows = corpus(seed)
    found = span_dedup.dedup(docs(rows, extra=True).repartition(3), part_bytes=5000, bucket_bytes=9000)
    assert collected(found) == sorted(brute_words(rows), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_equal_brute_force(docs, seed):
    rows = corpus(seed)
    found = suffix_dedup.dedup(docs(rows, extra=True).repartition(3), part_bytes=5000, bucket_bytes=9000)
    assert collected(found) == sorted(brute_bytes(rows), key=str)


def test_kept_texts(docs):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(1, passage + " end"), (2, "start " + passage)]
    kept = {r["doc_id"]: r["kept"] for r in span_dedup.dedup(docs(rows), with_kept=True).collect()}
    assert kept == {1: rows[0][1], 2: "start"}
    kept = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.dedup(docs(rows), with_kept=True).collect()}
    assert kept == {1: rows[0][1].encode(), 2: b"start "}


def test_a_row_longer_than_a_chunk_is_cut_alike(docs, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 300)
    r = random.Random(5)
    long = " ".join(r.choice("abcdefgh") * r.randint(1, 3) for _ in range(900))
    rows = [(1, long), (2, "x " + long[100:]), (3, long[:700])]
    kind = repeats.Words(20, 8)
    import pyarrow as pa
    table = pa.table({"part": pa.array([0] * 3, pa.int32()), "doc_id": [1, 2, 3], "text": [t for _, t in rows]})
    part = repeats.Part(table, kind, True)
    assert max(c.runs.count.max() for c in part.chunks) <= 300
    assert sum(int(c.runs.count.sum()) for c in part.chunks) == sum(len(t.split()) - 19 for _, t in rows)


def test_empty_table(docs):
    assert span_dedup.dedup(docs([])).count() == 0
    assert suffix_dedup.dedup(docs([])).count() == 0


def test_equal_hashes_fall_back_to_the_text(monkeypatch):
    kind = repeats.Bytes(4, 2)
    contents = [b"abcdefgh", b"xxcdefyy"]
    right = repeats.first_windows(contents, kind)[0].tolist()
    monkeypatch.setattr(repeats.rolling, "mix", lambda h: h & np.uint64(1))
    assert repeats.first_windows(contents, kind)[0].tolist() == right


def test_loser_tree_merges_without_comparing_known_prefixes(monkeypatch):
    r = random.Random(3)
    pools = [sorted({bytes(r.choice(b"ab") for _ in range(r.randint(0, 12))) for _ in range(r.randint(0, 40))})
             for _ in range(7)]
    started = []

    def spied(a, b, at=0):
        assert a[:at] == b[:at]
        started.append(at)
        return repeats.common_prefix(a, b, at)

    monkeypatch.setattr(suffix_dedup, "common_prefix", spied)
    runs = [repeats.front_decoded(*repeats.front_coded(p)) for p in pools]
    got = list(suffix_dedup.merged(runs))
    assert [s for s, _, _ in got] == sorted(s for p in pools for s in p)
    for (a, _, _), (b, shared, _) in zip(got, got[1:]):
        assert shared == repeats.common_prefix(a, b)
    assert sum(started) > 0
