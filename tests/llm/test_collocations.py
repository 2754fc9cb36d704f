"""Phrase collocations against plain counters."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from casequarry.llm import collocations
from casequarry.llm.repeats import pack

SCHEMA = "doc_id long, text string, lang string, phrase string, n int, part int"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, support, top, longest=5):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(UP)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for (lang, p), a in f.items():
        if a < support or len(p) < 2:
            continue
        inside = any(g == lang and len(q) > len(p) and b >= support and b >= a and any(q[i:i + len(p)] == p for i in range(len(q)))
                     for (g, q), b in f.items())
        if not inside:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.append((lang, -score, -a, " ".join(p).encode(), l, r, n[lang]))
    rank, want = Counter(), []
    for lang, score, a, phrase, l, r, total in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            want.append((lang, rank[lang], phrase.decode(), -a, l, r, total, -score))
    return want


def run(spark, rows, support, top, **sizes):
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in collocations.mine(table, support=support, top=top, **sizes).collect())


def texts(seed):
    r = random.Random(seed)
    words = ["Alpha", "beta", "gamma", "DELTA", "été", "Été", "x-1", "日本"]
    text = lambda: "".join(r.choice(words) + r.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "; "]) for _ in range(r.randint(0, 60)))
    rows = [(i, text(), r.choice(["en", "en", "de", None, "und"])) for i in range(120)]
    rows += [(500 + i, "always the very same passage here, and more of it", "en") for i in range(60)]  # a hot text
    return rows + [(900, None, "en"), (901, "", "en"), (902, " .,\n", None), (None, "alpha beta gamma", "de"), *[(903, "beta beta beta beta", "en")] * 3,
                   (904, "beta gamma " * 3000, "en")]


@pytest.mark.parametrize("seed", (1, 2))
def test_same_as_counters(spark, seed):
    rows = texts(seed)
    got = run(spark, rows, 12, 25, part_bytes=3000, bucket_bytes=2000)
    assert got == sorted(brute(rows, 12, 25)) and len({g[0] for g in got}) >= 2
    assert got == run(spark, rows, 12, 25, shards=1)
    assert got == run(spark, rows, 12, 25, shards=50, part_bytes=1500)


def test_empty_table(spark):
    assert run(spark, [], 2, 5) == []
    assert run(spark, [(1, None, None)], 2, 5) == []


def test_local_supports_add_up_to_the_support():
    """A bucket by hand: what no shard has often enough is no candidate, the rest is added up over all shards."""
    h = np.array([1, 2, 3], np.uint64)
    row = lambda part, counts: (7, part, pack(h, np.zeros(3, np.uint32), np.array(counts, np.uint32)))
    rows = [row(0, [2, 5, 1]), row(1, [2, 1, 4]), row(2, [0, 9, 1])]  # parts 0 and 2 are shard 0
    table = pa.table({"bucket": pa.array([7] * 3, pa.int32()), "part": pa.array([0, 1, 2], pa.int32()), "body": pa.array([r[2] for r in rows], pa.binary())})
    from casequarry.llm.repeats import unpack
    got = {p: unpack(b, np.uint8, np.uint32, np.int64) for p, b in zip(*(collocations.answer(table, 10, [6, 4]).column(c).to_pylist() for c in ("part", "body")))}
    assert all(np.unpackbits(x[0], count=3).tolist() == [0, 1, 1] for x in got.values())
    assert got[0][1].tolist() == [1] and got[0][2].tolist() == [15] and not len(got[1][1]) and not len(got[2][1])


def test_equal_hashes_are_told_apart():
    order, new = collocations.grouped(np.array([5, 5, 5, 1], np.uint64), np.array([2, 1, 2, 9], np.uint32))
    assert new.sum() == 3 and sorted(order.tolist()) == [0, 1, 2, 3]
