"""Centroid clustering against plain Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from casequarry.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, label int, v string, lead int, cluster int"


def brute(rows, k=3, rounds=10, size=4):
    kept = [(i, [math.floor(1024 * x) for x in e]) for i, e in rows
            if e is not None and len(e) == size and all(x is not None and math.isfinite(x) for x in e)]
    name = lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "z"
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def place():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        placed = place()
        for n in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, placed) if c == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    placed = place()
    each = {n: sum(d for d, c in placed if c == n) for n in range(len(centroids))}
    long = lambda x: x if x < 1 << 63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, long(d), long(each[c]), long(sum(each.values())), sha[c]) for (i, _), (d, c) in zip(kept, placed)), key=str)


def run(spark, rows, **more):
    table = spark.createDataFrame([(i, e, 1, "x", 2, 3) for i, e in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in clusters.cluster(table, **{"clusters": 3, "dimensions": 4, "lead": 2, **more}).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_same_as_plain_integers(spark, seed):
    r = random.Random(seed)
    rows = [(i, [r.gauss(r.choice((-1, 0, 2)), 0.3) for _ in range(4)]) for i in range(200)]
    rows += [(500 + i, [0.25, -0.5, 0.75, 1.0]) for i in range(100)]  # one common vector
    rows += [(7, [0.1, 0.2, 0.3, 0.4])] * 3 + [(None, [0.5] * 4), (901, None), (902, []), (903, [1.0] * 5), (904, [1.0, None, 1.0, 1.0]),
             (905, [1.0, math.nan, 1.0, 1.0]), (906, [1.0, math.inf, 1.0, 1.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, rounds=1) == brute(rows, rounds=1)


def test_ties_few_rows_and_huge_components(spark):
    grid = [(i, [float(x), float(y), 0.0, 0.0]) for i, (x, y) in enumerate((a, b) for a in (0, 1, 2) for b in (0, 1, 2))]
    assert run(spark, grid) == brute(grid)
    assert run(spark, grid[:2]) == brute(grid[:2])
    assert run(spark, []) == []
    big = grid + [(50, [1e200, -1e200, 3.0, 0.0]), (51, [2e6, -3e7, 1.0, 0.5]), (52, [-1e9, 0.0, 0.0, 1e-9])]
    assert run(spark, big) == brute(big)


def test_filter_leaves_most_pairs_out():
    r = np.random.default_rng(1)
    centres = r.normal(0, 1, (8, 64))
    v = np.floor(1024 * (centres[r.integers(0, 8, 2000)] + r.normal(0, 0.1, (2000, 64))))
    turn = clusters.Rotation(np.linalg.eigh(np.cov(v.T))[1].T[::-1].copy(), 16)
    model = clusters.Centroids([tuple(int(x) for x in np.floor(1024 * c)) for c in centres], turn)
    lead, rest = turn.stored(v)
    got, distance = model.nearest(v.astype(np.int64), lead, rest)
    every = ((v[:, None].astype(np.int64) - model.whole[None]) ** 2).sum(axis=2)
    assert (got == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert model.measured < 1.2 * len(v)  # of 8 per vector


def test_limbs():
    for x in (0, 1, -1, 1 << 31, -(1 << 31), (1 << 31) - 1, 1 << 200, -(1 << 200) + 5, 123456789012345678901234567890):
        parts = clusters._limbs(x)
        assert sum(p << 32 * k for k, p in enumerate(parts)) == x and all(abs(p) < 1 << 32 for p in parts)
