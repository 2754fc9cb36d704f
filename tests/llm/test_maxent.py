"""Language model: exact counts against plain Python, a proper distribution, and held-out texts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from casequarry.llm import maxent, rolling

SCHEMA = "doc_id long, text string, held_out string, part int, score string"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP)), "\n"]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def corpus(seed=1, docs=300):
    r = random.Random(seed)
    verbs = {f"noun{i}": [f"verb{i}x{j}" for j in range(3)] for i in range(12)}
    text = lambda: " ".join(f"The {n} {r.choice(v)} été{r.randrange(200)}" for n, v in r.choices(list(verbs.items()), k=r.randint(1, 40)))
    rows = [(i, text()) for i in range(docs)]
    return rows + [(1000, None), (1001, ""), (1002, " \t\n"), (None, "the null id"), (None, None), *[(7, "again again")] * 3, (1003, "the noun1 " * 4000)]


def run(spark, rows, **more):
    table = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)
    return maxent.score(table, **more).collect()


def test_counts_and_base_are_exact(spark):
    rows = corpus()
    c = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    want = Counter()
    base = {}
    for i, text in rows:
        t = tokens(text)
        key = (i, held(i), len(t), sum(c[x] > 0 for x in t), n)
        want[key] += 1
        base[key] = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t)
    got = run(spark, rows, part_bytes=3000, bucket_bytes=1000)
    assert Counter(tuple(x)[:5] for x in got) == want
    for x in got:
        if x["doc_id"] != 7 and x["doc_id"] is not None:
            assert x["base_score"] == pytest.approx(base[tuple(x)[:5]], rel=1e-9)
        assert x["score"] < 0 and math.isfinite(x["score"])
    out = [x for x in got if x["held_out"] and x["n_tokens"] > 20]
    assert sum(x["score"] for x in out) > sum(x["base_score"] for x in out) + 0.3 * sum(x["n_tokens"] for x in out)
    again = [x["score"] for x in got if x["doc_id"] == 7 and x["n_tokens"] == 3]
    assert len(again) == 3 and max(again) - min(again) < 1e-5  # equal texts score alike


def test_words_sum_to_one():
    """For any history: known words and one unknown of each class together have probability one."""
    r = np.random.default_rng(4)
    words = r.integers(1, 1 << 63, 3000, dtype=np.uint64)
    n = (r.pareto(1.0, 3000) * 3 + 1).astype(np.int64)
    rest = np.zeros((maxent.CLASSES, 2))
    np.add.at(rest, maxent._group_of(words), np.stack([n, np.ones_like(n)], axis=1).astype(float))
    counts = maxent.Counts(int(n.sum()), len(n), rest=rest)
    best = np.argsort(-n)[:maxent.CLASSES * maxent.SLOTS]
    np.subtract.at(rest, maxent._group_of(words[best]), np.stack([n[best], np.ones(len(best))], axis=1))
    rank = np.arange(len(best))
    place = rank % maxent.CLASSES * maxent.SLOTS + rank // maxent.CLASSES
    counts.own.ravel()[place] = n[best]
    order = np.argsort(words[best])
    counts.top, counts.place = words[best][order], place[order]
    model = maxent.Model(counts, r.normal(0, 1, (maxent.ROWS_1, maxent.CLASSES)).astype(np.float32),
                         r.normal(0, 1, (maxent.ROWS_2, maxent.SLOTS + 1)).astype(np.float32))
    group, slot = counts.slots(words)
    share = rest.sum(axis=1) + 1
    for history in rolling.mix(r.integers(1, 1 << 63, (3, maxent.FEATURES), dtype=np.uint64)):
        p = 10 ** model.log10(np.repeat(history[:, None], len(words), 1), group, slot)
        p *= np.where(slot == maxent.SLOTS, (n + 1) / share[group], 1)
        g = np.arange(maxent.CLASSES)
        unknown = 10 ** model.log10(np.repeat(history[:, None], len(g), 1), g, np.full(len(g), maxent.SLOTS)) / share
        assert p.sum() + unknown.sum() == pytest.approx(1, abs=1e-4)


def test_a_step_follows_the_gradient():
    r = np.random.default_rng(2)
    counts = maxent.Counts(rest=np.full((maxent.CLASSES, 2), 5.0), own=np.full((maxent.CLASSES, maxent.SLOTS), 3.0))
    values = rolling.mix(r.integers(1, 1 << 63, (maxent.FEATURES, 1), dtype=np.uint64)).repeat(500, axis=1)
    group, slot = r.choice([3, 3, 3, 9], 500), r.choice([1, 1, 4], 500)
    learner = maxent.Learner(maxent.Model(counts))
    before = learner.log10(values, group, slot).mean()
    for _ in range(20):
        learner.step(values, group, slot)
    assert learner.log10(values, group, slot).mean() > before + 1.5
    assert {b for b, _ in learner.changes()} and learner.begin[0].any() == False  # noqa: E712


def test_histories_stay_inside_a_text():
    t = maxent.Tokens(np.frombuffer(b"a b cX d", np.uint8), np.array([0, 5, 5, 8]))
    assert t.sizes.tolist() == [4, 1, 3]
    one, three = t.back(1), t.back(3)
    assert [one[i] == t.h[i - 1] for i in (1, 2, 3, 6, 7)] == [True] * 5 and one[0] == one[4] == one[5]
    assert three[3] == t.h[0] and three[2] != t.h[0] and three[7] < 4 and three[5] == three[4]


def test_empty_tables(spark):
    assert run(spark, []) == []
    only = [i for i in range(100) if held(i)][:3]
    got = run(spark, [(i, "a b") for i in only])
    assert all(x["n_known"] == 0 and x["train_tokens"] == 0 and x["base_score"] == 0 for x in got) and len(got) == 3


def test_rare_words_follow_their_history(spark):
    """A word beyond the commonest has a probability given the word before, not only its count's share."""
    r = random.Random(5)
    common = [f"c{i}" for i in range(maxent.CLASSES * maxent.SLOTS)]
    h = maxent.Tokens(np.frombuffer(" ".join(f"b{i}" for i in range(3000)).encode(), np.uint8), np.array([0, sum(len(f"b{i}") + 1 for i in range(3000)) - 1])).h[:-1]
    pairs = [(f"a{i}", f"b{k}") for i, k in enumerate(np.flatnonzero(maxent._group_of(h) == 7)[:40])]  # of one class

    def text():
        words = r.choices(common, k=900)
        for a, b in r.choices(pairs, k=40):
            words += [a, b, f"z{r.randrange(99999)}"]
        return " ".join(words)

    train = [(i, text()) for i in range(300) if not held(i)]
    ids = [i for i in range(1000, 2000) if held(i)][:40]
    rows = [*train, *((i, f"{a} {b}") for i, (a, b) in zip(ids[:20], pairs)), *((i, f"{a} {b}") for i, (a, _), (_, b) in zip(ids[20:], pairs, pairs[20:]))]
    got = {x["doc_id"]: x["score"] for x in run(spark, rows)}
    assert np.mean([got[i] for i in ids[:20]]) > np.mean([got[i] for i in ids[20:]]) + 0.3


def test_the_tree_sums_to_one():
    """Of one class and history: the leaves' probabilities add up to one, and begin with the share of their counts."""
    r = np.random.default_rng(3)
    counts = maxent.Counts(leaves=r.integers(1, 90, (maxent.CLASSES, 32)).astype(float))
    leaf, group = np.arange(32), np.full(32, 5)
    values = np.repeat(rolling.mix(r.integers(1, 1 << 63, (maxent.FEATURES, 1), dtype=np.uint64)), 32, 1)
    flat = maxent.Model(counts).inside(values, group, leaf)
    assert 10 ** flat == pytest.approx(counts.leaves[5] / counts.leaves[5].sum(), rel=1e-4)
    model = maxent.Model(counts, third=r.normal(0, 1, (maxent.NODES, 1)).astype(np.float32))
    p = 10 ** model.inside(values, group, leaf)
    assert p.sum() == pytest.approx(1, abs=1e-5) and not p == pytest.approx(10 ** flat, rel=0.1)


def test_added_errors_of_rows():
    r = np.random.default_rng(6)
    rows, error = r.zipf(1.3, 600).astype(np.int32) % 200, r.normal(size=(200, 3)).astype(np.float32)
    want = np.zeros((200, 3))
    np.add.at(want, rows, np.tile(error, (3, 1)))
    names, uses, total = maxent._summed_rows(rows, error)
    assert dict(zip(names.tolist(), uses.tolist())) == Counter(rows.tolist())
    assert total == pytest.approx(want[names], abs=1e-4)
