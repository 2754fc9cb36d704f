"""Near copies of the pipeline against all pairs, with copies planted at 0.8 to 0.95."""

import random

import corpus_pipeline
from tests.llm.tables import docs  # noqa: F401


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    return a == b or 9 * len(a & b) >= 4 * (len(a) + len(b)) and bool(a)


def brute_kept(rows):
    """(doc_id, text) of the smallest id of each class."""
    sets, root = [grams(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                root[find(i)] = find(j)
    out = {}
    for i, (d, t) in enumerate(rows):
        best = out.setdefault(find(i), (d, t))
        if (d is None, d or 0) < (best[0] is None, best[0] or 0):
            out[find(i)] = (d, t)
    return out.values()


def planted():
    r = random.Random(11)
    word = lambda: f"w{r.randrange(5000)}"
    passage = [word() for _ in range(60)]
    rows, pairs = [], 0
    for i in range(40):
        base = [word() for _ in range(150)] + passage
        rows.append((1000 + i, " ".join(base)))
        first = grams(rows[-1][1])
        for edits in (1, 2, 3, 4, 5, 6):
            copy = list(base)
            for k in r.sample(range(150), edits):
                copy[k] = word()
            here = grams(" ".join(copy))
            pairs += 0.8 <= len(here & first) / len(here | first) <= 0.95
            rows.append((2000 + 10 * i + edits, " ".join(copy).title()))
    hot = [word() for _ in range(100)]
    for i in range(60):
        copy = list(hot)
        copy[r.randrange(100)] = word()
        rows.append((5000 + i, " ".join(copy)))
    rows += [(1, ""), (2, None), (3, "  "), (4, "one two"), (5, "ONE two"), (6, "one two three"), (None, "no id here"), (None, "NO id here")]
    return rows, pairs


def test_copies_planted_at_08_to_095_are_one_class(spark, docs):
    rows, pairs = planted()
    assert pairs > 100
    table = docs(rows, extra=True)
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, table, "")
    assert out.columns == table.columns
    got = sorted(str(x["doc_id"]) for x in out.collect())
    assert got == sorted(str(d) for d, _ in brute_kept(rows))


def test_ids_repeated_with_other_texts(spark, docs):
    a, b = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = [(x["doc_id"], x["text"]) for x in stage(spark, docs([(1, a), (1, b), (1, b), (2, a + " z")]), "").collect()]
    assert sorted(kept) == [(1, a), (1, b)]
    assert stage(spark, docs([]), "").count() == 0


def test_ties_clashing_names_and_long_texts(spark):
    """Rows equal in id and text differ in other columns: one stays, always the same; any names pass through."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long, k, "x", 0.5) for k in range(4)] + [(2, long + " end", 9, "y", 0.5), (3, None, 1, "z", 0.5), (4, "", 2, "z", 0.5)]
    table = spark.createDataFrame(rows, "doc_id long, text string, __h int, __r string, row double")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    got = [sorted(map(str, stage(spark, table.repartition(n), "").collect())) for n in (1, 3)]
    assert got[0] == got[1] and len(got[0]) == 2 and stage(spark, table, "").columns == table.columns


def test_crowded_values_are_split(spark, docs, monkeypatch):
    from casequarry.llm import near_copies
    rows, _ = planted()
    for name, value in (("CROWD", 8), ("FIRST", 1), ("SAMPLE", 20)):
        monkeypatch.setattr(near_copies, name, value)
    got = sorted(str(x["doc_id"]) for x in near_copies.keep_one(docs(rows)).collect())
    assert got == sorted(str(d) for d, _ in brute_kept(rows))


def test_first_links_come_from_fingerprints_that_meet(spark, docs):
    """Planted copies are found by balls in blocks of their fingerprints, far beyond the two bits of op7, as by brute force."""
    import numpy as np
    from casequarry.llm import near_copies, simhash
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)]
    prints = {10 * i: b for i, b in enumerate(base)}
    for i, b in enumerate(base):
        for k in range(1, 9):
            prints[10 * i + k] = b ^ sum(1 << bit for bit in r.sample(range(64), k))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    table = spark.createDataFrame([(k, signed(p)) for k, p in prints.items()], "key long, fp long")
    got = {tuple(x) for x in simhash.near_blocks(table, "key", 8, 3).collect()}
    far = lambda a, b: bin(prints[a] ^ prints[b]).count("1")
    assert all(a < b and far(a, b) <= 8 for a, b in got) and {a // 10 for a, _ in got} == set(range(40))
    assert sum(2 < far(a, b) for a, b in got) > 150

    rows, _ = planted()
    table = docs([x for x in rows if x[0] is not None])
    found = near_copies.prefixed(table, near_copies.common_values(table)).cache()
    keys = {x["key"]: grams(dict(rows)[x["doc_id"]]) for x in found.collect()}
    pairs = [(keys[a], keys[b]) for a, b in near_copies.near_prints(found, found).collect()]
    assert sum(alike(a, b) for a, b in pairs) > 100
    x = near_copies.values(rows[0][1].encode())
    fp = next(v["fp"] for v in found.collect() if v["doc_id"] == rows[0][0])
    assert np.uint64(fp & (1 << 64) - 1) == simhash.majority(x, np.array([len(x)]))[0]


def test_common_values_count_each_set_once(spark, docs):
    from collections import Counter
    import numpy as np
    from casequarry.llm import near_copies
    rows, _ = planted()
    rows = rows + [(i + 100_000, t) for i, t in rows if i] + [(200_000, None)]
    sets = {near_copies.key_of(v): v for v in (near_copies.values((t or "").encode()) for _, t in rows)}
    want = Counter(int(x) >> 32 for v in sets.values() for x in v)
    names, counts = near_copies.common_values(docs(rows).repartition(5))
    assert dict(zip(names.tolist(), counts.tolist())) == {k: n for k, n in want.items() if n >= near_copies.COMMON}
    assert (np.diff(names.astype(np.int64)) > 0).all() and len(near_copies.common_values(docs([]))[0]) == 0


def test_values_of_few_sets_are_settled_at_once(spark, docs, monkeypatch):
    """All pairs of sets that share a value of few are compared in the first round; only crowded values go on."""
    from collections import Counter
    from itertools import combinations
    from casequarry.llm import near_copies
    rows, _ = planted()
    later = []
    step = near_copies.named
    monkeypatch.setattr(near_copies, "named", lambda rows, edges: (later.append(rows.collect()) if edges else None) or step(rows, edges))
    table = docs(rows)
    got = sorted(str(x["doc_id"]) for x in near_copies.keep_one(table).collect())
    assert got == sorted(str(d) for d, _ in brute_kept(rows))
    assert later and later[0] and all(n > near_copies.PAIRED for left in later for n in Counter(x["value"] for x in left).values())

    shared = spark.createDataFrame([(v, 10 * v + k, 50, 0) for v, n in ((1, 2), (2, 8), (3, 9)) for k in range(n)] + [(4, 1, 50, 0), (4, 2, 500, 0)],
                                   "value long, key long, n long, at long")
    few, many = near_copies.crowded(shared)
    assert {x["value"] for x in many.collect()} == {3} and few.count() == 12
    # Sizes of 50 and 500 cannot be alike; nor can sets whose first shared value is that late.
    assert {tuple(x) for x in near_copies.paired(few).collect()} == {(10, 11), *combinations(range(20, 28), 2)}


def test_copies_leave_a_task_with_one_body(spark, docs):
    from casequarry.llm import near_copies
    text = " ".join(f"w{i}" for i in range(60))
    table = docs([(i, text) for i in range(90)] + [(100, text + " more"), (101, text + " more words")]).coalesce(1)
    found = near_copies.prefixed(table, near_copies.common_values(table)).cache()
    assert found.count() == 92 and found.where("body is not null").count() == 3 and found.where("n is null or fp is null").count() == 0
    shared = near_copies.shared_values(found).collect()
    assert max(sum(1 for y in shared if y["value"] == x["value"]) for x in shared) == 3  # each set once
    assert [x["doc_id"] for x in near_copies.keep_one(table).collect()] == [0]


def test_what_the_sample_says_changes_no_row(spark, docs, monkeypatch):
    """Sampled values only order prefixes: no values, few of them, all of them and wrong counts keep the rows that all pairs keep."""
    import numpy as np
    from casequarry.llm import near_copies
    rows, _ = planted()
    table = docs(rows)
    want = sorted(str(d) for d, _ in brute_kept(rows))
    names, counts = near_copies.common_values(table)
    none = (names[:0], counts[:0])
    wrong = np.random.default_rng(2).permutation(counts)
    for common in (none, (names[::9], counts[::9]), (names, counts.max() - counts), (names, wrong)):
        monkeypatch.setattr(near_copies, "common_values", lambda docs, common=common: common)
        assert sorted(str(x["doc_id"]) for x in near_copies.keep_one(table).collect()) == want
