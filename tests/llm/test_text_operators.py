"""Decontamination, SimHash, Order MinHash, personal data and quality against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from casequarry.llm import components, decontaminate, order_minhash, quality, sanitise, simhash
from tests.llm.tables import docs  # noqa: F401

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


# Decontamination

def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute_hits(rows, items, window=10):
    grams = {}
    for item, text in items:
        w = plain_words(text)
        n = min(window, len(w))
        if n and item is not None:
            for k in range(len(w) - n + 1):
                grams.setdefault(tuple(w[k:k + n]), set()).add(str(item))
    out = []
    for i, text in rows:
        w, hit, met = plain_words(text), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                found = grams.get(tuple(w[k:k + n]))
                if found:
                    hit.update(range(k, k + n))
                    met |= found
        out.append((i, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return out


ITEMS = [(1, "Alpha beta gamma, delta; epsilon zeta eta theta iota kappa lambda MU"), (10, "rare-item Tokyo"), (2, None),
         (3, ""), (4, "rare item tokyo"), (None, "nobody knows this"), (1, "one more text of the first item, quite long enough to be cut"),
         (5, "été Été ÉTÉ")]
TEXTS = [(1, "x ALPHA beta gamma delta epsilon zeta eta theta iota kappa lambda mu y"), (2, "alpha beta gamma delta epsilon zeta eta theta iota"),
         (3, "Rare item: tokyo! rare item tokyo"), (4, None), (5, ""), (None, "a rare item  tokyo"), (1, "a rare item  tokyo"),
         (1, "a rare item  tokyo"), (6, "!!! ..."), (7, "word " * 50_000 + "rare item tokyo"), (8, "ÉTÉ ÉTÉ ÉTÉ"), (9, "nobody knows this")]


@pytest.mark.parametrize("block", [16_000_000, 300])
def test_hits_equal_brute_force(spark, docs, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert len(decontaminate._blocks(bench, 10, block)) == 1 if block > 300 else len(decontaminate._blocks(bench, 10, block)) > 3
    found = decontaminate.scan(docs(TEXTS, extra=True), bench, block_bytes=block)
    assert collected(found) == sorted(brute_hits(TEXTS, ITEMS), key=str)


@pytest.mark.parametrize("block", [16_000_000, 300])
def test_clean_cuts_hit_words_only(spark, docs, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    table = docs(TEXTS, extra=True)
    out = decontaminate.clean(table, bench, block_bytes=block)
    assert out.columns == table.columns
    texts = [r["text"] for r in out.collect()]
    assert texts[0] == "x  y" and texts[1] == TEXTS[1][1] and texts[3] is None and texts[5] == "a "
    assert texts[9] == "word " * 50_000


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.scan(docs([]), bench).count() == 0
    assert [r["n_hit"] for r in decontaminate.scan(docs([(1, "a b")]), bench).collect()] == [0]


# SimHash

def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    shingles = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_classes(rows):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return [(d, np.uint64(p).astype(np.int64).item(), least[find(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints))]


def near_corpus():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 4)))
    base = [[word() for _ in range(400)] for _ in range(5)]
    rows = []
    for i in range(70):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 5])):
            w[r.randrange(len(w))] = word()
        rows.append((1000 - i, r.choice([" ", "\t", "\n\n"]).join(w)))
    return rows + [(3, ""), (2, None), (5, "  "), (7, "one"), (8, "ONE"), (9, "one two"), (None, "solo text here"),
                   (None, rows[0][1]), rows[1], rows[1], (11, "big " * 5000)]


def test_classes_equal_brute_force(docs):
    rows = near_corpus()
    want = brute_classes(rows)
    assert len({c for _, _, c in want}) < len(rows) - 40
    assert collected(simhash.classes(docs(rows, extra=True))) == sorted(want, key=str)


def test_keep_one_per_class(docs):
    rows = near_corpus()
    table = docs(rows, extra=True)
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    want = {c for _, _, c in brute_classes(rows) if c is not None}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert simhash.classes(docs([])).count() == 0 and simhash.keep_one(docs([])).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (200, 7)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(200, 260)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Order MinHash

def test_next_and_edited_equal_brute_force(docs):
    r = random.Random(6)
    rows = [(r.randint(0, 200), " ".join(r.choice(["aa", "b", "日本", "ccc", "é"]) for _ in range(r.randint(0, 60)))) for _ in range(80)]
    rows += [(None, "null id"), (900, None), (901, ""), (902, "one"), rows[0], rows[0], (903, "y" * 40_000)]
    key = lambda x: (x[0] is None, -(x[0] or 0))
    for parts in (1, 3, 50):
        got = order_minhash.compare_with_next(docs(rows, extra=True).repartition(4), parts=parts).collect()
        assert len(got) == len(rows)
        by_id = {}
        for i, t in rows:
            by_id.setdefault(i, []).append(t or "")
        # Where ids are single the next document is known; others are ordered by a hash of the text.
        ids = sorted(by_id, key=lambda i: key((i, None)))
        follow = {i: by_id[ids[(k + 1) % len(ids)]] for k, i in enumerate(ids)}
        for x in got:
            if len(by_id[x["doc_id"]]) == 1:
                text = by_id[x["doc_id"]][0]
                options = {order_minhash.edited(text, n): n for n in follow[x["doc_id"]]}
                digests = {hashlib.sha256(e.encode()).hexdigest(): e for e in options}
                assert x["n_chars"] == len(text) and x["edited_sha256"] in digests
                new = digests[x["edited_sha256"]]
                prints = order_minhash.fingerprints([text.encode(), new.encode(), options[new].encode()])
                assert x["fingerprint"] == prints[0].astype(">u4").tobytes().hex()
                assert x["edited_fingerprint"] == prints[1].astype(">u4").tobytes().hex()
                assert x["near_edited"] == float((prints[0] == prints[1]).mean())
                assert x["near_next"] == float((prints[0] == prints[2]).mean())


def test_one_document_and_none(docs):
    only, = order_minhash.compare_with_next(docs([(1, "abcd efgh")])).collect()
    assert only["near_next"] == 1.0 and only["edited_sha256"] == hashlib.sha256(b"abcd abcd").hexdigest()
    assert order_minhash.compare_with_next(docs([])).count() == 0


def test_signature_follows_the_definition():
    texts = [b"a b c a b c a b d", b"", b"one", b"x y", b"q w e r t y u i o p a s d f g h j k l" * 3]
    got = order_minhash.fingerprints(texts)
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    elements, counts = order_minhash._elements(data, offsets, order_minhash.K)
    assert counts.tolist() == [8, 0, 1, 1, 18 * 3 + 0 + (len(texts[4].split()) - 1 - 54)]
    begin = np.cumsum(counts) - counts
    for t in range(len(texts)):
        mine = elements[begin[t]:begin[t] + counts[t]]
        assert len(set(mine.tolist())) == len(mine)
        for j in range(order_minhash.M):
            if not len(mine):
                assert got[t, j] == 0
                continue
            value = order_minhash.rolling.mix(mine ^ order_minhash._SEEDS[j])
            chosen = sorted(np.argsort(value)[:order_minhash.PICKED].tolist())
            h = np.full(1, j + 1, np.uint64)
            for k in range(order_minhash.PICKED):
                known = mine[chosen[k]] if k < len(chosen) else np.uint64(0)
                h = order_minhash.rolling.mix(h * np.uint64(0x9E3779B97F4A7C15) + known)
            assert got[t, j] == h[0] >> np.uint64(32)


def test_order_matters():
    words = [f"w{i}" for i in range(200)]
    swapped = words[100:] + words[:100]
    changed = words[:190] + ["z"] * 10
    a, b, c = order_minhash.fingerprints([" ".join(w).encode() for w in (words, swapped, changed)], m=200)
    assert (a == c).mean() > 0.75 > 0.65 > (a == b).mean()


# Personal data

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 16 <= len(digits) <= 19 and sanitise.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    r = random.Random(8)
    alphabet = list("a.@-1 2+()0%é,") + ["4111111111111111", "10.0.0.1", "x@y.z", "+49 30 1234567"]
    for _ in range(20_000):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 25)))
        assert sanitise.base_spans(text) == brute_spans(text), text


def test_no_quadratic_time_on_long_runs():
    for text in ("1" * 300_000, "a" * 300_000 + " @ x@y", "1." * 100_000, "a@" * 100_000, "+1" + " " * 200_000, "a@b." * 50_000):
        sanitise.base_spans(text)


def test_terms_that_reveal_an_entity_go(docs):
    r = random.Random(9)
    common = [f"c{i}" for i in range(50)]
    filler = lambda n=30: " ".join(r.choice(common) for _ in range(n))
    secret = "codename Falconry owner ann@corp.example"
    rows = [(i, f"{filler()} {secret} {filler()}") for i in range(4)]
    rows += [(10 + i, filler()) for i in range(300)] + [(400, "Falconry is a sport " + filler()), (500, None), (501, "")]
    rows += [(600 + i, f"owner of things {filler()}") for i in range(60)]
    found = {x["doc_id"]: x for x in sanitise.scan(docs(rows, extra=True)).collect()}
    text = rows[0][1]
    at = text.index("Falconry")
    spans = found[0]["spans"].split(",")
    assert spans[0].startswith("email:") and f"term:{at}:{at + 8}" in spans
    assert not any(s == f"term:{text.index('owner')}:{text.index('owner') + 5}" for s in spans)
    assert found[0]["n_email"] == 1 and found[400]["spans"] == "" and found[500]["spans"] == "" and found[501]["n_term"] == 0
    assert found[0]["base_sha256"] == hashlib.sha256(spans[0].encode()).hexdigest()
    table = docs(rows, extra=True)
    clean = sanitise.clean(table)
    assert clean.columns == table.columns
    texts = {x["doc_id"]: x["text"] for x in clean.collect()}
    assert "Falconry" not in texts[0] and "ann@" not in texts[0] and "owner [EMAIL]" in texts[0]
    assert texts[400] == rows[304][1] and texts[500] is None and texts[501] == ""


def test_repeated_rows_and_null_ids(docs):
    rows = [(1, "mail a@b.co now"), (1, "mail a@b.co now"), (None, "mail a@b.co now"), (2, None), (1, "other 1.2.3.4")]
    got = sanitise.scan(docs(rows)).collect()
    assert len(got) == len(rows) and sum(x["n_email"] for x in got) == 3 and sum(x["n_ip"] for x in got) == 1
    assert sanitise.clean(docs(rows)).count() == len(rows)
    assert sanitise.scan(docs([])).count() == 0 and sanitise.clean(docs([])).count() == 0


# Quality

def test_gradients_equal_differences():
    net = quality.Network(seed=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts, labels = [b"some text " * 40, b"A!! B!! C!!", b"x | y | z " * 20], np.array([1.0, 0.0, 0.0])

    def loss():
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        s = net.scores(np.frombuffer(b"".join(texts), np.uint8), offsets)
        return -(labels * np.log(s) + (1 - labels) * np.log(1 - s)).mean()

    g = net.gradients(texts, labels)
    for name, at in (("out", 3), ("dense", (2, 5)), ("dense_bias", 4), ("bias", 1), ("taps", (2, 32, 4)), ("out_bias", 0)):
        before = net.p[name][at]
        net.p[name][at] = before + 1e-5
        up = loss()
        net.p[name][at] = before - 1e-5
        down = loss()
        net.p[name][at] = before
        assert abs((up - down) / 2e-5 - g[name][at]) < 1e-4, name


def test_scores_do_not_depend_on_neighbours_or_chunks():
    net = quality.Network()
    texts = [b"", b"short", b"long text " * 500, b"\xff\x00" * 200, b""]
    one = [net.scores(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    together = net.scores(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    assert np.allclose(one, together)
    tail = texts[2] + b"#### $$$$ %%%%"
    assert not np.allclose(one[2], net.scores(np.frombuffer(tail, np.uint8), np.array([0, len(tail)]))[0], atol=1e-9)


def test_held_out_accuracy(spark, docs):
    folder = "/root/testdata/sf0.01"
    table, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(table, quality.train(table, labels, sample=600)).join(labels, "doc_id").collect()
    held = [x for x in scored if x["held_out"]]
    assert all(x["held_out"] == (__import__("zlib").crc32(str(x["doc_id"]).encode()) % 5 == 0) for x in scored)
    assert len(held) > 50 and sum(x["predicted"] == x["quality"] for x in held) / len(held) > 0.9


def test_edge_rows(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    rows = [(1, "text"), (2, None), (3, ""), (None, "x"), (1, "text"), (4, "long " * 40_000)]
    net = quality.train(docs(rows), labels)
    assert net.constant in (1.0, 0.5)
    got = quality.score(docs(rows, extra=True), quality.Network()).collect()
    assert len(got) == 6 and all(0 <= x["score"] <= 1 for x in got)
    assert [x["held_out"] for x in got if x["doc_id"] is None] == [False]
    assert quality.score(docs([]), net).count() == 0
    table = docs(rows, extra=True)
    assert quality.keep_good(table, quality.Network(), threshold=0.0).collect() == table.collect()


def test_keep_good_follows_the_score(docs):
    rows = [(i, "word " * i) for i in range(50)]
    net = quality.Network()
    scores = {x["doc_id"]: x["score"] for x in quality.score(docs(rows), net).collect()}
    cut = sorted(scores.values())[25]
    kept = {x["doc_id"] for x in quality.keep_good(docs(rows), net, threshold=cut).collect()}
    assert kept == {i for i, s in scores.items() if s >= cut}
    assert F is not None
