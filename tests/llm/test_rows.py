"""URL filter, chat formatting, packing, and the pipeline."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from casequarry.llm import chat, packing, urls
from tests.llm.tables import docs  # noqa: F401

tokenizers = pytest.importorskip("tokenizers")


# URL filter

def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    cut = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    tail = rest[cut:]
    end = min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])
    return rest[:cut].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), tail[:end]


def brute_rule(host, path):
    best = None
    for kind, h, p in urls.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[1])):
            best = (kind, h + p)
    return best


def brute_rank(links, seeds, rounds=urls.ROUNDS, damping=urls.DAMPING):
    out = defaultdict(float)
    for (a, _), n in links.items():
        out[a] += n
    score = dict(seeds)
    for _ in range(rounds):
        new = defaultdict(float)
        for h, s in seeds.items():
            new[h] += s * (1 - damping)
        for (a, b), n in links.items():
            new[b] += damping * score.get(a, 0) * n / out[a]
        score = new
    return score


URLS = ["http://Example.NET/en/a?x#y", "https://sub.example.net/EN/", "ftp://example.com/de/x", "http://a.org/fr/1", "http://org/fr/",
        "http://evil.net", "http://net/", "example.net/en/", None, "", "http://", "http://h?q/en/", "x://é.NET/#", "http://notexample.com/de/",
        "http://a://b/c", "http://x.com/\n?"]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "h", "v") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string, verdict string")
    for r in urls.judge(pages).collect():
        host, path = brute_url(URLS[r["page_id"]])
        rule = brute_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[1])
        assert r["verdict"] == (rule[0] if rule else "allow")


def test_distrust_spreads_against_links_and_trust_along(spark):
    r = random.Random(3)
    hosts = ["good.org", "bad.net", *(f"h{i}.com" for i in range(8))]
    rows, links, seeds = [], defaultdict(int), {"allow": defaultdict(float), "block": defaultdict(float)}
    for i in range(60):
        host = r.choice(hosts)
        targets = [r.choice(hosts) for _ in range(r.randint(0, 3))]
        url = f"http://{host}/fr/{i}"
        rows.append((i, url, " ".join(f"<a href='https://{t.upper()}/q'>x</a>" for t in targets) + '<a href="/local">'))
        rule = brute_rule(*brute_url(url))
        if rule:
            seeds[rule[0]][host] += 1
        for t in targets:
            if t != host:
                links[host, t] += 1
    for kind, s in seeds.items():
        total = sum(s.values())
        seeds[kind] = {h: n / total for h, n in s.items()}
    trust = brute_rank(links, seeds["allow"])
    distrust = brute_rank({(b, a): n for (a, b), n in links.items()}, seeds["block"])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    verdicts = set()
    for x in urls.judge(pages).collect():
        assert abs(x["trust"] - trust.get(x["host"], 0)) < 1e-9 and abs(x["distrust"] - distrust.get(x["host"], 0)) < 1e-9
        if x["rule"] is None:
            assert x["verdict"] == ("block" if distrust.get(x["host"], 0) > trust.get(x["host"], 0) + 1e-9 else "allow")
            verdicts.add(x["verdict"])
    assert verdicts == {"allow", "block"}


def test_no_pages(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# Chat

def test_round_trip_and_loss(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "&lt;|", "&amp;", "<|", "a & b", "", None, "line\nend<|im_end|>\n", "&lt;|im_start|>", "é日本", "\\Q<|\\E"]
    roles = ["user", "assistant", "we\nird<|", None, "system"]
    r = random.Random(2)
    rows = [(c, t, r.choice(roles), r.choice(nasty), "x") for c in range(30) for t in range(r.randint(1, 6))]
    rows += [(None, 1, "user", "n", "x"), (None, None, "assistant", "m", "x"), rows[0], rows[0], (99, 0, "user", "long " * 50_000, "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string")
    done = chat.formatted(table)
    got = {x["conv_id"]: x for x in done.withColumn("back", chat.read_back(done["text"])).collect()}
    none_first = lambda v: (v is not None, v or 0)
    for conv in {x[0] for x in rows}:
        mine = sorted(((none_first(t), ro or "", te or "") for c, t, ro, te, _ in rows if c == conv))
        assert [(b["role"], b["text"]) for b in got[conv]["back"]] == [(ro, te) for _, ro, te in mine]
        learnt = "".join(s["text"] for s in got[conv]["segments"] if s["loss"])
        assert learnt == "".join(te.replace("&", "&amp;").replace("<|", "&lt;|") for _, ro, te in mine if ro == "assistant")


def test_machine(spark):
    turns = {1: ["user", "assistant"], 2: ["system", "user", "assistant", "user", "assistant"], 3: ["assistant", "user"], 4: ["user", "user", "assistant"],
             5: ["user"], 6: ["user", "assistant", "tool", "assistant"], 7: ["user", "robot"], 8: [None]}
    rows = [(c, i, role, "t") for c, rs in turns.items() for i, role in enumerate(rs)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {x["conv_id"]: x["valid"] for x in chat.formatted(table).collect()} == {
        1: True, 2: True, 3: False, 4: False, 5: False, 6: True, 7: False, 8: False}
    steps = {(x["conv_id"], x["turn"]): x["allowed"] for x in chat.segments(table).collect()}
    assert not steps[4, 1] and steps[4, 2] and not steps[3, 0] and steps[6, 3]
    assert chat.formatted(table.limit(0)).count() == 0 and chat.segments(table.limit(0)).count() == 0


# Packing

def path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_pieces_equal_the_tokenizer(docs):
    plain = tokenizers.Tokenizer.from_file(path())
    r = random.Random(1)
    letters = ["a", "Z", "é", "É", "e\u0301", "Σ", "日", "1", ".", "'s", "<|endoftext|>", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\x1f", "\x85", "İ", "ß", "´"]
    rows = [(i, "".join(r.choice(letters) for _ in range(r.randint(0, 40)))) for i in range(300)]
    rows += [(500, None), (501, ""), (None, "hello world"), rows[0], (502, "lorem ipsum " * 3000)]
    got = defaultdict(list)
    for x in packing.pack(docs(rows, extra=True).repartition(3), path(), group=100).collect():
        got[x["doc_id"]].append(x)
    for i, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        want = [(k, a, len(ids[a:a + 2048]), zlib.crc32(np.array(ids[a:a + 2048], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
        mine = sorted((x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in got[i])
        assert mine == sorted(want * (2 if i == rows[0][0] else 1)), text
    fills = defaultdict(list)
    for xs in got.values():
        for x in xs:
            fills[x["sequence_id"]].append((x["offset"], x["length"]))
    for spans in fills.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048


def test_search_empties_bins_and_keeps_items():
    r = random.Random(5)
    for _ in range(200):
        lengths = [r.choice([r.randint(1, 100), r.randint(20, 60), 34, 51]) for _ in range(r.randint(0, 40))]
        first = packing.best_fit(lengths, 100)
        bins = packing.pack_lengths(lengths, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= 100 for b in bins) and len(bins) <= len(first)


def test_search_improves_on_best_fit():
    # 20 goes to the second bin for its 10, which fits into the first.
    assert len(packing.local_search([[0, 1], [2, 3], [4]], [60, 25, 75, 10, 20], 100)) == 2
    # 40 goes to the first bin for 15 and 10, which fit into the other two.
    assert len(packing.local_search([[0, 1, 2], [3], [4], [5]], [60, 15, 10, 85, 90, 40], 100)) == 3


def test_search_goes_on_past_a_donor_without_offers():
    # The emptiest bin has no offer until 820 and 614 change places between the other two.
    assert len(packing.pack_lengths([820, 820, 614, 614, 614, 614])) == 2
    assert len(packing.pack_lengths([820] * 30 + [614] * 60)) == 30


def test_no_exchange_is_left():
    r = random.Random(6)
    for _ in range(100):
        lengths = [r.randint(1, r.choice([30, 60, 100])) for _ in range(r.randint(0, 30))]
        bins = [[lengths[i] for i in b] for b in packing.pack_lengths(lengths, 100)]
        for d, donor in enumerate(bins):
            for s in donor:
                for b, other in enumerate(bins):
                    backs = [0, *other, *(x + y for k, x in enumerate(other) for y in other[:k])]
                    assert b == d or not any(y < s and sum(donor) < sum(other) + s - y <= 100 for y in backs)


def test_nothing_to_pack(docs):
    assert packing.pack(docs([]), path()).count() == 0
