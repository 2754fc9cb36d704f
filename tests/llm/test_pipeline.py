"""Each stage of the pipeline against plain Python, on its own input; and the registered queries' columns."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from casequarry.llm import packing, quality, sanitise
from casequarry.llm.queries import tokenizer_path
from tests.llm.tables import docs  # noqa: F401
from tests.llm.test_near_copies import brute_kept
from tests.llm.test_text_operators import brute_spans, plain_words

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
EDGE = ".,;:!?\"'()[]{}<>|#%&*$"


def tables(spark, folder, extra):
    """The small tables with odd rows added and a column whose name clashes."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(i, t, "en", "s", None if t is None else len(t)) for i, t in extra]
    spark.createDataFrame([(*r, "x", 1) for r in rows], docs.schema.simpleString()[7:-1].replace(":", " ") + ", terms string, part int").write.parquet(
        f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")


def brute_decontaminated(text, grams):
    if text is None:
        return None
    spans = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    w, hit = plain_words(text), set()
    for n, known in grams.items():
        for k in range(len(w) - n + 1):
            if tuple(w[k:k + n]) in known:
                hit.update(range(k, k + n))
    out, at = [], 0
    for k in sorted(hit):
        if k - 1 not in hit:
            out.append(text[at:spans[k][0]])
        at = spans[k][1]
    return "".join(out) + text[at:]


def brute_sanitised(texts):
    """By the definition, with plain counters over all documents."""
    n_term, both, n_entity, contexts = Counter(), Counter(), Counter(), []
    for text in texts:
        text = text or ""
        n_term.update({w.strip(EDGE).lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text)})
        spans, seen = brute_spans(text), set()
        for kind, b, e in spans:
            before = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text[:b])][-8:]
            after = [(m.start() + e, m.end() + e) for m in re.finditer(r"[^\x20\x09-\x0D]+", text[e:])][:8]
            for x, y in before + after:
                word = text[x:y].strip(EDGE)
                if len(word) > 1 and not any(x < z and a < y for _, a, z in spans):
                    start = x + len(text[x:y]) - len(text[x:y].lstrip(EDGE))
                    for entity in (kind, sanitise.entity(kind, text[b:e])):
                        seen.add((entity, word.lower(), start, start + len(word)))
        both.update({(e, t) for e, t, _, _ in seen})
        n_entity.update({e for e, _, _, _ in seen})
        contexts.append(seen)
    drop = {}
    for (e, t), n in both.items():
        ic = math.log2(len(texts) / n_entity[e])
        pmi = math.log2(len(texts) * n / (n_entity[e] * max(n_term[t], n)))
        if n >= 3 and ic > 0 and pmi >= 0.8 * ic:
            drop[e, t] = pmi >= 0.95 * ic
    out = []
    for text, seen in zip(texts, contexts):
        places = {}
        for e, t, a, b in seen:
            if (e, t) in drop:
                places[a, b] = places.get((a, b), False) or drop[e, t]
        out.append(text and sanitise.rewritten(text, [(a, b, d) for (a, b), d in places.items()]))
    return out


def test_each_stage_equals_plain_python(spark, tmp_path):
    r = random.Random(1)
    filler = lambda: " ".join(r.choice(["on", "the", "of", "and", "it"]) + r.choice("abc") for _ in range(40))
    extra = [(9000 + i, f"{filler()} Falconry ann@corp.example {filler()}") for i in range(5)]
    extra += [(8000, None), (8001, ""), (None, "no id at all"), extra[0], extra[0]]
    tables(spark, str(tmp_path), extra)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality", "near_duplicates", "decontamination", "personal_data", "packing"]
    columns = docs.columns
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "", x[1] is None)

    def step(name):
        nonlocal docs
        before = [(x["doc_id"], x["text"]) for x in docs.collect()]
        out = stage[name](spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        rows = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            assert all(x["n_chars"] == len(x["text"]) for x in rows if x["text"] is not None)
            return before, sorted(((x["doc_id"], x["text"]) for x in rows), key=key)
        return before, rows

    network = quality.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    before, after = step("quality")
    score = lambda t: network.scores(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[0]
    assert after == sorted(((i, t) for i, t in before if score(t) >= 0.3), key=key)

    before, after = step("near_duplicates")
    assert [i for i, _ in after if i is not None] == sorted(i for i, _ in brute_kept(before) if i is not None)
    assert set(after) <= set(before)

    items = [x["text"] for x in spark.read.parquet(f"{tmp_path}/benchmark.parquet").collect()]
    grams = {}
    for w in map(plain_words, items):
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams.setdefault(n, set()).add(tuple(w[k:k + n]))
    before, after = step("decontamination")
    assert after == sorted(((i, brute_decontaminated(t, grams)) for i, t in before), key=key)

    before, after = step("personal_data")
    assert after == sorted(zip((i for i, _ in before), brute_sanitised([t for _, t in before])), key=key)

    before, rows = step("packing")
    import tokenizers
    plain = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for i, t in before:
        n = len(plain.encode(t or "", add_special_tokens=False).ids) + 1
        want.update((i, k, a, min(2048, n - a)) for k, a in enumerate(range(0, n, packing.CAPACITY)))
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"]) for x in rows) == want
    fills = Counter()
    for x in rows:
        fills[x["sequence_id"]] += x["length"]
    total = sum(fills.values())
    assert max(fills.values()) <= 2048 and len(fills) <= -(-total // 2048) + 1


def test_terms_are_sanitised_as_defined(spark, docs):
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["Falconry", "(Oak)", "x1"]
    rows = [(i, " ".join(r.choice([*words, "ann@corp.example", "10.0.0.1"]) if r.random() < 0.9 else "" for _ in range(r.randint(0, 20))))
            for i in range(300)]
    want = brute_sanitised([t for _, t in rows])
    got = {x["doc_id"]: x["text"] for x in sanitise.clean(docs(rows)).collect()}
    assert [got[i] for i, _ in rows] == want
    assert any("[NAME]" in t or "[TERM]" in t or "  " in t for t in want)


def test_run_and_names(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
    names = [n for n in entry_points.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry_points.queries()
