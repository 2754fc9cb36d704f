"""What tasks hold at once, and what a worker still holds after them."""

import random

import pyarrow as pa

from casequarry.llm import common, packing, sanitise
from casequarry.llm.queries import tokenizer_path


class Caught:
    """Stands for a table and keeps the function that it is given, so that a test is its task."""

    dtypes = [("doc_id", "bigint"), ("text", "string")]

    def select(self, *_):
        return self

    def groupBy(self, *_):
        return self

    agg = groupBy

    def mapInArrow(self, run, _):
        self.run = run
        return self


def batch(texts):
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])


def test_slices_hold_all_rows_in_order():
    texts = [None, "", "x" * 50, "ä" * 40, None, "y" * 500, "z", ""] * 20
    rows = batch(texts)
    for whole in (rows, rows.slice(3, 100)):
        parts = list(common.sliced([whole], 200))
        assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([whole]))
        assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= 200 for p in parts)
    empty = batch([])
    assert [p.num_rows for p in common.sliced([empty, rows.slice(0, 2)], 200)] == [0, 2]


def test_packing_leaves_no_words_in_the_worker():
    caught = Caught()
    packing.pieces(caught, tokenizer_path())
    rows = sum(b.num_rows for b in caught.run(iter([batch(["some words here", None, "and more of them"])])))
    words = packing.TokenIds.of(tokenizer_path())
    assert rows == 3 and not words.young and not words.old
    task = caught.run(iter([batch(["one"]), batch(["two"])]))
    next(task)
    assert words.young
    task.close()  # a task that is given up
    assert not words.young


def test_packing_does_not_depend_on_slices(monkeypatch):
    r = random.Random(5)
    texts = [None, ""] + [" ".join(r.choice(["Word", "x1,", "naïve", "日本", f"n{r.random()}"]) for _ in range(r.randrange(3000))) for _ in range(40)]
    caught = Caught()
    packing.pieces(caught, tokenizer_path())
    whole = pa.Table.from_batches(caught.run(iter([batch(texts)]))).to_pylist()
    monkeypatch.setattr(packing, "sliced", lambda batches: common.sliced(batches, 1000))
    monkeypatch.setattr(packing, "CACHE", 100)
    assert pa.Table.from_batches(caught.run(iter([batch(texts)]))).to_pylist() == whole


def test_term_counts_holds_a_bounded_number_of_terms(spark, monkeypatch):
    monkeypatch.setattr(sanitise, "DISTINCT", 500)
    caught = Caught()
    sanitise.term_counts(caught)
    texts = [f"all w{k} w{k + 1} all" for k in range(5000)]
    out = list(caught.run(iter([batch(texts)])))
    assert max(b.num_rows for b in out) <= 500 + 3 * 200
    total = {}
    for b in out:
        for word, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist()):
            total[word] = total.get(word, 0) + n
    assert total["all"] == 5000 and total["w0"] == 1 and total["w7"] == 2


def test_mentions_come_in_small_batches(spark):
    caught = Caught()
    caught.withColumn = caught.select
    text = "write to someone@example.org today or call them about it " + "filler " * 2000
    frame = batch([text] * 400)
    frame = pa.RecordBatch.from_arrays([*frame.columns, pa.array(range(400), pa.int64())], names=["doc_id", "text", "row"])
    sanitise.mentions(caught)
    out = [b.column("row").to_pylist() for b in caught.run(iter([frame]))]
    assert len(out) > 2 and sorted({i for rows in out for i in rows}) == list(range(400))
