"""Quality classifier: a small byte-level convolutional network in numpy.

Filters of ``WIDTH`` bytes slide over the whole text in steps of ``STRIDE``.
Blocks of ``BLOCK`` bytes are max-pooled, each two neighbouring blocks make one
of the overlapping chunks, a dense layer reads a chunk's pooled filters, and the
mean and maximum of that over all chunks give one probability. Filters are sums
of table rows (tap, byte), so a convolution is a few gathers.

Training runs on the driver over a bounded sample: at most ``SAMPLE`` labelled
documents of each class, the first by a hash of the id, texts of at most
``SAMPLE_BYTES`` bytes. Scoring reads every text whole, in tasks, with a model
of some 120 kB.

Cases: null and empty texts are scored as empty ones; labels without a quality
are not used and of several labels of one id the least counts; without any
usable label every score is 0.5; an empty table gives no rows; only doc_id and
text are read, and ``keep_good`` passes all columns through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casequarry.llm.common import as_bytes, chunks

WIDTH, STRIDE, BLOCK = 6, 2, 128
FILTERS, HIDDEN = 16, 16
SAMPLE, SAMPLE_BYTES = 2000, 65_536
EPOCHS, BATCH, RATE = 10, 64, 0.01
THRESHOLD = 0.3
_PAD = 256


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts laid out in whole blocks and one block of padding behind each, so that no filter reaches the next text; blocks per text."""
    sizes = np.diff(offsets)
    blocks = np.maximum((sizes + BLOCK - 1) // BLOCK, 1)
    begins = np.concatenate([[0], np.cumsum(blocks + 1)[:-1]]) * BLOCK
    out = np.full(int((blocks + 1).sum()) * BLOCK + WIDTH, _PAD, np.uint16)
    out[np.arange(len(data)) + np.repeat(begins - offsets[:-1], sizes)] = data
    return out, blocks


class Network:
    """Parameters and both directions of the network."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "taps": r.normal(0, 0.35, (WIDTH, _PAD + 1, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "dense": r.normal(0, 0.3, (FILTERS, HIDDEN)).astype(np.float32),
            "dense_bias": np.zeros(HIDDEN, np.float32),
            "out": r.normal(0, 0.2, 2 * HIDDEN).astype(np.float32),
            "out_bias": np.zeros(1, np.float32),
        }
        self.constant: float | None = None

    def _pool(self, symbols, blocks, places=False):
        """Filters max-pooled over chunks, first chunk of each text; with places also where the maxima are."""
        n, step = int((blocks + 1).sum()), BLOCK // STRIDE
        at = np.arange(n * step) * STRIDE
        value = self.p["taps"][0][symbols[at]]
        for t in range(1, WIDTH):
            value += self.p["taps"][t][symbols[at + t]]
        value = value.reshape(n, step, FILTERS)
        peak = value.max(axis=1)
        last = np.cumsum(blocks + 1) - 2
        more = np.ones(n, bool)
        more[last] = more[last + 1] = False
        follow = np.minimum(np.arange(n) + 1, n - 1)
        second = more[:, None] & (peak[follow] > peak)
        pooled = np.where(second, peak[follow], peak)
        keep = more.copy()
        keep[last[blocks == 1]] = True  # a text of one block is one chunk
        first = np.concatenate([[0], np.cumsum(np.maximum(blocks - 1, 1))[:-1]])
        if not places:
            return pooled[keep], first, None
        where = value.argmax(axis=1) + (np.arange(n) * step)[:, None]
        return pooled[keep], first, np.where(second, where[follow], where)[keep] * STRIDE

    def _forward(self, pooled, first):
        p = self.p
        features = np.maximum(pooled + p["bias"], 0)
        hidden = np.maximum(features @ p["dense"] + p["dense_bias"], 0)
        sizes = np.diff(np.append(first, len(hidden)))
        top = np.maximum.reduceat(hidden, first, axis=0)
        mean = np.add.reduceat(hidden, first, axis=0) / sizes[:, None]
        logit = np.concatenate([mean, top], axis=1) @ p["out"] + p["out_bias"][0]
        return features, hidden, sizes, top, mean, logit

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        pooled, first, _ = self._pool(*padded(data, offsets))
        return 1 / (1 + np.exp(-self._forward(pooled, first)[-1].astype(np.float64)))

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        symbols, blocks = padded(np.frombuffer(b"".join(texts), np.uint8), offsets)
        pooled, first, places = self._pool(symbols, blocks, True)
        features, hidden, sizes, top, mean, logit = self._forward(pooled, first)
        d = ((1 / (1 + np.exp(-logit)) - labels) / len(labels)).astype(np.float32)
        g = {"out": np.concatenate([mean, top], axis=1).T @ d, "out_bias": np.array([d.sum()])}
        d_mean, d_top = d[:, None] * p["out"][:HIDDEN], d[:, None] * p["out"][HIDDEN:]
        d_hidden = np.repeat(d_mean / sizes[:, None], sizes, axis=0)
        best = hidden == np.repeat(top, sizes, axis=0)
        d_hidden += best * np.repeat(d_top / np.add.reduceat(best.astype(np.float32), first, axis=0), sizes, axis=0)
        d_hidden *= hidden > 0
        g["dense"], g["dense_bias"] = features.T @ d_hidden, d_hidden.sum(axis=0)
        d_pool = (d_hidden @ p["dense"].T) * (features > 0)
        g["bias"] = d_pool.sum(axis=0)
        taps = np.empty((WIDTH, (_PAD + 1) * FILTERS), np.float32)
        for t in range(WIDTH):
            index = symbols[places + t].astype(np.int64) * FILTERS + np.arange(FILTERS)
            taps[t] = np.bincount(index.ravel(), d_pool.ravel(), (_PAD + 1) * FILTERS)
        g["taps"] = taps.reshape(WIDTH, _PAD + 1, FILTERS)
        return g

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> Network:
        """Adam over shuffled batches; fixed seed, so equal input gives an equal model."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, epochs * -(-len(texts) // BATCH)
        for _ in range(epochs):
            order = r.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                some = order[at:at + BATCH]
                step += 1
                rate = RATE * (1 - step / (total + 1))
                for k, g in self.gradients([texts[i] for i in some], labels[some]).items():
                    m[k] += 0.1 * (g - m[k])
                    s[k] += 0.001 * (g * g - s[k])
                    self.p[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                                  / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; rows of fold 0 are held out."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network:
    """A network fitted on at most ``sample`` documents of each class outside fold 0."""
    usable = (labels.where("doc_id is not null and quality is not null and quality in (0, 1)")
              .groupBy("doc_id").agg(F.min("quality").alias("quality")).where(fold(F.col("doc_id")) != 0))
    short = docs.where(F.octet_length("text") <= sample_bytes).select("doc_id", "text")
    taken = []
    for k in (0, 1):
        ids = usable.where(F.col("quality") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        taken += short.join(F.broadcast(ids), "doc_id").collect()
    rows = sorted({(r["doc_id"], r["text"], r["quality"]) for r in taken})
    network = Network()
    answers = np.array([r[2] for r in rows], np.float32)
    if len(set(answers.tolist())) < 2:
        network.constant = float(answers[0]) if len(answers) else 0.5
        return network
    return network.fit([r[1].encode() for r in rows], answers)


def _scores(batch: pa.RecordBatch, network: Network) -> np.ndarray:
    parts = [network.scores(data, offsets) for _, _, data, offsets in chunks(as_bytes(batch.column("text")), 1 << 17)]
    return np.concatenate(parts) if parts else np.zeros(0)


def score(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            values = _scores(batch, model.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least ``threshold``, unchanged."""
    model = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch, model.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)
