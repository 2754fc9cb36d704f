"""Language model: hashed maximum entropy with a class-factored softmax.

P(word | history) = P(class | history) * P(slot | class, history) * P(word | slot, history)

The ``CLASSES * SLOTS`` commonest tokens of the training texts have slots of their own, dealt
over the classes by rank; every other token falls, by its hash, into the last
slot of a class. There the next bits of its hash lead it down a tree of classes of two,
each decided given the history, as deep as there are words to tell apart (some two to
a leaf, from ``DEEPEST`` on more). In its leaf it has probability (c + 1) / (N + V + 1) of the
leaf's counts, so that unknown words share what one occurrence has and all words sum to one.
All layers begin with the logarithms of their counts and add rows of hashed
tables, one for each feature of the history: the token before, the two before and
the one before that (a skip; not in the tree). A row has one weight for each class, for each
slot of one class, or for one node of the tree.

Training: rounds over disjoint parts of the training texts, all of which are read
once. In a round every task starts from the shared weights, makes mini-batch
gradient steps (AdaGrad) over its texts and sends the change of each block of rows; changes
are averaged by how often each row was used, in Spark, block by block as they
stream in. The driver only ever holds the tables, whose size is fixed.

Counts of all training tokens are exact: parts send each different token once to
the bucket of its hash, buckets add up and answer. Scoring reads every text whole
in its part, in batches of tokens, with those counts.

Cases: null and empty texts are one end token; rows of null id are trained on and
not held out; without training tokens every known count is zero and weights stay
zero; repeated rows count each time; an empty table gives no rows; columns other
than doc_id and text are ignored. Tokens are told apart by 96 bits of two hashes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from casequarry.llm import rolling
from casequarry.llm.collocations import grouped
from casequarry.llm.common import as_bytes, chunks, layout
from casequarry.llm.repeats import ANSWER, SENT, _ANSWER, pack, rows_of, sent, unpack
from casequarry.session import cut
from casequarry.skew import salts, spread

FOLDS, HELD_OUT = 7, 2
CLASSES, SLOTS = 32, 15
ROWS_1, ROWS_2 = 1 << 13, 1 << 14
FEATURES = 3
ROUNDS, BATCH, RATE, START = 3, 16384, 0.1, 0.01
BLOCKS = 16
DEEPEST, NODES = 14, 1 << 18  # levels of the tree below a class; weights of its nodes
TREE_FEATURES, TREE_RATE = 1, 0.1
PART_BYTES, BUCKET_BYTES = 4_000_000, 12_000_000
_OTHER = rolling.LOWER ^ np.uint8(0xA5)
_END = (np.uint64(0x9D3C5A71E0B4F826), np.uint32(0x51C7E94B))
_STEPS = np.array([0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9], np.uint64)


def fold(doc_id: Column) -> Column:
    """Whether a row is held out: crc32 of the id as text has remainder 2 modulo 7."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS == HELD_OUT, F.lit(False))


class Tokens:
    """The tokens of some texts: hash, second hash, and which row each is of; every row ends in an end token."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        begins, ends, rows = rolling.words(data, offsets, rolling.NOT_BLANK)
        n = len(offsets) - 1
        self.sizes = np.bincount(rows, minlength=n) + 1
        self.rows = np.repeat(np.arange(n), self.sizes)
        self.heads = np.cumsum(self.sizes) - self.sizes
        at = np.arange(len(begins)) + rows
        self.h = np.full(int(self.sizes.sum()), _END[0], np.uint64)
        self.check = np.full(len(self.h), _END[1], np.uint32)
        if len(begins):
            self.h[at] = rolling.word_hashes(data, begins, ends, rolling.LOWER)
            self.check[at] = (rolling.word_hashes(data, begins, ends, _OTHER) >> np.uint64(32)).astype(np.uint32)

    def back(self, k: int) -> np.ndarray:
        """Hash of the token k before, in the same row; 0 where there is none."""
        out = np.zeros(len(self.h), np.uint64)
        out[k:] = self.h[:-k] if k < len(self.h) else self.h[:0]
        for j in range(k):
            short = self.heads[self.sizes > j] + j
            out[short] = np.uint64(j + 1)
        return out


def features(tokens: Tokens) -> np.ndarray:
    """One 64-bit value per token and feature of its history."""
    one, two = tokens.back(1), tokens.back(2)
    out = np.stack([one, one * np.uint64(3) + rolling.mix(two), two])
    return rolling.mix(out + _STEPS[:, None])


@dataclass
class Counts:
    """What is known of all training tokens, in numbers of fixed size."""
    tokens: int = 0  # N
    different: int = 0  # V
    top: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # hashes of the commonest, in order of hash
    place: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # class * SLOTS + slot of each
    rest: np.ndarray = field(default_factory=lambda: np.zeros((CLASSES, 2)))  # per class: tokens, different ones in the last slot
    own: np.ndarray = field(default_factory=lambda: np.zeros((CLASSES, SLOTS)))  # per slot: tokens
    leaves: np.ndarray = field(default_factory=lambda: np.ones((CLASSES, 1)))  # per leaf of a class's tree: tokens, different ones, one unknown

    @property
    def depth(self) -> int:
        return self.leaves.shape[1].bit_length() - 1

    def odds(self) -> np.ndarray:
        """Per node of each class's tree, numbered from 1 at the root: log odds of its second half."""
        levels = [self.leaves]
        for _ in range(self.depth):
            levels.append(levels[-1][:, ::2] + levels[-1][:, 1::2])
        nodes = [np.zeros((CLASSES, 1)), *(np.log(x[:, 1::2] / x[:, ::2]) for x in levels[-2::-1])]
        return np.hstack(nodes).astype(np.float32)

    def leaf(self, h: np.ndarray) -> np.ndarray:
        """Leaf of each token in the tree of its class, from the bits after those that name the class."""
        return (rolling.mix(h) >> np.uint64(59 - self.depth)).astype(np.int64) & ((1 << self.depth) - 1)

    def logs(self) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms of smoothed counts: of classes, of the slots of each class."""
        slots = np.hstack([self.own + (self.own > 0), (self.rest.sum(axis=1) + 1)[:, None]])
        return np.log(slots.sum(axis=1)).astype(np.float32), np.log(np.maximum(slots, 1e-9)).astype(np.float32)

    def slots(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and slot of each token."""
        group = (rolling.mix(h) >> np.uint64(59)).astype(np.int64) % CLASSES
        slot = np.full(len(h), SLOTS, np.int64)
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, h), len(self.top) - 1)
            own = self.top[at] == h
            place = self.place[at[own]]
            group[own], slot[own] = place // SLOTS, place % SLOTS
        return group, slot


def _group_of(h: np.ndarray) -> np.ndarray:
    return (rolling.mix(h) >> np.uint64(59)).astype(np.int64) % CLASSES


def _cell(h: np.ndarray) -> np.ndarray:
    """Class and leaf of the deepest tree in one number."""
    return (rolling.mix(h) >> np.uint64(59 - DEEPEST)).astype(np.int64)


class Model:
    """Weights of both layers and both directions through them."""

    def __init__(self, counts: Counts, first: np.ndarray | None = None, second: np.ndarray | None = None, third: np.ndarray | None = None):
        self.counts = counts
        self.first = np.zeros((ROWS_1, CLASSES), np.float32) if first is None else first
        self.second = np.zeros((ROWS_2, SLOTS + 1), np.float32) if second is None else second
        self.third = np.zeros((NODES, 1), np.float32) if third is None else third
        self.logs, self.odds = counts.logs(), counts.odds()

    @staticmethod
    def _places(values: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = rolling.mix(values ^ (group.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        return (values >> np.uint64(40)).astype(np.int32) % ROWS_1, (own >> np.uint64(40)).astype(np.int32) % ROWS_2

    @staticmethod
    def _softmax(table: np.ndarray, places: np.ndarray, begin: np.ndarray) -> np.ndarray:
        z = table.take(places[0], axis=0)
        for row in places[1:]:
            z += table.take(row, axis=0)
        z += begin
        np.exp(np.clip(z, -80, 80, out=z), out=z)  # logarithms of counts are far inside
        z /= np.einsum("ij->i", z)[:, None]
        return z

    def _path(self, values: np.ndarray, group: np.ndarray, leaf: np.ndarray):
        """Per level of the tree: the weights' places, one row a feature, which half the token is in, and P of the second."""
        for level in range(self.counts.depth):
            node = (1 << level) + (leaf >> (self.counts.depth - level))
            key = (node * CLASSES + group).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            places = (((values[:TREE_FEATURES] ^ key) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(65 - NODES.bit_length())).astype(np.int64)
            z = self.odds.ravel().take(group * self.odds.shape[1] + node)
            for row in places:
                z += self.third.ravel().take(row)
            half = leaf >> (self.counts.depth - level - 1) & 1
            yield places, half, 1 / (1 + np.exp(np.clip(-z, -80, 80, out=z)))

    def inside(self, values: np.ndarray, group: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """log10 P(leaf | class, history) of tokens that have no slot of their own."""
        out = np.zeros(len(group))
        for _, half, p in self._path(values, group, leaf):
            out += np.log10(np.maximum(np.abs(1 - half.astype(np.float32) - p), np.float32(1e-30)))
        return out

    def log10(self, values: np.ndarray, group: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """log10 P(class) P(slot | class) of each token."""
        each = np.arange(len(group))
        one, two = self._places(values, group)
        p = self._softmax(self.first, one, self.logs[0])[each, group].astype(np.float64)
        p *= self._softmax(self.second, two, self.logs[1][group])[each, slot]
        return np.log10(np.maximum(p, 1e-300))


def _summed_rows(rows: np.ndarray, error: np.ndarray, crowd: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows, how often each comes, the sum of its errors; ``rows`` goes through ``error`` once or several times."""
    order = np.argsort(rows.astype(np.int16), kind="stable")  # fewer rows than 2^15
    rows = rows[order]
    begins = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    sizes = np.diff(np.append(begins, len(rows)))
    by = np.argsort(-sizes, kind="stable")
    begins, sizes = begins[by], sizes[by]
    names = rows[begins]
    order %= len(error)
    total = error.take(order[begins], axis=0)
    many = np.count_nonzero(sizes > crowd)
    for i in range(many):
        total[i] = error.take(order[begins[i]:begins[i] + sizes[i]], axis=0).sum(axis=0)
    for k in range(1, crowd):  # the second of all, the third of those that have one
        some = np.count_nonzero(sizes > k)
        total[many:some] += error.take(order[begins[many:some] + k], axis=0)
    return names, sizes, total


class Learner(Model):
    """A task's own copy: steps of AdaGrad, and how often each row was used."""

    def __init__(self, model: Model):
        super().__init__(model.counts, model.first.copy(), model.second.copy(), model.third.copy())
        self.begin = (model.first, model.second, model.third)
        self.squares = [np.full(len(t), START, np.float32) for t in self.begin]
        self.uses = [np.zeros(len(t), np.int64) for t in self.begin]

    def _add(self, k: int, table: np.ndarray, names: np.ndarray | slice, uses: np.ndarray, total: np.ndarray, rate: float) -> None:
        """A step along the sums of errors of some rows."""
        gradient = total / np.sqrt(np.maximum(uses, 1)).astype(np.float32)[:, None]
        self.squares[k][names] += np.einsum("ij,ij->i", gradient, gradient) / gradient.shape[1]
        table[names] += rate * gradient / np.sqrt(self.squares[k][names])[:, None]
        self.uses[k][names] += uses

    def step(self, values: np.ndarray, group: np.ndarray, slot: np.ndarray, leaf: np.ndarray | None = None) -> None:
        each = np.arange(len(group))
        one, two = self._places(values, group)
        if not len(each):
            return
        for k, (table, places, truth, begin) in enumerate(((self.first, one, group, self.logs[0]), (self.second, two, slot, self.logs[1][group]))):
            error = -self._softmax(table, places, begin)
            error[each, truth] += 1
            self._add(k, table, *_summed_rows(np.concatenate(places), error), RATE)
        if leaf is not None and self.counts.depth:
            rare = slot == SLOTS
            steps = [(places, half - p) for places, half, p in self._path(values[:, rare], group[rare], leaf[rare])]
            error = np.concatenate([e for _, e in steps]).astype(np.float32)
            total = np.zeros(NODES, np.float32)
            uses = np.zeros(NODES, np.int64)
            for places in np.concatenate([p for p, _ in steps], axis=1):
                uses += np.bincount(places, minlength=NODES)
                np.add.at(total, places, error)
            self._add(2, self.third, slice(None), uses, total[:, None], TREE_RATE)

    def changes(self):
        """Per table and block of rows: uses of each row, its change times them."""
        for k, (begin, table) in enumerate(zip(self.begin, (self.first, self.second, self.third))):
            for b, mine in enumerate(np.split(np.arange(len(table)), BLOCKS)):
                some = mine[self.uses[k][mine] > 0]
                if len(some):
                    yield k * BLOCKS + b, pack((some - mine[0]).astype(np.int32), self.uses[k][some], (table[some] - begin[some]).astype(np.float16))


def learnt(docs: DataFrame, model: Model) -> Model:
    """One round over ``docs``: what the tasks learn from them, averaged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    widths = (CLASSES, SLOTS + 1, 1)
    heights = (ROWS_1 // BLOCKS, ROWS_2 // BLOCKS, NODES // BLOCKS)

    def run(batches):
        learner = Learner(shared.value)
        for batch in batches:
            for _, _, data, offsets in chunks(as_bytes(batch.column("text")), 1 << 20):
                tokens = Tokens(data, offsets)
                for at in range(0, len(tokens.h), BATCH):
                    values, h = _history(tokens, at, BATCH)
                    learner.step(values, *learner.counts.slots(h), learner.counts.leaf(h))
        rows = list(learner.changes())
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "body"])

    def add(batches):
        totals: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist()):
                k = block // BLOCKS
                uses, change = totals.setdefault(block, (np.zeros(heights[k], np.int64), np.zeros((heights[k], widths[k]), np.float64)))
                rows, n, d = unpack(body, np.int32, np.int64, np.float16)
                uses[rows] += n
                change[rows] += d.reshape(len(rows), -1) * n[:, None].astype(np.float64)
        out = [(b, pack(u, (c / np.maximum(u, 1)[:, None]).astype(np.float32))) for b, (u, c) in totals.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary())], names=["block", "body"])

    sums = docs.select("text").mapInArrow(run, "block int, body binary").repartition(len(widths) * BLOCKS, "block").mapInArrow(add, "block int, body binary")
    tables = (model.first.copy(), model.second.copy(), model.third.copy())
    for r in sums.collect():
        k, b = divmod(r["block"], BLOCKS)
        _, change = unpack(bytes(r["body"]), np.int64, np.float32)
        tables[k][b * heights[k]:(b + 1) * heights[k]] += change.reshape(heights[k], -1)
    return Model(model.counts, *tables)


def _history(tokens: Tokens, at: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature values and hashes of some tokens in a row."""
    end = min(at + size, len(tokens.h))
    if not hasattr(tokens, "values"):
        tokens.values = features(tokens)
    return tokens.values[:, at:end], tokens.h[at:end]


class Part:
    """The texts of a part in one order, and their different tokens by bucket."""

    def __init__(self, table: pa.Table, buckets: int):
        self.number = table.column("part")[0].as_py()
        texts = as_bytes(table.column("text"))
        plain, ids = texts.to_pylist(), table.column("doc_id").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, str(ids[i]), plain[i]))
        del plain
        take = pa.array(order, pa.int64())
        self.ids = table.column("doc_id").combine_chunks().take(take)
        self.held = np.asarray(table.column("held_out").combine_chunks().take(take)).astype(bool)
        data, offsets = layout(texts.take(take))
        self.tokens = t = Tokens(data[:offsets[-1]], offsets)
        order, new = grouped(t.h, t.check)
        heads = order[new]
        bucket = ((rolling.mix(t.h[heads]) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)  # a leaf is in one or two
        by = np.lexsort((t.check[heads], t.h[heads], bucket))
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        self.of = np.empty(len(t.h), np.int64)
        self.of[order] = rank[np.cumsum(new) - 1]
        self.h, self.check, self.bucket = t.h[heads][by], t.check[heads][by], bucket[by]
        self.counts = np.bincount(self.of, ~self.held[t.rows], len(by)).astype(np.uint32)

    def per_bucket(self):
        names, begins = np.unique(self.bucket, return_index=True)
        yield from zip(names.tolist(), begins.tolist(), [*begins[1:].tolist(), len(self.bucket)])

    def send(self) -> pa.Table:
        return sent((b, self.number, pack(self.h[a:z], self.check[a:z], self.counts[a:z])) for b, a, z in self.per_bucket())

    def read(self, answers: pa.Table) -> np.ndarray:
        """Training count of each token."""
        got = dict(rows_of(answers, "bucket"))
        out = np.zeros(len(self.h), np.int64)
        for b, a, z in self.per_bucket():
            out[a:z], = unpack(got[b], np.int64)
        return out[self.of]


def _summed(table: pa.Table) -> pa.Table:
    """Counts for each part; at part -1 what the bucket says of all its tokens."""
    bucket = table.column("bucket")[0].as_py()
    got = [(p, *unpack(body, np.uint64, np.uint32, np.uint32)) for p, body in rows_of(table, "part")]
    h, check, counts = (np.concatenate(x) for x in list(zip(*got))[1:])
    order, new = grouped(h, check)
    of = np.empty(len(h), np.int64)
    of[order] = np.cumsum(new) - 1
    total = np.bincount(of, counts).astype(np.int64)
    parts = np.split(total[of], np.cumsum([len(x[1]) for x in got])[:-1])
    rows = [(p, bucket, pack(n)) for (p, *_), n in zip(got, parts)]
    known = total > 0
    names, total = h[order][new][known], total[known]
    group = _group_of(names)
    best = np.lexsort((names, -total))[:CLASSES * SLOTS]
    cells, of = np.unique(_cell(names), return_inverse=True)
    rows.append((-1, bucket, pack(np.bincount(group, total, CLASSES).astype(np.int64), np.bincount(group, minlength=CLASSES), names[best], total[best],
                                  cells, np.bincount(of, total, len(cells)).astype(np.int64), np.bincount(of, minlength=len(cells)))))
    return sent(rows, _ANSWER)


def _statistics(answers: DataFrame) -> Counts:
    """Sums over the buckets, and the commonest of their commonest tokens."""
    def opened(batches):
        tokens, different = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        names, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        cells = []
        for batch in batches:
            for body in batch.column("body").to_pylist():
                n, v, own, c, *inner = unpack(body, np.int64, np.int64, np.uint64, np.int64, np.int64, np.int64, np.int64)
                cells.append(inner)
                tokens, different = tokens + n, different + v
                names, counts = np.concatenate([names, own]), np.concatenate([counts, c])
                best = np.lexsort((names, -counts))[:CLASSES * SLOTS]
                names, counts = names[best], counts[best]
        k = np.arange(CLASSES)
        place, n, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (list(zip(*cells)) or [[]] * 3))
        columns = [np.repeat([0, 1, 2], [len(k), len(names), len(place)]), np.concatenate([k, names.view(np.int64), place]), np.concatenate([tokens, counts, n]),
                   np.concatenate([different, np.ones_like(counts), v])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["kind", "k", "n", "v"])

    # One row a bucket; some tasks add them up and pass on what may still be among the commonest.
    tasks = salts(answers.sparkSession)
    rows = cut(answers.where("part = -1").select("body").repartition(tasks).mapInArrow(opened, "kind long, k long, n long, v long"))
    sums = rows.where("kind = 0").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    first = rows.where("kind = 1").groupBy("k").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "k").limit(CLASSES * SLOTS).collect()
    rest = np.zeros((CLASSES, 2))
    for r in sums:
        rest[r["k"]] = r["n"], r["v"]
    out = Counts(int(rest[:, 0].sum()), int(rest[:, 1].sum()), rest=rest)
    if first:
        names = np.array([r["k"] for r in first], np.int64).view(np.uint64)
        rank = np.arange(len(names))
        np.subtract.at(rest, _group_of(names), np.array([[r["n"], 1] for r in first], float))
        order = np.argsort(names)
        place = rank % CLASSES * SLOTS + rank // CLASSES
        out.own.ravel()[place] = [r["n"] for r in first]
        out.top, out.place = names[order], place[order]
    # Of the tree's leaves there are as many as it has words for, at most CLASSES << DEEPEST; the driver has only these sums.
    depth = max(0, min(DEEPEST, (max(int(rest[:, 1].sum()), 1) // (2 * CLASSES)).bit_length()))
    sums = rows.where("kind = 2").groupBy(F.shiftright("k", DEEPEST - depth).alias("k")).agg(F.sum(F.col("n") + F.col("v")).alias("n")).toArrow()
    out.leaves = np.ones((CLASSES, 1 << depth))
    out.leaves.ravel()[sums.column("k").to_numpy()] += sums.column("n").to_numpy()
    if first:
        np.subtract.at(out.leaves.ravel(), _cell(names) >> (DEEPEST - depth), np.array([r["n"] + 1 for r in first], float))
    return out


def score(docs: DataFrame, rounds: int = ROUNDS, part_bytes: int = PART_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, buckets = max(least, -(-total // part_bytes)), max(least, -(-total // bucket_bytes))
    key = F.xxhash64("doc_id", F.xxhash64("text"))
    rows = spread(docs).select("doc_id", "text", fold(F.col("doc_id")).alias("held_out"))
    by_part = rows.withColumn("part", F.pmod(key, F.lit(parts)).cast("int")).groupBy("part")
    answers = cut(by_part.applyInArrow(lambda t: Part(t, buckets).send(), SENT).groupBy("bucket").applyInArrow(_summed, ANSWER))
    counts = _statistics(answers)
    model = Model(counts)
    if counts.tokens:
        turn = F.pmod(F.xxhash64("doc_id", F.xxhash64("text"), F.lit(1)), F.lit(rounds))
        for r in range(rounds):
            model = learnt(rows.where(~F.col("held_out") & (turn == r)), model)
    shared = spark.sparkContext.broadcast(model)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def finish(table: pa.Table, got: pa.Table) -> pa.Table:
        part, model = Part(table, buckets), shared.value
        t, counts = part.tokens, model.counts
        c = part.read(got)
        base = np.log10((c + 1) / (counts.tokens + counts.different + 1))
        mine = np.zeros(len(c))
        for at in range(0, len(c), BATCH):
            values, h = _history(t, at, BATCH)
            group, slot = counts.slots(h)
            p = model.log10(values, group, slot)
            rare, leaf = slot == SLOTS, counts.leaf(h)
            g, leaf = group[rare], leaf[rare]
            p[rare] += model.inside(values[:, rare], g, leaf) + np.log10((c[at:at + BATCH][rare] + 1) / counts.leaves[g, leaf])
            mine[at:at + BATCH] = p
        add = lambda x: np.add.reduceat(x, t.heads) if len(t.heads) else np.zeros(0)
        return pa.Table.from_arrays([part.ids, pa.array(part.held), pa.array(t.sizes.astype(np.int64)), pa.array(add((c > 0).astype(np.int64)).astype(np.int64)),
                                     pa.array(np.full(len(t.heads), counts.tokens)), pa.array(add(base)), pa.array(add(mine))], names=names)

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return by_part.cogroup(answers.where("part >= 0").groupBy("part")).applyInArrow(finish, schema)
