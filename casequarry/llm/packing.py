"""Best-fit packing of tokenised documents into sequences, improved by local search.

Texts become token ids in tasks; a document longer than a sequence is cut into
full pieces and a rest. Pieces (a few numbers each) are dealt at random into
groups of about ``GROUP`` and each group is packed by itself: best fit, longest
first, then exchanges between underfull sequences that raise the sum of squared
fills: move a piece, swap one for one, or one for two, in repeated passes over
all underfull sequences until no exchange helps. A group wastes about one
sequence, so groups of this size cost nothing visible and bound memory.

The tokenizer folds case, drops white space and never joins across it, so texts
are split at ASCII blanks with A-Z folded and each task keeps ids of words. Only
the tokenizer stays in a worker: what comes after packing runs in the same workers.

Cases: a null or empty text is its end token alone; repeated rows are packed
each for itself, null ids too; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import bisect
import heapq
import re
import struct
import zlib
from collections import defaultdict
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casequarry.llm.common import as_bytes, sliced
from casequarry.session import cut

CAPACITY = 2048
END = 0
GROUP = 40_000
CACHE = 600_000  # some 200 bytes each
_PUNCTUATION = b".,;:!?|#%&*$"
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff\u00c0-\u00d6\u00d8-\u00de]+")
_WORKERS: dict[str, TokenIds] = {}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class TokenIds:
    """Ids of texts as little-endian 32-bit numbers, exactly as the tokenizer gives them.

    A word ends where the tokenizer would end it: at blanks, and between an ASCII
    letter or digit and a run of punctuation. Words of plain Latin letters go
    straight to the tokenizer's model; normalising and splitting would leave them
    alone. All others take the whole way. Words met lately are remembered in two
    generations of ``CACHE`` / 2, so a task's memory is bounded and frequent
    words stay; ``forget`` ends that.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spell = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = {c: spell.pre_tokenize_str(chr(c).lower())[0][0] for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)}
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    @staticmethod
    def of(path: str) -> TokenIds:
        """The worker's own one, kept between tasks."""
        if path not in _WORKERS:
            _WORKERS[path] = TokenIds(path)
        return _WORKERS[path]

    def forget(self) -> None:
        self.young, self.old = {}, {}

    def _learn(self, words: list[bytes]) -> None:
        young, split, slow = self.young, [], set()

        def part(word: bytes) -> None:
            text = word.decode()
            if _PLAIN.fullmatch(text):
                tokens = self.model.tokenize(text.translate(self.spelling))
                young[word] = _packed([t.id for t in tokens])
            else:
                slow.add(word)

        for word in words:
            core = word.rstrip(_PUNCTUATION)
            if len(core) < len(word) and core[-1:].isalnum():
                split.append((word, core, word[len(core):]))
                for piece in split[-1][1:]:
                    if piece not in young:
                        part(piece)
            else:
                part(word)
        rest = list(slow)
        for word, found in zip(rest, self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)):
            young[word] = _packed(found.ids)
        for word, core, tail in split:
            young[word] = young[core] + young[tail]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        pieces = [t.lower().split() for t in texts]
        words = set().union(*pieces)
        if len(self.young) + len(words) > CACHE // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = []
        for word in words:
            if word not in young:
                known = old.get(word)
                if known is None:
                    missing.append(word)
                else:
                    young[word] = known
        self._learn(missing)
        return [b"".join(map(young.__getitem__, p)) for p in pieces]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: what has to be packed."""
    tail = _packed([end])

    def run(batches):
        ids_of = TokenIds.of(tokenizer)
        try:
            for batch in sliced(batches):
                rows, out = [], []
                for k, ids in enumerate(ids_of(as_bytes(batch.column("text")).to_pylist())):
                    ids += tail
                    for piece, begin in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[begin:begin + 4 * capacity]
                        rows.append(k)
                        out.append((piece, begin // 4, len(part) // 4, zlib.crc32(part)))
                columns = list(zip(*out)) or [[]] * 4
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())),
                     *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
        finally:
            ids_of.forget()

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that holds it."""
    bins: list[list[int]] = []
    by_space: dict[int, list[int]] = defaultdict(list)
    spaces: list[int] = []  # sorted, those that have bins
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        at = bisect.bisect_left(spaces, need)
        if at == len(spaces):
            bins.append([i])
            here, left = len(bins) - 1, capacity - need
        else:
            space = spaces[at]
            here, left = by_space[space].pop(), space - need
            if not by_space[space]:
                del spaces[at]
            bins[here].append(i)
        if left:
            if not by_space[left]:
                bisect.insort(spaces, left)
            by_space[left].append(here)
    return bins


class _Receivers:
    """Underfull bins by ``reach``: the free space there is once items of length ``back`` are out of the bin.

    An item of length s fits when back < s <= reach, and then reach - s stays free.
    """

    def __init__(self, capacity: int):
        self.bins: list[dict[int, dict[int, None]]] = [{} for _ in range(capacity + 1)]  # by reach, then back
        self.least: list[list[int]] = [[] for _ in range(capacity + 1)]  # heaps of back, some out of date

    @staticmethod
    def _backs(sizes: list[int]) -> set[int]:
        kinds = set(sizes)
        twice = {k for k in kinds if sizes.count(k) > 1} if len(kinds) < len(sizes) else ()
        return {0, *kinds, *(x + y for x, y in combinations(kinds, 2)), *(2 * k for k in twice)}

    def add(self, b: int, free: int, sizes: list[int]) -> None:
        for back in self._backs(sizes) if free and sizes else ():
            here = self.bins[back + free]
            if back not in here:
                here[back] = {}
                heapq.heappush(self.least[back + free], back)
            here[back][b] = None

    def remove(self, b: int, free: int, sizes: list[int]) -> None:
        for back in self._backs(sizes) if free and sizes else ():
            here = self.bins[back + free]
            del here[back][b]
            if not here[back]:
                del here[back]

    def find(self, size: int, free: int, donor: int) -> tuple[int, int] | None:
        """Bin and length to give back, so that less than ``free`` stays free there, as little as can be."""
        for reach in range(size, min(size + free, len(self.bins))):
            here, heap = self.bins[reach], self.least[reach]
            while heap and heap[0] not in here:
                heapq.heappop(heap)
            if not heap or heap[0] >= size:
                continue
            for b in here[heap[0]]:
                if b != donor:
                    return b, heap[0]
            for back in sorted(here):  # only the donor itself is at the first one
                if back >= size:
                    break
                for b in here[back]:
                    if b != donor:
                        return b, back
        return None


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Exchange items between underfull bins, emptiest donors first, until no step raises the squared fill.

    A step takes an item out of the donor and gives it to another bin, for
    nothing (move), for one smaller item or for two (swap), the exchange that
    leaves the receiver fullest, and fuller than the donor was. Passes over all
    donors are repeated until one changes nothing. A donor that gets empty is gone.
    """
    bins = [list(b) for b in bins]
    free = [capacity - sum(lengths[i] for i in b) for b in bins]
    receivers = _Receivers(capacity)
    sizes = lambda b: [lengths[i] for i in bins[b]]
    for b in range(len(bins)):
        receivers.add(b, free[b], sizes(b))

    def step(donor: int) -> bool:
        for size in sorted(set(sizes(donor)), reverse=True):
            found = receivers.find(size, free[donor], donor)
            if found:
                b, back = found
                receivers.remove(donor, free[donor], sizes(donor))
                receivers.remove(b, free[b], sizes(b))
                item = next(i for i in bins[donor] if lengths[i] == size)
                given = _given(back, bins[b], lengths)
                bins[donor] = [i for i in bins[donor] if i != item] + given
                bins[b] = [i for i in bins[b] if i not in given] + [item]
                free[donor] += size - back
                free[b] -= size - back
                receivers.add(donor, free[donor], sizes(donor))
                receivers.add(b, free[b], sizes(b))
                return True
        return False

    changed = True
    while changed:
        changed = False
        for donor in sorted((b for b in range(len(bins)) if bins[b] and free[b]), key=lambda b: -free[b]):
            while bins[donor] and free[donor] and step(donor):
                changed = True
    return [b for b in bins if b]


def _given(back: int, items: list[int], lengths: list[int]) -> list[int]:
    """None, one or two of ``items`` of length ``back`` together."""
    if not back:
        return []
    by_length: dict[int, list[int]] = defaultdict(list)
    for i in items:
        by_length[lengths[i]].append(i)
    if back in by_length:
        return by_length[back][:1]
    for size, here in by_length.items():
        if 2 * size == back and len(here) > 1:
            return here[:2]
        if 2 * size != back and back - size in by_length:
            return [here[0], by_length[back - size][0]]
    raise ValueError("no such items")


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    return local_search(best_fit(lengths, capacity), lengths, capacity)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, group: int = GROUP) -> DataFrame:
    """One row per piece with its sequence_id and its offset there."""
    parts = cut(pieces(docs, tokenizer, capacity, end))
    n = max(1, round(parts.count() / group))
    schema = "doc_id {}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long".format(
        dict(docs.dtypes)["doc_id"])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = table.column("length").to_pylist()
        where, offset = [0] * len(lengths), [0] * len(lengths)
        base = table.column("__group")[0].as_py() << 32
        for number, items in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in items:
                where[i], offset[i] = base + number, at
                at += lengths[i]
        return table.drop_columns(["__group"]).append_column("sequence_id", pa.array(where, pa.int64())).append_column(
            "offset", pa.array(offset, pa.int64()))

    dealt = parts.withColumn("__group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(n)))
    return dealt.groupBy("__group").applyInArrow(run, schema)
