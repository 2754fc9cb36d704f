"""Personal data: base patterns, then information-theoretic sanitisation around them.

Base spans come from patterns. The protected entities are their values, and each
kind as a whole (a value that stands in few documents has no statistics of its
own). How much a nearby term t reveals an entity e is the pointwise mutual information of the
two over the documents of the corpus, PMI(e; t) = log2(N n(e,t) / (n(e) n(t))),
which is at most the information of the entity, IC(e) = log2(N / n(e)), and equal
to it when t always comes with e. A term that stands with e in at least
``SUPPORT`` documents and reaches ``GENERALISE`` * IC(e) is generalised to a
class word next to e; one that reaches ``REMOVE`` * IC(e) is removed. Terms far
from any entity, and documents without one, stay as they are.

All counts are over all documents: n(t) counts every term of the corpus once per
document, n(e) and n(e,t) every mention's context. Counts are added up per task
first; a hot entity or term is one row per task by then. Texts move only when
``clean`` rewrites them.

Cases: a null text is empty and stays null in ``clean``; repeated rows are
documents of their own in the counts and get the same spans; null ids are kept;
an empty table gives no rows; other columns are ignored by ``scan`` and kept by
``clean``.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casequarry.llm.common import as_bytes, sliced
from casequarry.session import cut

REACH = 8
SUPPORT = 3
DISTINCT = 100_000  # terms that a task counts at once
GENERALISE, REMOVE = 0.8, 0.95
TOKENS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
KINDS = ["email", "ip", "card", "phone", "term"]

# Fixed patterns of the task. Email is found from its "@" (see below), and a run of
# digits is only tried from its beginning, so no text takes quadratic time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?\"'()[]{}<>|#%&*$"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """What ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`` finds, in linear time."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            out.append((begin, found.end()))
            free = found.end()
        at = text.find("@", max(free, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [("email", b, e) for b, e in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() and c.isascii() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def entity(kind: str, value: str) -> str:
    """One name for the ways a value can be written."""
    return f"{kind}:{value.lower()}" if kind in ("email", "ip") else f"{kind}:" + re.sub("[^0-9]", "", value)


def term(word: str) -> str:
    return word.strip(_EDGE).lower()


def context(text: str, spans: list[tuple[str, int, int]], reach: int = REACH) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the ``reach`` words on each side of each span."""
    out = set()
    begins, ends = [], []  # the spans merged, in order
    for b, e in sorted((b, e) for _, b, e in spans):
        if ends and b < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            begins.append(b)
            ends.append(e)

    def outside(b, e):
        before = bisect.bisect_left(begins, e) - 1
        return before < 0 or ends[before] <= b

    for kind, b, e in spans:
        names = (kind, entity(kind, text[b:e]))
        at, left = b, []
        while at > 0 and len(left) < reach:  # words before, walking back from the span
            end = at
            while end > 0 and text[end - 1] in " \t\n\x0b\x0c\r":
                end -= 1
            begin = end
            while begin > 0 and text[begin - 1] not in " \t\n\x0b\x0c\r":
                begin -= 1
            if begin == end:
                break
            left.append((begin, end))
            at = begin
        right, words = [], _WORD.finditer(text, e)
        for m in words:
            right.append(m.span())
            if len(right) == reach:
                break
        for begin, end in left + right:
            word = text[begin:end]
            lead = len(word) - len(word.lstrip(_EDGE))
            name_of = term(word)
            if len(name_of) > 1 and outside(begin, end):
                place = (name_of, begin + lead, begin + lead + len(word.strip(_EDGE)))
                out.update((name, *place) for name in names)
    return sorted(out)


def general(word: str) -> str:
    """The class a term is generalised to."""
    if any(c.isdigit() for c in word):
        return "[NUMBER]"
    return "[NAME]" if word[:1].isupper() else "[TERM]"


_MENTIONS = "doc_id {}, row long, entity string, term string, first int, end int"


def mentions(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per entity, term and place; ``row`` tells documents of one id apart by text."""
    def run(batches):
        for batch in sliced(batches):
            out = [(i, *c) for i, text in enumerate(batch.column("text").to_pylist()) if text
                   for c in context(text, base_spans(text), reach)]
            i, e, t, b, x = list(zip(*out)) or [[]] * 5
            take = pa.array(i, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(take), batch.column("row").take(take), pa.array(e, pa.string()),
                 pa.array(t, pa.string()), pa.array(b, pa.int32()), pa.array(x, pa.int32())],
                names=["doc_id", "row", "entity", "term", "first", "end"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("row")).mapInArrow(
        run, _MENTIONS.format(dict(docs.dtypes)["doc_id"]))


def term_counts(docs: DataFrame) -> DataFrame:
    """term, n: in how many documents each term of the corpus stands; added up per task first."""
    def run(batches):
        counts: dict[bytes, int] = {}

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array([k.decode() for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "n"])

        for batch in batches:
            text = as_bytes(batch.column("text"))
            for at in range(0, len(text), 200):
                for raw in text.slice(at, 200).to_pylist():
                    for word in {w.strip(edge) for w in raw.lower().split()}:
                        counts[word] = counts.get(word, 0) + 1
                if len(counts) > DISTINCT:
                    yield flush()
                    counts.clear()
        yield flush()

    edge = _EDGE.encode()
    # A-Z are folded above; letters beyond ASCII fold here, on far fewer rows.
    return docs.select("text").mapInArrow(run, "word string, n long").groupBy(F.lower("word").alias("term")).agg(
        F.sum("n").alias("n"))


def disclosing(docs: DataFrame, found: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE,
               remove: float = REMOVE) -> DataFrame:
    """entity, term, drop: the pairs beyond the thresholds."""
    total = docs.count()
    each = found.select("doc_id", "row", "entity", "term", "copies").distinct()
    pairs = each.groupBy("entity", "term").agg(F.sum("copies").alias("both")).where(F.col("both") >= support)
    of_entity = found.select("doc_id", "row", "entity", "copies").distinct().groupBy("entity").agg(
        F.sum("copies").alias("n_entity"))
    rated = pairs.join(of_entity, "entity").join(term_counts(docs).withColumnRenamed("n", "n_term"), "term")
    pmi = F.log2(F.lit(float(total)) * F.col("both") / (F.col("n_entity") * F.greatest("n_term", "both")))
    information = F.log2(F.lit(float(total)) / F.col("n_entity"))
    rated = rated.select("entity", "term", pmi.alias("pmi"), information.alias("ic")).where(
        (F.col("ic") > 0) & (F.col("pmi") >= generalise * F.col("ic")))
    return rated.select("entity", "term", (F.col("pmi") >= remove * F.col("ic")).alias("drop"))


def term_spans(docs: DataFrame, reach: int = REACH, support: int = SUPPORT, generalise: float = GENERALISE,
               remove: float = REMOVE) -> DataFrame:
    """__id, __row, __terms: the places to sanitise in each text that has any, [{first, end, drop}] in order."""
    found = cut(mentions(docs, reach))
    # Rows of equal id and text give equal mentions: one of each is kept, with their number.
    found = found.groupBy("doc_id", "row", "entity", "term", "first", "end").agg(F.count("*").alias("copies"))
    telling = disclosing(docs, found, support, generalise, remove)
    places = found.join(telling, ["entity", "term"]).groupBy("doc_id", "row", "first", "end").agg(F.max("drop").alias("drop"))
    return places.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct("first", "end", "drop"))).alias("__terms")).select(
        F.col("doc_id").alias("__id"), F.col("row").alias("__row"), "__terms")


def _with_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``rows`` (with doc_id and __row) and their terms; null where a text has none."""
    keyed = terms.withColumnRenamed("__row", "__row2")
    on = rows["doc_id"].eqNullSafe(keyed["__id"]) & (rows["__row"] == keyed["__row2"])
    return rows.join(keyed, on, "left").drop("__id", "__row2", "__row")


def scan(docs: DataFrame, **settings) -> DataFrame:
    """Per document: n_email, n_ip, n_card, n_phone, base_sha256, spans (base and term)."""
    kind_of_id = dict(docs.dtypes)["doc_id"]
    terms = term_spans(docs, **settings)

    def run(batches):
        for batch in sliced(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text) if text else []
                said = ",".join(f"{k}:{b}:{e}" for k, b, e in spans)
                rows.append((*(sum(k == s[0] for s in spans) for k in KINDS[:4]),
                             hashlib.sha256(said.encode()).hexdigest(), said))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("__row"), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", "__row", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base"])

    base = docs.select("doc_id", "text", F.xxhash64("text").alias("__row")).mapInArrow(
        run, f"doc_id {kind_of_id}, __row long, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, base string")
    said = F.array_join(F.transform("__terms", lambda t: F.concat_ws(":", F.lit("term"), t["first"], t["end"])), ",")
    joined = _with_terms(base, terms)
    return joined.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.concat_ws(",", F.nullif("base", F.lit("")), said).alias("spans"),
        F.coalesce(F.size("__terms"), F.lit(0)).cast("long").alias("n_term"))


def rewritten(text: str, terms: list[tuple[int, int, bool]]) -> str:
    """Base spans become their token, terms their class or nothing; overlapping spans are one."""
    marks = [(b, e, TOKENS[k]) for k, b, e in base_spans(text)]
    marks += [(b, e, "" if drop else general(text[b:e])) for b, e, drop in terms]
    out, at = [], 0
    for b, e, new in sorted(marks):
        if b >= at:
            out += [text[at:b], new]
        at = max(at, e)
    return "".join([*out, text[at:]])


def clean(docs: DataFrame, **settings) -> DataFrame:
    """The documents with sanitised ``text``; all columns of the input, texts without a span unchanged."""
    terms = term_spans(docs, **settings)
    joined = _with_terms(docs.withColumn("__row", F.xxhash64("text")), terms)

    def run(batches):
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            terms_of = batch.column("__terms").to_pylist()
            new = [t and rewritten(t, [(x["first"], x["end"], x["drop"]) for x in m or []]) for t, m in zip(texts, terms_of)]
            names = [c for c in batch.schema.names if c != "__terms"]
            kind = batch.schema.field("text").type
            yield pa.RecordBatch.from_arrays(
                [pa.array(new, kind) if c == "text" else batch.column(c) for c in names], names=names)

    return joined.mapInArrow(run, docs.schema)
