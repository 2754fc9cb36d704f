"""Text preparation as Column expressions; only entity decoding and Unicode
normalisation need Python, and see only the rows that can change."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Entity order of the first cleaner, limits and markers.
ENTITIES = [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"')]
MAX_CHARS = 30000
TRUNCATED = "\n\n[...TRUNCATED...]\n\n"
TRUNCATED_HEAD = "\n\n[... TRUNCATED DUE TO LENGTH ...]"
TRUNCATED_SECTIONS = "\n\n[... TROUBLESHOOTING STEPS AND COMMENTS TRUNCATED ...]"
ESSENTIAL_SECTIONS = ["ISSUE", "RESOLUTION", "METADATA"]
MODEL_NUMBERS = r"(Gen\d+|DL\d+|ML\d+|BL\d+)"
# Own choice, identical in Java and RE2.
NOT_TOKEN = r"[^\p{L}\p{N}_]+"


def present(c: Column) -> Column:
    """Null and the empty string count as absent; blanks do not."""
    return c.isNotNull() & (c != "")


# White space as Python has it: the Unicode property and four separators more.
BLANKS = r"[\s\x1c-\x1f]+"


def strip(c: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(c, rf"(?U)\A{BLANKS}|{BLANKS}\z", "")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, rf"(?U){BLANKS}", " "))


def clean_html(c: Column) -> Column:
    """Drop tags, decode five entities in order, squeeze white space."""
    text = F.regexp_replace(c, "<[^>]+>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return squeeze(text)


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    from html import unescape
    return texts.map(unescape, na_action="ignore")


@F.pandas_udf(StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFC")


def unescape_html(c: Column) -> Column:
    """All named and numeric entities; rows without ``&`` send a null to Python."""
    return F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)


def clean_html_unescaped(c: Column) -> Column:
    """Decode every entity first, then drop tags: coded tags vanish too."""
    return squeeze(F.regexp_replace(unescape_html(c), "<[^>]+>", ""))


def clean_html_if_tagged(c: Column) -> Column:
    tagged = F.contains(c, F.lit("<")) & F.contains(c, F.lit(">"))
    return F.when(tagged, clean_html(c)).otherwise(c)


def normalize_unicode(c: Column) -> Column:
    """NFC; pure ASCII rows send a null to Python."""
    return F.coalesce(_nfc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def standardize(c: Column, case: str = "keep") -> Column:
    """Trim, fix letter case, and turn blank values into null."""
    trimmed = strip(c)
    cased = {"keep": lambda x: x, "upper": F.upper, "lower": F.lower,
             "title": F.initcap}[case](trimmed)
    return F.nullif(cased, F.lit(""))


def smart_truncate(c: Column, limit: int = MAX_CHARS) -> Column:
    """Head 80 % + marker + tail 20 %, cut to ``limit``: the marker's length is
    lost at the end."""
    head, tail = int(limit * 0.8), int(limit * 0.2)
    cut = F.left(F.concat(F.left(c, F.lit(head)), F.lit(TRUNCATED), F.right(c, F.lit(tail))),
                 F.lit(limit))
    return F.when(F.length(c) > limit, cut).otherwise(c)


def head_truncate(c: Column, limit: int = MAX_CHARS) -> Column:
    return F.when(F.length(c) > limit,
                  F.concat(F.left(c, F.lit(limit)), F.lit(TRUNCATED_HEAD))).otherwise(c)


def section_truncate(c: Column, limit: int = MAX_CHARS) -> Column:
    """Keep the essential ``=== NAME ===`` sections, then add the others in
    order while they fit; a marker replaces the first one that does not.
    Text before the first header belongs to no section."""
    parts = F.split(c, r"\n(?=[^\n]*===)", -1)
    named = F.transform(parts, lambda p: F.struct(
        F.btrim(F.split_part(p, F.lit("\n"), F.lit(1)), F.lit("= ")).alias("name"),
        F.contains(F.split_part(p, F.lit("\n"), F.lit(1)), F.lit("===")).alias("headed"),
        p.alias("text")))
    sections = F.filter(named, lambda s: s["headed"] & (s["name"] != ""))
    essential = F.array_join(F.transform(
        F.filter(sections, lambda s: s["name"].isin(ESSENTIAL_SECTIONS)), lambda s: s["text"]),
        "\n\n")
    folded = F.aggregate(
        F.filter(sections, lambda s: ~s["name"].isin(ESSENTIAL_SECTIONS)),
        F.struct(essential.alias("text"), F.lit(False).alias("full")),
        lambda acc, s: F.when(acc["full"], acc).otherwise(F.when(
            F.length(acc["text"]) + F.length(s["text"]) < limit,
            F.struct(F.concat(acc["text"], F.lit("\n\n"), s["text"]).alias("text"),
                     F.lit(False).alias("full"))
        ).otherwise(F.struct(F.concat(acc["text"], F.lit(TRUNCATED_SECTIONS)).alias("text"),
                             F.lit(True).alias("full")))),
        lambda acc: acc["text"])
    return F.when(F.length(c) > limit, folded).otherwise(c)


def join_present(columns: Sequence[Column], separator: str = " | ", keep_empty: bool = False) -> Column:
    """Join pieces; ``keep_empty`` keeps an empty piece for every null."""
    if keep_empty:
        return F.concat_ws(separator, *[F.coalesce(c, F.lit("")) for c in columns])
    return F.concat_ws(separator, *[F.nullif(c, F.lit("")) for c in columns])


def text_key(c: Column) -> Column:
    return F.sha2(c, 256)


def simplify_to_user_query(title: Column) -> Column:
    """Formal title to user query: model numbers and punctuation go."""
    bare = F.regexp_replace(title, MODEL_NUMBERS, "")
    return squeeze(F.lower(F.regexp_replace(bare, r"(?U)[^\w\s]", " ")))


def preview(c: Column, n: int = 200) -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("..."))).otherwise(c)


def highlights(query: Column, fields: Sequence[Column], before: int = 50, after: int = 100,
               keep: int = 3) -> Column:
    """For each query word found in each field: the text around the first hit."""
    words = F.filter(F.split(F.lower(query), r"\s+"), lambda w: w != "")

    def around(text: Column) -> Column:
        low = F.lower(text)
        found = F.filter(words, lambda w: F.contains(low, w))
        def snippet(word: Column) -> Column:
            at = F.position(word, low) - 1
            start = F.greatest(F.lit(0), at - before)
            return F.concat(F.lit("..."), F.substring(text, start + 1, at + after - start),
                            F.lit("..."))
        return F.transform(found, snippet)
    none = F.array().cast("array<string>")
    return F.slice(F.flatten(F.array(*[F.coalesce(around(f), none) for f in fields])), 1, keep)


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), NOT_TOKEN), lambda t: t != "")


def length_class(c: Column, closed: str = "left") -> Column:
    """simple / moderate / complex by characters; ``closed='right'`` puts the
    bounds 200 and 800 into the lower class."""
    n = F.length(c)
    small, medium = (n < 200, n < 800) if closed == "left" else (n <= 200, n <= 800)
    return F.when(small, "simple").when(medium, "moderate").otherwise("complex")


def query_length_bucket(c: Column) -> Column:
    return F.when(F.length(c) < 20, "short").when(F.length(c) < 50, "medium").otherwise("long")


def query_is_valid(c: Column, least: int = 3) -> Column:
    return c.isNotNull() & (F.length(strip(c)) >= least)


def effective_limit(limit: Column, most: int = 50) -> Column:
    return F.least(limit, F.lit(most))
