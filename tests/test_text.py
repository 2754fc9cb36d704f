import pytest
from conftest import one
from pyspark.sql import functions as F

from casequarry.functions import text as T


def lit(x):
    return F.lit(x).cast("string")


@pytest.mark.parametrize("given, wanted", [
    ("<p>DIMM <strong>replaced</strong></p>", "DIMM replaced"),
    ("a&nbsp;&nbsp;b &amp;lt; c", "a b < c"),
    ("&lt;b&gt;kept&lt;/b&gt;", "<b>kept</b>"),
    ("  \n\t ", ""), ("<p></p>", ""), (None, None)])
def test_clean_html(spark, given, wanted):
    assert one(spark, T.clean_html(lit(given))) == wanted


def test_unescape_first_drops_coded_tags(spark):
    assert one(spark, T.clean_html_unescaped(lit("&lt;b&gt;gone&lt;/b&gt; caf&eacute; &#8364;"))) == "gone café €"


def test_smart_truncate_loses_marker_length_at_the_end(spark):
    text = "A" * 30000 + "B" * 5000
    got = one(spark, T.smart_truncate(lit(text)))
    full = text[:24000] + "\n\n[...TRUNCATED...]\n\n" + text[-6000:]
    assert got == full[:30000] and len(got) == 30000
    assert one(spark, T.smart_truncate(lit("A" * 30000))) == "A" * 30000


def test_section_truncate(spark):
    text = "lost\n=== ISSUE ===\nabc\n=== STEPS ===\n" + "z" * 100 + "\n=== NOTES ===\nn\n=== RESOLUTION ===\nq"
    got = one(spark, T.section_truncate(lit(text), 90))
    assert got == ("=== ISSUE ===\nabc\n\n=== RESOLUTION ===\nq"
                   "\n\n[... TROUBLESHOOTING STEPS AND COMMENTS TRUNCATED ...]")
    got = one(spark, T.section_truncate(lit(text), 165))
    assert "z" * 100 in got and "NOTES" not in got.split("TRUNCATED")[0] or "=== NOTES ===" in got
    assert one(spark, T.section_truncate(lit("short"), 90)) == "short"


def test_simplify(spark):
    title = "ProLiant DL380 Gen10 - POST Error Code 1796"
    assert one(spark, T.simplify_to_user_query(lit(title))) == "proliant post error code 1796"


def test_highlights(spark):
    text = "x" * 60 + " Memory error " + "y" * 200
    got = one(spark, T.highlights(lit("memory absent ERROR"), [lit(text), lit(None)]))
    low = text.lower()
    wanted = []
    for word in ("memory", "error"):
        at = low.index(word)
        wanted.append("..." + text[max(0, at - 50):min(len(text), at + 100)] + "...")
    assert got == wanted


def test_length_classes(spark):
    for n, left, right in ((199, "simple", "simple"), (200, "moderate", "simple"),
                           (800, "complex", "moderate"), (801, "complex", "complex")):
        assert one(spark, T.length_class(lit("a" * n))) == left
        assert one(spark, T.length_class(lit("a" * n), "right")) == right


def test_join_present(spark):
    pieces = [lit("a"), lit(None), lit(""), lit("b")]
    assert one(spark, T.join_present(pieces)) == "a | b"
    assert one(spark, T.join_present(pieces, keep_empty=True)) == "a |  |  | b"


def test_normalize_and_standardize(spark):
    assert one(spark, T.normalize_unicode(lit("café"))) == "café"
    assert one(spark, T.standardize(lit("  "), "upper")) is None
    assert one(spark, T.standardize(lit(" ab "), "upper")) == "AB"
