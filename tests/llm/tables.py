import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=False):
    """A documents table of (doc_id, text); with columns whose names clash with the operators' own ones if asked for."""
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    if not extra:
        return spark.createDataFrame(full, DOC)
    clash = ", part int, bucket int, body string, fp string, score string, predicted string, row string, piece string, terms string"
    return spark.createDataFrame([(*r, 1, 2, "b", "f", "s", "p", "r", "q", "t") for r in full], DOC + clash)


@pytest.fixture
def docs(spark):
    return lambda rows, extra=False: documents(spark, rows, extra)
