"""Detections as a table function of SQL.

``register`` makes a temporary SQL function that gives one row per detection of a
text, for use with LATERAL in plain SQL:

    SELECT doc_id, d.* FROM documents, LATERAL pii_detections(text, source) d

Its body is SQL made from the same Column expression that the DataFrame API uses, so
it stays inside the JVM and both forms cannot drift apart. A function lasts as long
as its session.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession, functions as F

from casequarry.functions import pii
from casequarry.functions.pii_rules import STAGED, Rule

_STRING_OR_OPERATOR = re.compile(r"('(?:[^'\\]|\\.)*'|`[^`]*`)|([=+\-*/<>!&|%^~]+)\(", re.S)
NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def sql_text(column: Column) -> str:
    """A Column as SQL that Spark parses to the same expression.

    Spark prints operators as functions, ``+(a, b)``; their names are quoted here. Texts
    in quotes stay as they are.
    """
    return _STRING_OR_OPERATOR.sub(lambda m: m[1] or f"`{m[2]}`(", column._jc.node().sql())


def register(spark: SparkSession, name: str = "pii_detections", rules: Sequence[Rule] = STAGED, merge: str = "reference",
             classes: str = "unicode") -> str:
    """Create ``name(body STRING, origin STRING)``: type, text, start, end, confidence, stage of each merged detection.

    ``origin`` is the table or field name that rules may depend on. A null body has no detections. Gives the name back.
    """
    if not NAME.fullmatch(name):
        raise ValueError(f"{name} is no function name")
    spans = pii.detections(pii.merge_spans(pii.all_spans(F.col("body"), F.col("origin"), None, rules, classes), merge))
    kind = spark.createDataFrame([], "body string, origin string").select(F.explode(spans).alias("d")).select("d.*").schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.fields)
    named = ", ".join(f"d.`{f.name}`" for f in kind.fields)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(body STRING, origin STRING) RETURNS TABLE ({columns}) "
              f"RETURN SELECT {named} FROM (SELECT explode({sql_text(spans)}) AS d)")
    return name
