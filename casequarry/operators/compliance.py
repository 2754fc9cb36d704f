"""Audit, gates, classification and tests around personal-data removal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.functions import pii
from casequarry.functions import text as T
from casequarry.functions.pii_rules import (
    BY_FIELD, CONFIDENTIAL_WORDS, HIGH_RISK_FIELDS, HIGH_RISK_TABLES,
    LEAK, OWN_NAMES, SEQUENTIAL, SIGNATURES, SITES, STAGED, TABLE_RISK, TECH_TERMS, Rule)
from casequarry.operators.sampling import random_rows


def table_risk(table: Column) -> Column:
    tiers = F.create_map(*[F.lit(x) for pair in TABLE_RISK.items() for x in pair])
    return F.coalesce(F.try_element_at(tiers, F.lower(table)), F.lit("UNKNOWN"))


def is_high_risk(table: Column, field: Column) -> Column:
    return (F.coalesce(F.lower(table).isin(HIGH_RISK_TABLES), F.lit(False))
            | F.coalesce(F.lower(field).isin(HIGH_RISK_FIELDS), F.lit(False)))


def remove_in_sequence(df: DataFrame, text: str, table: str = "", field: str = "",
                       counts: str = "hits", classes: str = "unicode") -> DataFrame:
    """One pattern after the other: tags off, common patterns, then signatures
    for e-mail, sites for work orders, own names last; a count per type."""
    out = df.withColumn(text, T.clean_html_if_tagged(F.col(text)))
    rules = list(SEQUENTIAL)
    if table == "EmailMessage" or field in ("textbody", "email_body"):
        rules += SIGNATURES
    if table == "WorkOrder" or field in ("onsite_action", "problem_description"):
        rules += SITES
    return pii.substitute(out, text, [*rules, *OWN_NAMES], counts, field, classes)


def remove_by_field(df: DataFrame, text: str, field: str = "", counts: str = "hits",
                    classes: str = "unicode") -> DataFrame:
    """The inline remover: octet-valid addresses, and serials, sites only in
    the fields they occur in."""
    return pii.substitute(df, text, BY_FIELD, counts, field, classes)


def clean_records(df: DataFrame, fields: Sequence[str], table: str | None = None,
                  rules: Sequence[Rule] = STAGED, merge: str = "reference",
                  classes: str = "unicode") -> DataFrame:
    """Redact many columns; add total count, flag, types and counts per field."""
    out = pii.redact(df, fields, table, rules=rules, merge=merge, classes=classes, keep_spans=True)
    spans = [F.col(f"{f}_pii") for f in fields]
    total = reduce(lambda a, b: a + b, [F.size(s) for s in spans])
    types = F.array_sort(F.array_distinct(F.flatten(F.array(*[
        F.transform(s, lambda x: x["type"]) for s in spans]))))
    per_field = F.map_filter(F.create_map(*[
        x for f, s in zip(fields, spans) for x in (F.lit(f), F.size(s))]), lambda _, n: n > 0)
    return (out.withColumns({"pii_count": total, "pii_removed": total > 0, "pii_types": types,
                             "field_wise_counts": per_field})
            .drop(*[f"{f}_pii" for f in fields]))


def audit_rows(cleaned: DataFrame, case_id: str, case_number: str, processed_at: Column,
               method: str = "regex", operator: str = "casequarry",
               classification: str = "confidential") -> DataFrame:
    """One audit row per cleaned record; the id is stable under re-runs."""
    return cleaned.select(
        F.sha2(F.concat_ws("|", F.col(case_id).cast("string"), processed_at.cast("string")), 256)
        .alias("audit_id"),
        F.col(case_id).cast("string").alias("case_id"),
        F.col(case_number).cast("string").alias("case_number"),
        processed_at.alias("processed_at"), F.col("pii_count").alias("pii_detected_count"),
        "pii_types", "field_wise_counts", F.lit(method).alias("removal_method"),
        F.lit(operator).alias("operator_id"), F.lit(classification).alias("data_classification"),
        F.when(F.col("pii_removed"), "pii_removed").otherwise("none").alias("compliance_flags"))


def compliance_report(audit: DataFrame, start: Column, end: Column) -> DataFrame:
    """Totals of a closed period and records per type, as (item, value) rows."""
    period = audit.filter(F.col("processed_at").between(start, end))
    # One pass: every record counts once under "" and once under each type.
    marked = period.select("pii_detected_count", F.explode(
        F.concat(F.array(F.lit("")), "pii_types")).alias("type"))
    counted = marked.groupBy("type").agg(
        F.count("*").alias("total_records"), F.sum("pii_detected_count").alias("total_pii_detected"),
        F.count_if(F.col("pii_detected_count") > 0).alias("records_with_pii"))

    def item(name: Column, value: str) -> Column:
        return F.struct(name.alias("item"), F.col(value).cast("bigint").alias("value"))
    return counted.select(F.inline(F.when(F.col("type") == "", F.array(*[
        item(F.lit(c), c) for c in ("total_records", "total_pii_detected", "records_with_pii")])
    ).otherwise(F.array(item(F.concat(F.lit("type:"), "type"), "total_records")))))


def detection_totals(df: DataFrame, spans: str, groups: Sequence[str] = ()) -> DataFrame:
    """Hits and texts per group, type and stage."""
    return (df.select(*groups, F.monotonically_increasing_id().alias("__row"),
                      F.explode(spans).alias("s"))
            .groupBy(*groups, F.col("s.type").alias("type"), F.col("s.stage").alias("stage"))
            .agg(F.count("*").alias("hits")))


def detection_statistics(df: DataFrame, table: str, spans: str) -> DataFrame:
    """Per table: share of rows with personal data and mean hits per row."""
    n = F.size(spans)
    return df.groupBy(table).agg(
        F.count("*").alias("rows"), F.avg(F.when(n > 0, 1.0).otherwise(0.0)).alias("share_with_pii"),
        F.avg(n).alias("mean_per_row"))


def type_shares(df: DataFrame, spans: str) -> DataFrame:
    """Share of all hits by type; the total is a one-row scalar."""
    counts = df.select(F.explode(spans).alias("s")).groupBy(F.col("s.type").alias("type")).agg(
        F.count("*").alias("hits"))
    total = counts.agg(F.sum("hits")).scalar()
    return counts.withColumn("share", F.col("hits") / total)


def leak_split(df: DataFrame, text: str, rules: Sequence[Rule] = LEAK,
               classes: str = "unicode") -> tuple[DataFrame, DataFrame]:
    """(clean rows, rows for review)."""
    flagged = df.withColumn("__leak", pii.has_pii(F.col(text), rules, classes))
    return (flagged.filter(~F.col("__leak")).drop("__leak"),
            flagged.filter(F.col("__leak")).drop("__leak"))


def zero_leak_scan(df: DataFrame, key: str, text: str, sample: int | None = None, seed: int = 42,
                   rules: Sequence[Rule] = STAGED, classes: str = "unicode") -> DataFrame:
    """Scanned rows, leaking rows and verdict; all rows unless a sample size is
    asked for."""
    rows = df if sample is None else random_rows(df, key, sample, seed)
    return rows.select(pii.has_pii(F.col(text), rules, classes).alias("leak")).agg(
        F.count("*").alias("scanned"), F.count_if("leak").alias("leaks")
    ).withColumn("verdict", F.when(F.col("leaks") == 0, "PASS").otherwise("FAIL"))


def failure_gate(df: DataFrame, failed: Column, most: float = 0.05) -> DataFrame:
    """One row with the failure rate; running it fails above the limit."""
    rate = df.agg(F.avg(F.when(failed, 1.0).otherwise(0.0)).alias("failure_rate"))
    stop = F.raise_error(F.concat(F.lit("failure rate "), F.col("failure_rate").cast("string"),
                                  F.lit(f" is above {most}"))).cast("double")
    return rate.select(F.when(F.col("failure_rate") > most, stop)
                       .otherwise(F.col("failure_rate")).alias("failure_rate"))


# Obfuscated texts and the types a detector should report.
RED_TEAM = [
    ("Obfuscated email", "Contact john[dot]doe[at]hpe[dot]com for support", ["email"]),
    ("Phone with letters", "Call 1-800-CALL-HPE for assistance", ["phone"]),
    ("Partial email", "Email sent to j***@hpe.com", ["email"]),
    ("IP in different format", "Server at 192[.]168[.]1[.]1 is down", ["ip"]),
    ("Name in username", "User john.doe logged in", ["person_name"]),
    ("Encoded email", "Contact am9obkBocGUuY29t", ["email"]),
]


def red_team(cases: DataFrame, rules: Sequence[Rule] = STAGED, prepare: bool = False) -> DataFrame:
    """PASS when every expected type is part of a detected type's name.
    ``prepare`` undoes the known obfuscations first. Columns in:
    description, text, expected."""
    text = F.col("text")
    if prepare:
        text = F.concat_ws(" ", pii.phone_letters(pii.deobfuscate(text)),
                           F.array_join(pii.decoded_tokens(F.col("text")), " "))
    spans = cases.withColumn("__t", text).withColumn(
        "__s", pii.merge_spans(pii.all_spans(F.col("__t"), rules=rules)))
    types = F.transform("__s", lambda s: F.lower(s["type"]))
    found = spans.withColumn("detected", types)
    passed = F.forall("expected", lambda e: F.exists("detected", lambda d: F.contains(d, F.lower(e))))
    return found.withColumn("status", F.when(passed, "PASS").otherwise("FAIL")).drop("__t", "__s")


def detection_rates(df: DataFrame, found: Column, labelled: Column) -> DataFrame:
    """Detection rate over texts with personal data, false-positive rate over
    the rest."""
    return df.agg(
        F.count("*").alias("texts"),
        F.avg(F.when(labelled, F.when(found, 1.0).otherwise(0.0))).alias("detection_rate"),
        F.avg(F.when(~labelled, F.when(found, 1.0).otherwise(0.0))).alias("false_positive_rate"))


def sensitivity(subject: Column, description: Column, has_pii: Column, strict: bool = False) -> Column:
    """INTERNAL, RESTRICTED with personal data, CONFIDENTIAL with a keyword. A
    keyword overrides RESTRICTED unless ``strict``."""
    both = F.lower(F.concat_ws(" ", F.coalesce(subject, F.lit("")), F.coalesce(description, F.lit(""))))
    keyword = both.rlike("|".join(CONFIDENTIAL_WORDS))
    if strict:
        return F.when(has_pii, "RESTRICTED").when(keyword, "CONFIDENTIAL").otherwise("INTERNAL")
    return F.when(keyword, "CONFIDENTIAL").when(has_pii, "RESTRICTED").otherwise("INTERNAL")


def data_labels(classification: Column, removed: Column, owner: str, tags: Sequence[str]) -> dict[str, Column]:
    return {
        "data_classification": classification,
        "pii_status": F.when(removed, "removed").otherwise("none_detected"),
        "encryption_required": classification.isin("CONFIDENTIAL", "RESTRICTED"),
        "retention_period_days": F.when(classification == "RESTRICTED", 2555).otherwise(3650),
        "data_owner": F.lit(owner),
        "compliance_tags": F.array(*[F.lit(x) for x in tags]),
    }


# A name is less sure than any pattern; its number sorts it behind them.
NAME_CONFIDENCE, NAME_RULE = 0.7, 1000
NAME = r"\b\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)+\b"


def person_names(df: DataFrame, key: str, text: str, names: DataFrame, name: str,
                 classes: str = "unicode") -> DataFrame:
    """Capitalised runs of two or more words that start with a known given
    name and hold no product word: one row per place in a text, as detections
    are. The gazetteer is joined on the first word."""
    rule = pii.Rule("PERSON_NAME", NAME, NAME_CONFIDENCE, "names")
    spans = df.select(key, F.explode(pii.rule_spans(F.col(text), rule, NAME_RULE, classes)).alias("span"))
    plausible = spans.filter(~F.lower("span.text").rlike("|".join(t.lower() for t in TECH_TERMS)))
    first = F.lower(F.split_part("span.text", F.lit(" "), F.lit(1)))
    known = names.select(F.lower(F.col(name)).alias("__first")).distinct()
    return (plausible.withColumn("__first", first).join(known, "__first", "left_semi")
            .select(key, F.col("span.text").alias("person"), F.col("span.start").alias("start"),
                    F.col("span.end").alias("end"), "span"))


def redact_names(df: DataFrame, key: str, text: str, names: DataFrame, name: str, table: str | None = None,
                 rules: Sequence[pii.Rule] = (), merge: str = "reference", classes: str = "unicode",
                 tokens: dict[str, str] | None = None) -> DataFrame:
    """``text`` with person names, and what ``rules`` find, redacted together.
    ``key`` is unique. Names are joined by key; rules alone need no shuffle."""
    found = person_names(df, key, text, names, name, classes).groupBy(key).agg(
        F.collect_list("span").alias("__names"))
    none = F.array().cast(pii.SPANS)
    ruled = pii.all_spans(F.col(text), F.col(table) if table else None, None, rules, classes) if rules else none
    spans = pii.merge_spans(F.concat(ruled, F.coalesce("__names", none)), merge)
    return df.join(found, key, "left").withColumn("__names", spans).withColumn(
        text, pii.redact_spans(F.col(text), F.col("__names"), tokens)).select(*df.columns)
