"""Parent and child assembly.

Children are reduced per case before the join, so rows never multiply: a case is
one row at any size. The long form and composite text never gather a case.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casequarry.functions import text as T
from casequarry.skew import salt_of, salts, top_n


@dataclass
class Child:
    """A child table: ``fields`` maps output names to columns; rows are ordered
    by ``position`` and then by ``tie``."""
    name: str
    rows: DataFrame
    key: str
    fields: dict[str, Column]
    position: Column = field(default_factory=lambda: F.lit(0))
    tie: Column | None = None

    def prepared(self) -> DataFrame:
        record = F.struct(*[c.alias(n) for n, c in self.fields.items()])
        tie = self.tie if self.tie is not None else F.xxhash64(*self.fields.values())
        return self.rows.filter(F.col(self.key).isNotNull()).select(
            F.col(self.key).alias("__key"), self.position.cast("double").alias("__pos"),
            tie.cast("string").alias("__tie"), record.alias("__rec"))


def child_totals(children: Sequence[Child]) -> DataFrame:
    """One row per parent key with the number of rows in each child table.
    A single aggregate over the keys alone; map tasks add up first."""
    tagged = reduce(DataFrame.unionByName, [
        c.rows.filter(F.col(c.key).isNotNull()).select(
            F.col(c.key).alias("__key"), F.lit(c.name).alias("__child")) for c in children])
    return tagged.groupBy("__key").agg(*[
        F.count_if(F.col("__child") == c.name).alias(f"__n_{c.name}") for c in children])


def child_rows(cases: DataFrame, case_id: str, children: Sequence[Child]) -> DataFrame:
    """The children of all cases in long form: case, child, place, record (as
    JSON), one row each. No case is gathered, whatever its size."""
    long = reduce(DataFrame.unionByName, [
        c.prepared().select(F.col("__key").alias(case_id), F.lit(c.name).alias("child"),
                            F.struct(F.col("__pos").alias("position"), F.col("__tie").alias("tie")).alias("place"),
                            F.to_json("__rec").alias("record")) for c in children])
    return long.join(cases.select(case_id).distinct(), case_id, "left_semi")


def assemble(cases: DataFrame, case_id: str, children: Sequence[Child]) -> DataFrame:
    """Every case, one row each, with its children as ordered arrays and counts.

    A case is one value here; where that must not be, take ``child_rows`` or,
    for text, ``composite_texts``. Output: the case columns, one array per child
    and one ``<child>_count`` each.
    """
    names = [c.name for c in children]
    parents = cases
    for child in children:
        packed = child.prepared().groupBy("__key").agg(
            F.array_sort(F.collect_list(F.struct("__pos", "__tie", "__rec"))).alias("__arr"))
        packed = packed.select(F.col("__key").alias(case_id),
                               F.transform("__arr", lambda x: x["__rec"]).alias(child.name))
        parents = parents.join(packed, case_id, "left")
    return parents.select(
        *cases.columns,
        *[F.coalesce(F.col(n), F.array().cast(parents.schema[n].dataType)).alias(n) for n in names],
        *[F.coalesce(F.size(F.col(n)), F.lit(0)).alias(f"{n}_count") for n in names])


def child_counts(cases: DataFrame, case_id: str, children: Sequence[Child]) -> DataFrame:
    """Child counts per case, zero for none, without building any array."""
    totals = child_totals(children).withColumnRenamed("__key", case_id)
    return cases.select(case_id).join(totals, case_id, "left").select(
        case_id, *[F.coalesce(F.col(f"__n_{c.name}"), F.lit(0)).alias(f"{c.name}_count")
                   for c in children])


def join_coverage(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Share of cases with at least one child, and mean children per case."""
    aggregates = [F.count("*").alias("total_cases")]
    for n in names:
        c = F.col(f"{n}_count")
        aggregates += [F.count_if(c > 0).alias(f"cases_with_{n}"),
                       F.avg(F.when(c > 0, 1.0).otherwise(0.0)).alias(f"{n}_coverage"),
                       F.avg(c).alias(f"avg_{n}")]
    return counts.agg(*aggregates)


# Lowest accepted coverage per child table.
COVERAGE_FLOORS = {"tasks": 0.70, "workorders": 0.70, "casecomments": 0.50}


def coverage_flags(coverage: DataFrame, floors: dict[str, float] = COVERAGE_FLOORS) -> DataFrame:
    """One row per table: coverage, mean children, floor, and whether it is too
    low."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("table"), F.col(f"{n}_coverage").alias("coverage"),
                 F.col(f"avg_{n}").alias("mean_children"), F.lit(float(v)).alias("floor"))
        for n, v in floors.items()]))
    return coverage.select(rows.alias("r")).select("r.*").withColumn(
        "low", F.col("coverage") < F.col("floor"))


def latest_children(child: DataFrame, key: str, when: str, n: int = 3,
                    tiebreak: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows per parent, rank 1 = newest."""
    order = [F.desc(when), *[F.asc(t) for t in tiebreak]]
    return top_n(child.filter(F.col(key).isNotNull()), [key], order, n,
                 tiebreak=[when, *tiebreak])


def two_hop(feeds: DataFrame, feed_key: str, middle: DataFrame, middle_id: str,
            middle_key: str) -> DataFrame:
    """Feeds with the case of their work order: feed -> work order -> case."""
    bridge = middle.select(F.col(middle_id).alias("__mid"), F.col(middle_key).alias("case_key"))
    return feeds.join(bridge, feeds[feed_key] == bridge["__mid"]).drop("__mid")


def for_parents(child: DataFrame, key: str, parents: DataFrame, parent_id: str) -> DataFrame:
    """Child rows whose parent is in the given set."""
    return child.join(parents.select(F.col(parent_id).alias(key)), key, "left_semi")


def lookup(cases: DataFrame, column: str, *values) -> DataFrame:
    """Rows by case number or id; the filter reaches the scan."""
    return cases.filter(F.col(column).isin(*values))


def presence(expected: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """How many expected ids are stored, and the success rate."""
    flagged = expected.select(key).join(
        stored.select(key).distinct().withColumn("__found", F.lit(True)), key, "left")
    return flagged.agg(
        F.count("*").alias("total_expected"), F.count("__found").alias("found"),
        F.count_if(F.col("__found").isNull()).alias("missing"),
        F.try_divide(F.count("__found"), F.count("*")).alias("success_rate"))


def missing_ids(expected: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    return expected.select(key).join(stored.select(key), key, "left_anti")


# -- composite text ----------------------------------------------------------

# Section labels and their field order.
SECTIONS = ["", "ISSUE: ", "ENVIRONMENT: ", "RESOLUTION: ", "TASKS: ", "WORK ORDERS: ",
            "COMMENTS: ", "SERVICE NOTES: ", "EMAILS: "]
ISSUE_FIELDS = ["description", "error_codes", "issue_plain_text", "cause_plain_text"]
ENVIRONMENT_FIELDS = ["environment", "product_type", "product_line", "category", "sub_category"]
RESOLUTION_FIELDS = ["resolution", "resolution_code", "resolution_plain_text", "root_cause"]
CHILD_SECTIONS = {"tasks": (4, ["description"]), "workorders": (5, ["subject", "description"]),
                  "casecomments": (6, ["commentBody"]), "workorderfeeds": (7, ["body"]),
                  "emails": (8, ["subject", "textBody"])}
JOINER, BREAK = " | ", "\n\n"


def _maybe(columns: Sequence[str], name: str) -> Column:
    return F.col(name) if name in columns else F.lit(None).cast("string")


def header_text(columns: Sequence[str]) -> Column:
    def labelled(name: str, label: str) -> Column:
        c = _maybe(columns, name).cast("string")
        return F.when(T.present(c), F.concat(F.lit(label), c))
    return F.concat_ws(JOINER, labelled("caseNumber", "Case: "), labelled("subject", ""),
                       labelled("priority", "Priority: "), labelled("status", "Status: "))


def composite_text(columns: Sequence[str]) -> Column:
    """Nine-section text of one assembled row, untruncated. For rows whose
    child arrays are bounded; ``composite_texts`` takes any size."""
    def part(c: Column, clean: bool = True) -> Column:
        c = c.cast("string")
        return F.when(T.present(c), T.clean_html(c) if clean else c)

    def labelled(label: str, pieces: Column) -> Column:
        kept = F.array_compact(pieces)
        return F.when(F.size(kept) > 0, F.concat(F.lit(label), F.array_join(kept, JOINER)))

    def from_case(names: Sequence[str], clean: bool = True) -> Column:
        return F.array(*[part(_maybe(columns, n), clean) for n in names])

    def from_children(name: str, fields: Sequence[str]) -> Column:
        return F.flatten(F.transform(
            F.col(name), lambda r: F.array(*[part(r[f]) for f in fields])))

    sections = [header_text(columns),
                labelled(SECTIONS[1], from_case(ISSUE_FIELDS)),
                labelled(SECTIONS[2], from_case(ENVIRONMENT_FIELDS, clean=False)),
                labelled(SECTIONS[3], from_case(RESOLUTION_FIELDS))]
    for name, (number, fields) in CHILD_SECTIONS.items():
        if name in columns:
            sections.append(labelled(SECTIONS[number], from_children(name, fields)))
    return F.concat_ws(BREAK, *sections)


def _case_pieces(cases: DataFrame, case_id: str) -> DataFrame:
    have = cases.columns

    def piece(section: int, sub: int, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(sub).alias("sub"),
                        value.alias("text"))
    pieces = [piece(0, 0, header_text(have))]
    for section, names, clean in ((1, ISSUE_FIELDS, True), (2, ENVIRONMENT_FIELDS, False),
                                  (3, RESOLUTION_FIELDS, True)):
        for sub, name in enumerate(names):
            if name in have:
                value = F.col(name).cast("string")
                pieces.append(piece(section, sub, F.when(
                    T.present(value), T.clean_html(value) if clean else value)))
    return (cases.select(F.col(case_id).alias("id"), F.explode(F.array(*pieces)).alias("p"))
            .filter(F.col("p.text").isNotNull())
            .select("id", "p.section", F.lit(0.0).alias("pos"), F.lit("").alias("tie"),
                    "p.sub", "p.text"))


def _child_pieces(child: Child) -> DataFrame:
    section, fields = CHILD_SECTIONS[child.name]
    pieces = F.array(*[F.struct(F.lit(i).alias("sub"), F.col(f"__rec.{f}").cast("string").alias("text"))
                       for i, f in enumerate(fields)])
    return (child.prepared().withColumn("p", F.explode(pieces)).filter(T.present(F.col("p.text")))
            .select(F.col("__key").alias("id"), F.lit(section).alias("section"),
                    F.col("__pos").alias("pos"), F.col("__tie").alias("tie"), "p.sub",
                    T.clean_html(F.col("p.text")).alias("text")))


def composite_texts(cases: DataFrame, case_id: str, children: Sequence[Child],
                    limit: int = T.MAX_CHARS) -> DataFrame:
    """Truncated nine-section text per case, exact for any number of children.

    Only the first ``limit`` characters and the last 20 % of the untruncated
    text can appear in the result. Character sums are taken per (case, salt)
    first, and a piece that already has ``limit`` characters before it and
    20 % after it within its own salt is left out, so what meets in a case's
    final group is bounded, whatever the number of its children. The first
    piece of each section carries the length of the ones left out. Two
    shuffles, one scan.
    """
    head_chars, tail_chars = int(limit * 0.8), int(limit * 0.2)
    rows = reduce(DataFrame.unionByName,
                  [_case_pieces(cases, case_id), *[_child_pieces(c) for c in children]])
    rows = rows.select(
        "id", "section", "pos", "tie", "sub", F.length("text").alias("len"),
        F.left("text", F.lit(limit)).alias("front"),
        F.when(F.length("text") > limit, F.right("text", F.lit(tail_chars))).alias("back"),
        salt_of([F.col("section"), F.col("pos"), F.col("tie"), F.col("sub")],
                salts(cases.sparkSession)).alias("salt"))

    def running(window):
        return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    order = ["section", "pos", "tie", "sub"]
    in_salt = Window.partitionBy("id", "salt")
    in_section = Window.partitionBy("id", "salt", "section")
    least = F.col("len") + F.when(F.col("section") == 0, 0).otherwise(len(JOINER))
    local = (rows.withColumn("w", least)
             .withColumn("upto", F.sum("w").over(running(in_salt.orderBy(*order))))
             .withColumn("sr", F.row_number().over(in_section.orderBy(*order[1:])))
             .withColumn("joined", F.sum(F.col("len") + len(JOINER)).over(in_section))
             .withColumn("rest", F.sum("w").over(in_salt) - F.col("upto"))
             .filter((F.col("upto") - F.col("w") <= limit) | (F.col("sr") == 1)
                     | (F.col("rest") < tail_chars))
             .withColumn("joined", F.when(F.col("sr") == 1, F.col("joined")).otherwise(0)))

    labels = F.create_map(*[x for i, label in enumerate(SECTIONS) for x in (
        F.lit(i), F.lit(label if i == 0 else BREAK + label))])
    whole = Window.partitionBy("id")
    ordered = whole.orderBy(*order)
    prefix = F.when(F.col("sr") == 1, F.element_at(labels, F.col("section"))).otherwise(JOINER)
    merged = (local
              .withColumn("r", F.row_number().over(ordered))
              .withColumn("sr", F.row_number().over(
                  Window.partitionBy("id", "section").orderBy(*order[1:])))
              .withColumn("prefix", prefix)
              .withColumn("total", F.sum(F.col("joined") + F.when(
                  F.col("sr") == 1, F.length("prefix") - len(JOINER)).otherwise(0)).over(whole))
              .withColumn("size", F.length("prefix") + F.col("len"))
              .withColumn("before", F.sum("size").over(running(ordered)) - F.col("size"))
              .withColumn("after", F.sum("size").over(whole) - F.col("before") - F.col("size")))
    fits = F.col("total") <= limit
    front = F.when(F.col("before") < F.when(fits, limit + 1).otherwise(head_chars),
                   F.struct("r", F.concat("prefix", "front").alias("t")))
    back = F.when(~fits & (F.col("after") < tail_chars),
                  F.struct("r", F.concat(F.col("prefix"), F.coalesce("back", "front")).alias("t")))

    def joined(name: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.col(name)), lambda x: x["t"]), "")

    return (merged.groupBy("id")
            .agg(F.first("total").alias("full_length"), F.collect_list(front).alias("h"),
                 F.collect_list(back).alias("t"), F.min("section").alias("s"))
            .filter(F.col("s") == 0)  # the header; children without a case have none
            .select(
                F.col("id").alias(case_id), "full_length",
                (F.col("full_length") > limit).alias("was_truncated"),
                F.when(F.col("full_length") <= limit, joined("h")).otherwise(F.left(F.concat(
                    F.left(joined("h"), F.lit(head_chars)), F.lit(T.TRUNCATED),
                    F.right(joined("t"), F.lit(tail_chars))), F.lit(limit))).alias("compositeText")))


# Words that mark the sections of a composite text.
SECTION_WORDS = ["ISSUE", "RESOLUTION", "ENVIRONMENT", "TASKS", "WORK ORDERS", "COMMENTS",
                 "SERVICE NOTES", "EMAILS"]


def composite_checks(text: Column, tasks: Column, workorders: Column) -> Column:
    """Structure of a composite text: number of sections, how many of them
    hold each section word, and the readiness rules that fail. The text and its
    sections are bound to lambda variables, so each is made once a row."""
    def checked(x: Column) -> Column:
        words = F.create_map(*[y for w in SECTION_WORDS for y in (
            F.lit(w), F.size(F.filter(x["sections"], _has(w))))])
        rules = [(F.length(x["text"]) > 0, "not empty"), (F.length(x["text"]) <= T.MAX_CHARS, "within limit"),
                 (F.contains(x["upper"], F.lit("ISSUE")) | F.contains(x["text"], F.lit("Description")), "issue present"),
                 (F.contains(x["upper"], F.lit("RESOLUTION")), "resolution present"),
                 ((x["tasks"] > 0) | (x["workorders"] > 0), "children attached")]
        failed = F.array_compact(F.array(*[
            F.when(~F.coalesce(ok, F.lit(False)), name) for ok, name in rules]))
        return _once(failed, lambda f: F.struct(F.size(x["sections"]).alias("sections"), words.alias("words"),
                                                f.alias("failed"), (F.size(f) == 0).alias("ready")))

    return _once(F.struct(text.alias("text"), tasks.alias("tasks"), workorders.alias("workorders")), lambda x: _once(
        F.struct(x["text"].alias("text"), F.upper(x["text"]).alias("upper"), x["tasks"].alias("tasks"), x["workorders"].alias("workorders"),
                 F.transform(F.split(x["text"], r"\n\n", -1), lambda s: F.upper(s)).alias("sections")), checked))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value made once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _has(word: str):
    return lambda section: F.contains(section, F.lit(word))


def labelled_text(columns: Sequence[str]) -> Column:
    """The eight-section labelled template with numbered children; e-mails are
    the first three, bodies cut to 500 characters. Untruncated."""
    def value(name: str, default: str = "") -> Column:
        return F.coalesce(_maybe(columns, name).cast("string"), F.lit(default))

    def line(label: str, name: str) -> Column:
        c = _maybe(columns, name).cast("string")
        return F.when(T.present(c), F.concat(F.lit(label), c))

    def some(label: str, c: Column) -> Column:
        return F.when(T.present(c), F.concat(label if isinstance(label, Column) else F.lit(label), c))

    def block(title: str, name: str, rows) -> Column:
        if name not in columns:
            return F.lit(None).cast("string")
        body = F.concat_ws("\n", F.flatten(F.transform(F.col(name), rows)))
        return F.when(F.size(name) > 0, F.concat_ws(
            "\n", F.lit(f"\n=== {title} ==="), F.nullif(body, F.lit(""))))

    def numbered(prefix: str, i: Column, suffix: str) -> Column:
        return F.concat(F.lit(prefix), (i + 1).cast("string"), F.lit(suffix))

    def task(t: Column, i: Column) -> Column:
        return F.array_compact(F.array(
            F.when(T.present(t["subject"]),
                   F.concat(numbered("\nTASK ", i, " - "), t["subject"], F.lit(":"))),
            F.when(T.present(t["description"]), t["description"])))

    def order(w: Column, i: Column) -> Column:
        return F.array_compact(F.array(
            numbered("\nWORK ORDER ", i, ":"), some("Problem: ", w["problem_description"]),
            some("Onsite Action: ", w["onsite_action"]),
            some("Closing Summary: ", w["closing_summary"])))

    def comment(c: Column, i: Column) -> Column:
        return F.array_compact(F.array(some(numbered("Comment ", i, ": "), c["commentbody"])))

    def mail(m: Column, i: Column) -> Column:
        body = F.when(F.length(m["textbody"]) > 500,
                      F.concat(F.left(m["textbody"], F.lit(500)), F.lit("..."))).otherwise(m["textbody"])
        return F.array_compact(F.array(
            some(numbered("\nEmail ", i, " Subject: "), m["subject"]), some("Email Body: ", body)))

    emails = F.lit(None).cast("string")
    if "emails" in columns:
        body = F.concat_ws("\n", F.flatten(F.transform(F.slice("emails", 1, 3), mail)))
        emails = F.when(F.size("emails") > 0, F.concat_ws(
            "\n", F.lit("\n=== EMAIL COMMUNICATIONS ==="), F.nullif(body, F.lit(""))))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("CASE NUMBER: "), value("casenumber", "N/A")),
        F.concat(F.lit("CASE ID: "), value("id", "N/A")),
        F.lit("\n=== ISSUE ==="),
        F.concat(F.lit("SUBJECT: "), value("subject")),
        F.concat(F.lit("DESCRIPTION: "), value("description")),
        line("CAUSE: ", "cause_plain_text"), line("ISSUE DETAILS: ", "issue_plain_text"),
        line("ERROR CODES: ", "error_codes"), line("ENVIRONMENT: ", "gsd_environment_plain_text"),
        line("ISSUE TYPE: ", "issue_type"),
        block("TROUBLESHOOTING STEPS", "tasks", task),
        block("WORK ORDERS", "workorders", order),
        block("ENGINEER COMMENTS", "comments", comment),
        emails,
        F.lit("\n=== RESOLUTION ==="),
        line("RESOLUTION SUMMARY: ", "case_resolution_summary"),
        line("RESOLUTION: ", "resolution_plain_text"), line("RESOLUTION CODE: ", "resolution_code"),
        line("ROOT CAUSE: ", "root_cause"), line("CLOSE COMMENTS: ", "close_comments"),
        F.lit("\n=== METADATA ==="),
        F.concat(F.lit("PRODUCT NUMBER: "), value("product_number")),
        F.concat(F.lit("PRODUCT LINE: "), value("product_line")),
        F.concat(F.lit("ISSUE TYPE: "), value("issue_type")))


# -- issue and resolution text ------------------------------------------------

ISSUE_TEXT = ["Subject", "Description", "Cause_Plain_Text__c", "Issue_Plain_Text__c",
              "GSD_Environment_Plain_Text__c"]
RESOLUTION_TEXT = ["Case_Resolution_Summary__c", "Resolution__c", "Resolution_Plain_Text__c",
                   "Root_Cause__c"]
RESOLUTION_CHILDREN = {"tasks": ["Description", "Subject"],
                       "workorders": ["Closing_Summary__c", "Onsite_Action__c",
                                      "Problem_Description__c"],
                       "casecomments": ["CommentBody"]}


def issue_text(columns: Sequence[str], keep_empty: bool = False) -> Column:
    return T.join_present([_maybe(columns, c) for c in ISSUE_TEXT], keep_empty=keep_empty)


def resolution_text(df: DataFrame, keep_empty: bool = False) -> Column:
    pieces = [T.join_present([_maybe(df.columns, c) for c in RESOLUTION_TEXT],
                             keep_empty=keep_empty)]
    for name, fields in RESOLUTION_CHILDREN.items():
        if name not in df.columns:
            continue
        have = df.schema[name].dataType.elementType.fieldNames()
        for f in [f for f in fields if f in have]:
            pieces.append(F.array_join(F.filter(F.col(f"{name}.{f}"), T.present), JOINER))
    return T.join_present(pieces)


def clean_and_validate(df: DataFrame, required: Sequence[str], html: Sequence[str]) -> DataFrame:
    """Blank to null, tags off, and an ``error`` naming missing required columns."""
    out = df.withColumns({c: F.nullif(T.clean_html(F.col(c)), F.lit("")) for c in html})
    out = out.withColumns({c: F.nullif(T.strip(F.col(c)), F.lit("")) for c in required})
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in required]))
    return out.withColumn("error", F.when(F.size(missing) > 0, F.concat(
        F.lit("missing: "), F.array_join(missing, ", "))))


def transform_cases(cases: DataFrame, tasks: DataFrame, workorders: DataFrame,
                    comments: DataFrame, task_key: str = "CaseId") -> DataFrame:
    """Join, build issue and resolution text, clean and validate."""
    def fields(df: DataFrame, key: str) -> dict[str, Column]:
        return {c: F.col(c) for c in df.columns if c != key}
    children = [Child("tasks", tasks, task_key, fields(tasks, task_key)),
                Child("workorders", workorders, "CaseId", fields(workorders, "CaseId")),
                Child("casecomments", comments, "ParentId", fields(comments, "ParentId"))]
    joined = assemble(cases, "Id", children)
    built = (joined.withColumn("issue_text", issue_text(joined.columns))
             .withColumn("resolution_text", resolution_text(joined)))
    return built.transform(clean_and_validate, ["issue_text", "resolution_text"],
                           ["issue_text", "resolution_text"])
