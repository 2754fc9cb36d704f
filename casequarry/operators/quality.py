"""Data-quality checks as rows ``(table, severity, rule, message, n)``.

All per-column tests of a table are one aggregate over one scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from casequarry import schemas as S
from casequarry.functions.text import strip
from casequarry.skew import earliest


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, nulls, rows) per column, one pass."""
    totals = df.agg(F.count("*").alias("rows"), *[
        F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(columns)])
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"n_{i}").alias("nulls"))
                               for i, c in enumerate(columns)]))
    return totals.select("rows", long.alias("x")).select("x.field", "x.nulls", "rows")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur again, with the number of later occurrences. Counted
    with map-side combine; the repeated rows themselves are not gathered."""
    return (df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
            .select(key, (F.col("n") - 1).alias("repeats")))


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    return earliest(df, [key], order)


def outside_domain(df: DataFrame, column: str, values: Sequence[str], null_is_outside: bool
                   ) -> DataFrame:
    """Unexpected values and their counts."""
    c = F.col(column)
    inside = c.isin(*values)
    test = ~F.coalesce(inside, F.lit(False)) if null_is_outside else c.isNotNull() & ~inside
    return df.filter(test).groupBy(column).agg(F.count("*").alias("n"))


def orphans(child: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Child rows with a key that no parent has."""
    known = parents.select(F.col(parent_key).alias(key))
    return child.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def completeness(df: DataFrame, columns: Sequence[str], critical: Sequence[str] = (),
                 floor: float = 0.95) -> DataFrame:
    """Populated share per column and PASS / FAIL for the critical ones."""
    rate = 1 - F.coalesce(F.try_divide("nulls", "rows"), F.lit(1.0))
    return null_counts(df, columns).select(
        "field", rate.alias("populated"),
        F.when(~F.col("field").isin(*critical) if critical else F.lit(True), "INFO")
        .when(rate >= floor, "PASS").otherwise("FAIL").alias("status"))


def populated(columns: Sequence[str]) -> Column:
    """Number of fields with a value."""
    return reduce(lambda a, b: a + b, [
        F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), 1).otherwise(0)
        for c in columns])


# Upper bounds of the populated-fields histogram.
FIELD_BOUNDS = [10, 20, 30, 35, 40, 44]


def bucket(value: Column, bounds: Sequence[float]) -> Column:
    """Smallest bound that the value does not exceed, else ``+Inf``."""
    out = F.when(value <= bounds[0], str(bounds[0]))
    for bound in bounds[1:]:
        out = out.when(value <= bound, str(bound))
    return out.otherwise("+Inf")


def populated_histogram(df: DataFrame, columns: Sequence[str],
                        bounds: Sequence[float] = FIELD_BOUNDS, floor: int = 30) -> DataFrame:
    n = populated(columns)
    return df.groupBy(bucket(n, bounds).alias("le"), F.when(n >= floor, "pass").otherwise("warn")
                      .alias("status")).agg(F.count("*").alias("cases"))


def error_code_stats(df: DataFrame, codes: str) -> DataFrame:
    """Share of rows with codes and the number of distinct codes."""
    c = F.col(codes)
    rate = df.agg(F.avg(F.when(c.isNotNull() & (c != ""), 1.0).otherwise(0.0)).alias("present"))
    distinct = (df.select(F.explode(F.split(c, r",\s*")).alias("code"))
                .filter(strip(F.col("code")) != "").agg(F.countDistinct("code").alias("unique_codes")))
    return rate.select("present", distinct.scalar().alias("unique_codes"))


# Thresholds of the schema-validation board.
BOARD = [("embedding_success", ">=", 0.99, "failed"), ("pii_leaks", "<=", 0.0, "failed"),
         ("task_coverage", ">=", 0.30, "warning"), ("load_success", ">=", 0.99, "failed"),
         ("search_seconds", "<", 1.0, "warning"), ("precision_at_5", ">=", 0.75, "failed")]


def board(metrics: DataFrame, thresholds: Sequence[tuple[str, str, float, str]] = BOARD) -> DataFrame:
    """(metric, value, status) for metric rows with a threshold."""
    rules = metrics.sparkSession.createDataFrame(
        list(thresholds), "metric string, op string, target double, otherwise string")
    met = (F.when(F.col("op") == ">=", F.col("value") >= F.col("target"))
           .when(F.col("op") == "<=", F.col("value") <= F.col("target"))
           .when(F.col("op") == "<", F.col("value") < F.col("target"))
           .otherwise(F.col("value") > F.col("target")))
    return metrics.join(F.broadcast(rules), "metric").select(
        "metric", "value", "target", F.when(met, "passed").otherwise(F.col("otherwise")).alias("status"))


# -- export files ----------------------------------------------------------------

def _issue(table: str, severity: str, rule: str, message: Column, n: Column) -> Column:
    return F.struct(F.lit(table).alias("table"), F.lit(severity).alias("severity"),
                    F.lit(rule).alias("rule"), message.alias("message"),
                    n.cast("bigint").alias("n"))


ISSUE = "table string, severity string, rule string, message string, n bigint"


def quality_issues(df: DataFrame, table: str) -> DataFrame:
    """Null, key and domain checks of one loaded table."""
    required = [c for c in S.REQUIRED[table] if c in df.columns]
    key = S.FOREIGN_KEY.get(table)
    body = {"workorderfeed": "Body", "emailmessage": "TextBody"}.get(table)
    tests = [F.count("*").alias("rows"),
             *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in S.TABLES[table].fieldNames()
               if c in df.columns]]
    totals = df.agg(*tests)

    def at_least_one(test: Column, issue: Column) -> Column:
        return F.when(test > 0, issue)

    empty = F.col("rows") == 0
    issues = [F.when(empty, _issue(table, "error", "empty", F.lit(f"{table}: DataFrame is empty"),
                                   F.lit(0)))]
    for c in required:
        n = F.col(f"null_{c}")
        issues.append(at_least_one(n, _issue(table, "error", "required_null", F.concat(
            F.lit(f"{table}: "), n.cast("string"), F.lit(f" null values in required field '{c}'")), n)))
    if key:
        n = F.col(f"null_{key}")
        issues.append(at_least_one(n, _issue(table, "error", "null_key", F.concat(
            F.lit(f"{table}: "), n.cast("string"), F.lit(f" {S.PLURAL[table]} with null {key}")), n)))
    if body:
        n = F.col(f"null_{body}")
        issues.append(at_least_one(n, _issue(table, "warning", "null_body", F.concat(
            F.lit(f"{table}: "), n.cast("string"), F.lit(f" {S.PLURAL[table]} with null {body}")), n)))
    out = totals.select(F.inline(F.array_compact(F.array(*issues))))

    def listed(found: DataFrame, column: str, severity: str, rule: str, text: str) -> DataFrame:
        """One row per value, so the list of values may be of any length."""
        return found.select(
            F.lit(table).alias("table"), F.lit(severity).alias("severity"), F.lit(rule).alias("rule"),
            F.concat(F.lit(f"{table}: {text}: "), F.coalesce(F.col(column), F.lit("null"))).alias("message"),
            F.col("n").cast("bigint").alias("n"))

    if table == "case":
        repeats = duplicate_keys(df, "Id").withColumnRenamed("repeats", "n")
        out = (out.unionByName(listed(repeats, "Id", "error", "duplicate", "Duplicate Case IDs found"))
               .unionByName(listed(outside_domain(df, "Status", S.CASE_STATUS, True), "Status",
                                   "warning", "status", "Unexpected Status values"))
               .unionByName(listed(outside_domain(df, "Priority", S.CASE_PRIORITY, False), "Priority",
                                   "warning", "priority", "Unexpected Priority values")))
    if table == "task":
        out = out.unionByName(listed(
            outside_domain(df, "Type", S.TASK_TYPES, True), "Type", "warning", "type",
            "Tasks with unexpected Type values will be filtered"))
    return out


def structure_issues(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Shape of one export file: not JSON, neither array nor ``records``, no
    records, or a record without a required key. A record is read as a map, so
    a key given with a null differs from a key not given. The first record's
    gap is reported twice, for the table and for record 0."""
    from casequarry.sources.exports import is_json
    record = MapType(StringType(), StringType())
    whole = spark.read.text(path, wholetext=True).withColumnRenamed("value", "doc")
    first = F.left(F.ltrim(F.regexp_replace("doc", r"^\s+", "")), F.lit(1))
    parsed = whole.select(
        first.alias("first"), is_json(F.col("doc")).alias("is_json"),
        F.when(first == "[", F.from_json("doc", ArrayType(record)))
        .otherwise(F.from_json("doc", StructType([StructField("records", ArrayType(record))]))
                   ["records"]).alias("records"),
        F.when(first == "{", F.array_contains(F.json_object_keys("doc"), "records"))
        .otherwise(first == "[").alias("shaped"))

    def one(test: Column, rule: str, message: str) -> Column:
        return F.when(test, _issue(table, "error", rule, F.lit(message), F.lit(1)))

    general = parsed.select(F.inline(F.array_compact(F.array(
        one(~F.col("is_json"), "bad_json", f"Invalid JSON in {path}"),
        one(F.col("is_json") & ~F.coalesce("shaped", F.lit(False)), "bad_shape",
            f"Invalid JSON structure in {path}"),
        one(F.col("shaped") & F.col("is_json") & (F.size("records") <= 0), "no_records",
            f"No records found in {path}")))))
    gaps = (parsed.filter(F.col("is_json") & F.col("shaped"))
            .select(F.posexplode("records").alias("at", "r"))
            .withColumn("missing", F.array_except(
                F.array(*[F.lit(c) for c in S.REQUIRED[table]]), F.map_keys("r")))
            .filter(F.size("missing") > 0)
            .withColumn("names", F.array_join(F.array_sort("missing"), ", ")))
    per_record = gaps.select(_issue(table, "error", "required_key", F.concat(
        F.lit(f"{table} record "), F.col("at").cast("string"), F.lit(": Missing required fields: "),
        F.col("names")), F.size("missing")).alias("i")).select("i.*")
    per_table = gaps.filter(F.col("at") == 0).select(_issue(table, "error", "required_key_table", F.concat(
        F.lit(f"{table}: Missing required fields: "), F.col("names")), F.size("missing"))
        .alias("i")).select("i.*")
    return general.unionByName(per_table).unionByName(per_record)


def verdicts(issues: DataFrame, tables: Sequence[str] = tuple(S.TABLES), hide: bool = False
             ) -> DataFrame:
    """Per table: valid, and numbers of errors and warnings. ``hide`` drops the
    warnings of a failed table."""
    spark = issues.sparkSession
    names = spark.createDataFrame([(t,) for t in tables], "table string")
    counts = issues.groupBy("table").agg(
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"))
    out = names.join(counts, "table", "left").na.fill(0, ["errors", "warnings"]).withColumn(
        "valid", F.col("errors") == 0)
    return out.withColumn("warnings", F.when(F.col("valid"), F.col("warnings")).otherwise(0)) if hide else out


def validate_files(spark: SparkSession, folder: str) -> DataFrame:
    """All issues of the six export files of a folder; a missing file is an
    error, and a table whose structure fails is not checked further."""
    from casequarry.sources.exports import missing_files, read_envelopes
    absent = {r["table"] for r in missing_files(spark, folder).collect()}  # six rows at most
    parts = [spark.createDataFrame(
        [(t, "error", "missing_file", f"File not found: {folder}/{S.FILES[t]}", 1) for t in sorted(absent)],
        ISSUE)]
    for table in S.TABLES:
        if table in absent:
            continue
        path = f"{folder}/{S.FILES[table]}"
        shape = structure_issues(spark, path, table)
        sound = shape.agg(F.count("*")).scalar() == 0
        loaded = read_envelopes(spark, path, S.TABLES[table], strict=False)
        parts += [shape, quality_issues(loaded, table).filter(sound)]
    return reduce(DataFrame.unionByName, parts)


# -- stage gates -------------------------------------------------------------------

ISO_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"
# Domains of the extract gate.
GATE_STATUS = ["New", "In Progress", "Closed", "Cancelled"]


def _failures(checks: Sequence[tuple[Column, str]]) -> Column:
    """Names of the checks that fail; a null outcome is a failure."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(ok, F.lit(False)), name) for ok, name in checks]))


def extract_gate(status: Sequence[str] = GATE_STATUS, priority: Sequence[str] = S.CASE_PRIORITY) -> Column:
    return _failures([
        (F.col("caseId").isNotNull(), "caseId"), (F.col("caseNumber").isNotNull(), "caseNumber"),
        (F.col("createdDate").rlike(ISO_TIME), "createdDate"),
        (F.col("status").isin(*status), "status"), (F.col("priority").isin(*priority), "priority")])


def clean_gate() -> Column:
    levels = F.split("category", " > ")
    return _failures([
        (~F.col("productFamily").isin("Unknown", "Other"), "productFamily"),
        (F.forall(levels, lambda x: strip(x) != ""), "category"),
        (F.col("closedDate").isNull() | (F.col("closedDate") > F.col("createdDate")), "resolutionTime"),
        (F.col("quarter").rlike(r"^Q[1-4] \d{4}$"), "quarter"), (F.col("ageInDays") >= 0, "ageInDays")])


def load_gate(indexed: Sequence[str], vector_error: Column) -> Column:
    return _failures([
        *[(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), c) for c in indexed],
        (vector_error.isNull(), "vector")])
