"""JSON exports and staged tables as typed DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from casequarry import schemas as S


def read_envelopes(spark: SparkSession, paths: str | Sequence[str], schema: StructType,
                   lines: bool = False, position: str | None = None,
                   strict: bool = True) -> DataFrame:
    """Rows from ``[...]``, ``{"records": [...]}`` or a single object.

    A whole document is one task, so a large export should come as many files
    or, with ``lines``, one record per line. ``position`` names a column
    {row, at} that keeps the order of the records. ``strict`` fails on unreadable documents;
    otherwise they are left out (``unreadable`` lists them).
    """
    raw = _raw(spark, paths, schema, lines)
    if strict:
        stop = F.raise_error(F.concat(F.lit("unreadable JSON in "), F.col("_path"))).cast("boolean")
        raw = raw.filter(F.when(F.col("_corrupt_record").isNotNull(), stop).otherwise(F.lit(True)))
    else:
        raw = raw.filter(F.col("_corrupt_record").isNull())
    names = schema.fieldNames()
    records = F.coalesce(F.col("records"), F.array(F.struct(*names)))
    rows = raw.select(F.monotonically_increasing_id().alias("_row"),
                      F.posexplode(records).alias("_at", "r"))
    kept = [F.col(f"r.{n}").alias(n) for n in names]
    if position:
        kept.append(F.struct(F.col("_row").alias("row"), F.col("_at").alias("at")).alias(position))
    return rows.select(*kept)


def unreadable(spark: SparkSession, paths: str | Sequence[str], lines: bool = False) -> DataFrame:
    """Path and text of every document, or line, that is not JSON."""
    text = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=not lines)
    return text.select(F.input_file_name().alias("path"), F.col("value").alias("document")).filter(
        ~is_json(F.col("document")))


def is_json(document: Column) -> Column:
    """Whether an array, object or value parses, at any size. (A variant, as
    ``try_parse_json`` makes, has a size limit.)"""
    first = F.left(F.regexp_replace(document, r"^\s+", ""), F.lit(1))
    return (F.when(first == "[", F.json_array_length(document).isNotNull())
            .when(first == "{", F.json_object_keys(document).isNotNull())
            .otherwise(F.coalesce(F.get_json_object(document, "$").isNotNull(), F.lit(False))))


def _raw(spark: SparkSession, paths, schema: StructType, lines: bool) -> DataFrame:
    wide = StructType([StructField("records", ArrayType(schema)), *schema.fields,
                       StructField("_corrupt_record", StringType())])
    reader = spark.read.schema(wide).option("multiLine", not lines).option("mode", "PERMISSIVE")
    return reader.json(paths if isinstance(paths, str) else list(paths)).withColumn(
        "_path", F.input_file_name())


def read_table(spark: SparkSession, folder: str, table: str, path: str | None = None,
               position: str | None = None) -> DataFrame:
    """One of the six tables; tasks come filtered by type."""
    df = read_envelopes(spark, path or f"{folder}/{S.FILES[table]}", S.TABLES[table],
                        position=position)
    return only_known_tasks(df) if table == "task" else df


def only_known_tasks(tasks: DataFrame) -> DataFrame:
    """The two task types that matter. When no row has a type at all, the
    column was not exported and nothing is filtered."""
    typed = tasks.agg(F.max(F.col("Type").isNotNull())).scalar()
    return tasks.filter(F.col("Type").isin(S.TASK_TYPES) | ~F.coalesce(typed, F.lit(False)))


def read_all(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {table: read_table(spark, folder, table) for table in S.TABLES}


def summary(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"))
        for name, df in frames.items()])


def missing_files(spark: SparkSession, folder: str) -> DataFrame:
    """Expected export files that are not in the folder; reads no content."""
    expected = spark.createDataFrame(list(S.FILES.items()), "table string, file string")
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder)
              .select(F.element_at(F.split("path", "/"), -1).alias("file")))
    return expected.join(listed, "file", "left_anti")


def incremental(df: DataFrame, modified: str, since: Column) -> DataFrame:
    """Rows changed after the last run; the comparison reaches the scan."""
    return df.filter(F.col(modified) > since)


def date_range(df: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """Half-open: start counts, end does not."""
    return df.filter((F.col(column) >= start) & (F.col(column) < end))


def case_columns(cases: DataFrame) -> DataFrame:
    """Export names to the names the composite text reads."""
    return cases.select(*[F.col(k).alias(v) for k, v in S.CASE_NAMES.items() if k in cases.columns])


# -- fixtures from a mapping document -------------------------------------------

NESTED = {"task": ("Task", "CaseId"), "workorder": ("WorkOrder", "CaseId"),
          "casecomment": ("CaseComments", "ParentId"), "workorderfeed": ("WorkOrderFeed", "ParentId"),
          "emailmessage": ("EmailMessage", "ParentId")}


def nested_cases(spark: SparkSession, path: str, root: str = "sample_data", lines: bool = False) -> DataFrame:
    """One row per entry of ``root``: the case object and its child arrays.
    With ``lines`` every line is a document of its own."""
    def child_type(table: str, key: str) -> StructType:
        return StructType([f for f in S.TABLES[table].fields if f.name != key])
    entry = StructType(
        [StructField("name", StringType()), StructField("Case", S.TABLES["case"])]
        + [StructField(n, ArrayType(child_type(t, k))) for t, (n, k) in NESTED.items()])
    schema = StructType([StructField(root, MapType(StringType(), entry))])
    document = spark.read.schema(schema).option("multiLine", not lines).json(path)
    return document.select(F.explode(F.col(root)).alias("entry_key", "e")).select("entry_key", "e.*")


def split_nested(nested: DataFrame) -> dict[str, DataFrame]:
    """Six flat tables; each child gets the id of the case it came with."""
    out = {"case": nested.filter(F.col("Case").isNotNull()).select("Case.*")}
    for table, (name, key) in NESTED.items():
        out[table] = nested.select(F.col("Case.Id").alias(key), F.inline(name)).select(
            *[c for c in S.TABLES[table].fieldNames() if c != key], key)
    return out


def from_field_examples(examples: DataFrame) -> dict[str, DataFrame]:
    """Records from flat ``(dataset, table, field, example)`` rows: one record
    per data set and table, except comments, which are one each. Missing ids
    are made from the data set's number; feeds hang on the latest work order."""
    filled = examples.filter(F.col("example").isNotNull())
    # One row per data set of a hand-written mapping, so one ordered task will do.
    numbered = filled.select("dataset").distinct().withColumn(
        "no", F.row_number().over(Window.orderBy("dataset")))

    def record(table: str, fields: Sequence[str]) -> DataFrame:
        return (filled.filter(F.col("table") == table).groupBy("dataset")
                .pivot("field", list(fields)).agg(F.first("example")).join(numbered, "dataset"))

    case = record("Case", S.CASE_FIELDS)
    case = case.withColumn("Id", F.coalesce("Id", F.format_string("500Kh%010d", "no"))).withColumn(
        "CaseNumber", F.coalesce("CaseNumber", F.concat(F.lit("5000"), (F.col("no") + 100000).cast("string"))))
    owner = case.select("dataset", F.col("Id").alias("case_id"))

    def child(table: str, name: str, key: str, prefix: str) -> DataFrame:
        fields = [f for f in S.TABLES[table].fieldNames() if f not in (key, "Id")]
        rows = record(name, fields).join(owner, "dataset")
        return rows.withColumn(key, F.col("case_id")).withColumn(
            "Id", F.format_string(prefix + "%d%06d", "no", F.col("no") - 1))

    orders = child("workorder", "WorkOrder", "CaseId", "0WO")
    feeds = child("workorderfeed", "WorkOrderFeed", "ParentId", "0D5").drop("ParentId")
    made = orders.select("dataset", F.col("Id").alias("__own"))
    latest = numbered.join(made, "dataset", "left").select("dataset", F.last(
        "__own", ignorenulls=True).over(Window.orderBy("no")).alias("__wo"))
    feeds = feeds.join(latest, "dataset", "left").withColumn(
        "ParentId", F.coalesce("__wo", "case_id")).drop("__wo")
    comments = (filled.filter(F.col("table") == "CaseComments").join(owner, "dataset")
                .select(F.col("example").alias("CommentBody"), F.col("case_id").alias("ParentId")))
    return {"case": case.select(*S.CASE_FIELDS),
            "task": child("task", "Task", "CaseId", "00T").select("Type", "Description", "CaseId", "Id"),
            "workorder": orders.select(*S.TABLES["workorder"].fieldNames()),
            "casecomment": comments,
            "workorderfeed": feeds.select("Type", "Body", "ParentId", "Id"),
            "emailmessage": child("emailmessage", "EmailMessage", "ParentId", "02s").select(
                "Subject", "TextBody", "ParentId", "Id")}
