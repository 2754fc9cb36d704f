"""Derived case metadata. Rules are ordered data; ``now`` is an argument."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.functions.text import strip

# Ordered (pattern, family), category codes, labels.
FAMILIES = [
    ("ProLiant.*", "ProLiant"),
    ("Synergy.*", "Synergy"),
    ("Apollo.*", "Apollo"),
    ("Aruba.*Switch.*", "Aruba Switches"),
    ("Aruba.*AP.*", "Aruba Access Points"),
    ("Aruba.*Access.*Point.*", "Aruba Access Points"),
    ("3PAR.*", "3PAR Storage"),
    ("Nimble.*", "Nimble Storage"),
    ("SimpliVity.*", "SimpliVity"),
    ("Primera.*", "Primera Storage"),
    ("Alletra.*", "Alletra Storage"),
    ("MSA.*", "MSA Storage"),
    ("StoreOnce.*", "StoreOnce"),
    ("Edgeline.*", "Edgeline"),
    ("Cloudline.*", "Cloudline"),
]
FAMILIES_EIGHT = [
    ("ProLiant.*", "ProLiant"), ("Synergy.*", "Synergy"), ("Apollo.*", "Apollo"),
    ("Aruba.*Switch.*", "Aruba Switches"), ("Aruba.*AP.*", "Aruba Access Points"),
    ("3PAR.*", "3PAR Storage"), ("Nimble.*", "Nimble Storage"), ("SimpliVity.*", "SimpliVity")]
FAMILIES_SHORT = [("ProLiant", "ProLiant"), ("Synergy", "Synergy"), ("SimpliVity", "SimpliVity"),
                  ("Aruba", "Aruba"), ("Primera", "Primera"), ("Nimble", "Nimble")]
CATEGORY_CODES = {"HW": "Hardware", "SW": "Software", "NW": "Networking", "FW": "Firmware",
                  "OS": "Operating System", "APP": "Application", "SEC": "Security"}
CATEGORY_CODES_FOUR = {"HW": "Hardware", "SW": "Software", "NW": "Networking", "FW": "Firmware"}
CATEGORY_CODES_SHORT = {"HW": "Hardware", "SW": "Software", "NET": "Network", "STOR": "Storage"}
EMBEDDING_MODEL = "text-embedding-3-large"
EMBEDDING_VERSION = "v1.0"


def code_map(codes: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])


def product_family(c: Column, rules: Sequence[tuple[str, str]] = FAMILIES,
                   missing: str = "Unknown", other: str = "Other") -> Column:
    """First rule that matches, any letter case."""
    trimmed = strip(c)
    family = F.when(c.isNull() | (c == ""), missing)
    for pattern, name in rules:
        family = family.when(trimmed.rlike("(?i)" + pattern), name)
    return family.otherwise(other)


def category_levels(c: Column, codes: Mapping[str, str] = CATEGORY_CODES) -> Column:
    """Struct of level1..3 and path; only the first part is looked up."""
    parts = F.transform(F.split(c, "-", -1), strip)
    level1 = F.coalesce(F.try_element_at(code_map(codes), F.upper(F.get(parts, F.lit(0)))),
                        F.get(parts, F.lit(0)))
    known = F.struct(
        level1.alias("level1"), F.get(parts, F.lit(1)).alias("level2"),
        F.get(parts, F.lit(2)).alias("level3"),
        F.concat_ws(" > ", level1, F.get(parts, F.lit(1)), F.get(parts, F.lit(2))).alias("path"))
    none = F.lit(None).cast("string")
    return F.when(c.isNull() | (c == ""), F.struct(
        F.lit("Uncategorized").alias("level1"), none.alias("level2"), none.alias("level3"),
        F.lit("Uncategorized").alias("path"))).otherwise(known)


def category_full_path(c: Column, codes: Mapping[str, str] = CATEGORY_CODES_FOUR) -> Column:
    """The variant whose path keeps all parts, however many; the first one is
    looked up as written."""
    parts = F.transform(F.split(c, "-", -1), strip)
    first = F.get(parts, F.lit(0))
    named = F.coalesce(F.try_element_at(code_map(codes), first), first)
    return F.concat_ws(" > ", named, F.slice(parts, F.lit(2), F.size(parts)))


def category_path_every_level(c: Column, codes: Mapping[str, str] = CATEGORY_CODES_SHORT) -> Column:
    """The variant that splits on ``' - '`` and looks up every level."""
    return F.array_join(F.transform(
        F.split(c, " - ", -1), lambda p: F.coalesce(F.try_element_at(code_map(codes), p), p)), " > ")


def seconds(c: Column) -> Column:
    """Seconds since the epoch, fractions kept; unreadable text counts as null."""
    return F.unix_micros(c.try_cast("timestamp")) / 1e6


def resolution_hours(created: Column, closed: Column) -> Column:
    gap = seconds(closed) - seconds(created)
    return F.when(gap >= 0, F.round(gap / 3600, 2))


def resolution_bucket(created: Column, closed: Column) -> Column:
    created, closed = seconds(created), seconds(closed)
    hours = (closed - created) / 3600
    return (F.when(created.isNull(), "Unknown").when(closed.isNull(), "Open")
            .when(hours < 0, "Invalid").when(hours < 4, "0-4 hours").when(hours < 24, "4-24 hours")
            .when(hours < 168, "1-7 days").otherwise(">7 days"))


def resolution_bucket_closed(created: Column, closed: Column) -> Column:
    """The variant whose upper bounds belong to the lower bucket."""
    hours = (seconds(closed) - seconds(created)) / 3600
    return (F.when(closed.isNull(), F.lit(None).cast("string")).when(hours <= 4, "0-4h")
            .when(hours <= 24, "4-24h").when(hours <= 168, "1-7d").otherwise(">7d"))


def quarter_label(created: Column) -> Column:
    created = created.try_cast("timestamp")
    label = F.concat(F.lit("Q"), F.quarter(created), F.lit(" "), F.year(created))
    return F.when(created.isNull(), "Unknown").otherwise(label)


def case_age_days(created: Column, now: Column) -> Column:
    gap = seconds(now) - seconds(created)
    return F.when(gap >= 0, F.floor(gap / 86400).cast("int"))


def enrich(cases: DataFrame, now: Column) -> DataFrame:
    """Eleven direct, eleven derived and three system columns, one projection."""
    created, closed = F.col("createdDate"), F.col("closedDate")
    level = category_levels(F.col("category"))
    direct = ["caseNumber", "caseId", "product", "status", "priority", "errorCodes", "issueType",
              "resolutionCode", "rootCause", "createdDate", "closedDate"]
    return cases.withColumn("__level", level).select(
        *direct,
        product_family(F.col("product")).alias("productFamily"),
        F.col("__level.path").alias("category"),
        F.col("__level.level1").alias("categoryLevel1"),
        F.col("__level.level2").alias("categoryLevel2"),
        F.col("__level.level3").alias("categoryLevel3"),
        resolution_hours(created, closed).alias("resolutionTimeHours"),
        resolution_bucket(created, closed).alias("resolutionTimeBucket"),
        quarter_label(created).alias("quarter"),
        F.year(created.try_cast("timestamp")).alias("year"),
        F.month(created.try_cast("timestamp")).alias("month"),
        case_age_days(created, now).alias("ageInDays"),
        F.lit(EMBEDDING_MODEL).alias("embeddingModel"),
        F.lit(EMBEDDING_VERSION).alias("embeddingVersion"),
        now.alias("processedTimestamp"))


def enrichment_warnings(family: Column, category: Column, age: Column, bucket: Column) -> Column:
    """The four warnings on enriched rows; an empty array means valid."""
    checks = [
        (family == "Unknown", "Product family could not be determined"),
        (category == "Uncategorized", "Category is uncategorized"),
        (age.isNull(), "Invalid creation date"),
        (bucket == "Invalid", "Invalid date range: ClosedDate before CreatedDate"),
    ]
    return F.array_compact(F.array(*[F.when(test, message) for test, message in checks]))


def in_category(path: Column, prefix: str) -> Column:
    """Hierarchy drill-down: the node itself or anything below it."""
    return (path == prefix) | path.startswith(prefix + " > ")
