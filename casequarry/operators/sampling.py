"""Repeatable samples: order by a hash of the id and a seed, never by chance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.skew import earliest, small_side, top_n


def sample_key(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def random_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows; a distributed top-n, no full sort. Repeated ids count as rows
    of their own."""
    return df.orderBy(sample_key(key, seed), key).limit(n)


def capped(df: DataFrame, strata: Sequence[str], key: str, cap: int, seed: int = 42) -> DataFrame:
    """At most ``cap`` rows of each stratum."""
    hashed = df.withColumn("__h", sample_key(key, seed))
    return top_n(hashed, strata, [F.asc("__h"), F.asc(key)], cap, "__rank", ["__h"]).drop(
        "__h", "__rank")


def stratified(df: DataFrame, strata: Sequence[str], key: str, n: int, seed: int = 42,
               share: int = 20) -> DataFrame:
    """Cap of ``n // share`` per stratum, then the first ``n`` in strata order."""
    rows = capped(df, strata, key, n // share, seed)
    return rows.orderBy(*strata, sample_key(key, seed), key).limit(n)


def equal_caps(df: DataFrame, stratum: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """The same cap for each value: ``n`` divided by the number of values."""
    values = df.agg(F.countDistinct(stratum)).scalar()
    hashed = df.withColumn("__h", sample_key(key, seed)).withColumn("__cap", F.floor(F.try_divide(F.lit(n), values)))
    rows = top_n(hashed, [stratum], [F.asc("__h"), F.asc(key)], F.col("__cap"), "__rank", ["__h"])
    return rows.orderBy(stratum, "__h", key).limit(n).drop("__h", "__cap", "__rank")


def trim_or_fill(chosen: DataFrame, pool: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows where the pool has them: chosen rows first, then
    others, each in hash order."""
    picked = chosen.select(key).distinct().withColumn("__chosen", F.lit(0))
    tagged = pool.join(picked, key, "left").withColumn("__chosen", F.coalesce("__chosen", F.lit(1)))
    return tagged.orderBy("__chosen", sample_key(key, seed), key).limit(n).drop("__chosen")


def proportional(df: DataFrame, stratum: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """``int(n * share)`` rows of each value, then trimmed or filled to ``n``.

    Shares come from one aggregate, joined back as a small table of values.
    """
    counts = df.groupBy(stratum).agg(F.count("*").alias("__c"))
    total = counts.agg(F.sum("__c")).scalar()
    quota = counts.select(stratum, F.floor(F.lit(n) * (F.col("__c") / total)).alias("__quota"))
    hashed = df.withColumn("__h", sample_key(key, seed)).join(small_side(quota), stratum)
    rows = top_n(hashed, [stratum], [F.asc("__h"), F.asc(key)], F.col("__quota"), "__rank", ["__h"])
    return trim_or_fill(rows.select(key), df, key, n, seed)


# Rows wanted per product family.
FAMILY_TARGETS = {"ProLiant": 400, "Synergy": 200, "Aruba": 200, "Storage": 100, "Other": 100}


def by_family_targets(df: DataFrame, product: str, strata: Sequence[str], key: str, n: int = 1000,
                      targets: dict[str, int] | None = None, seed: int = 42) -> DataFrame:
    """Per-family targets, inner caps of target // 6 per stratum, duplicates
    dropped, then trimmed or filled to ``n``. A product may count for several
    families; the last entry takes what matches none."""
    targets = targets or FAMILY_TARGETS
    name = F.lower(F.coalesce(F.col(product), F.lit("")))
    named = [f for f in targets if f != "Other"]
    none = ~name.rlike("|".join(f.lower() for f in targets))
    families = F.array_compact(F.array(
        *[F.when(F.contains(name, F.lit(f.lower())), f) for f in named],
        *([F.when(none, "Other")] if "Other" in targets else [])))
    wanted = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
    rows = (df.withColumn("__family", F.explode(families)).withColumn("__h", sample_key(key, seed))
            .withColumn("__target", F.element_at(wanted, F.col("__family"))))
    order = [F.asc("__h"), F.asc(key)]
    inner = top_n(rows, ["__family", *strata], order, F.floor(F.col("__target") / 6), "__r", ["__h"])
    outer = top_n(inner, ["__family"], [*[F.asc(s) for s in strata], *order], F.col("__target"),
                  "__r2", ["__h"])
    unique = outer.select(key).distinct()
    return trim_or_fill(unique, df, key, n, seed)


def first_of_each(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Combine samples and keep the first sample's row for each id."""
    tagged = [f.withColumn("__from", F.lit(i)) for i, f in enumerate(frames)]
    combined = tagged[0]
    for frame in tagged[1:]:
        combined = combined.unionByName(frame)
    return earliest(combined, [key], ["__from"]).drop("__from")


def distribution(df: DataFrame, *columns: str) -> DataFrame:
    """Counts by each column on its own, in one pass."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("x"))
    return long.groupBy("x.field", "x.value").agg(F.count("*").alias("n"))
