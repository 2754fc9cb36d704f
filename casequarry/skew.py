"""Building blocks that keep one hot key from landing in one task.

Every helper returns the same rows as the plain form; only the route differs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casequarry.session import cut


def salts(spark: SparkSession) -> int:
    """Number of sub-groups a key is split into: grows with the cluster's own
    shuffle width, so a hot key spreads over a fixed share of the tasks."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(4, min(1024, width // 2))


def salt_of(columns: Sequence[Column], n: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | Column,
          rank: str = "rank", tiebreak: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows per key in the given total order, with their rank.

    With a constant ``n`` the first level ranks inside (key, salt), where Spark
    also trims each map task's rows (WindowGroupLimit), so at most
    ``salts * n`` rows of a hot key meet in the final sort. ``tiebreak`` names
    the columns that make the order total; they feed the salt.
    """
    if not tiebreak:
        raise ValueError("tiebreak columns are needed to spread a hot key")
    level1 = Window.partitionBy(*keys, "__salt").orderBy(*order)
    level2 = Window.partitionBy(*keys).orderBy(*order)
    salted = df.withColumn("__salt", salt_of([F.col(c) for c in tiebreak], salts(df.sparkSession)))
    return (
        salted.withColumn("__r", F.row_number().over(level1)).filter(F.col("__r") <= n)
        .drop("__r", "__salt")
        .withColumn(rank, F.row_number().over(level2)).filter(F.col(rank) <= n)
    )


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key. An aggregate, not a window:
    map tasks keep one row per key before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__best")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, *[F.col(f"__best.{c}").alias(c) for c in rest])
            .select(*df.columns))


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("__best")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, *[F.col(f"__best.{c}").alias(c) for c in rest])
            .select(*df.columns))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                      probabilities: dict[str, float], bins: int = 16384) -> DataFrame:
    """Linear-interpolation percentiles without gathering a group.

    ``percentile`` holds a whole group's values in one aggregation buffer.
    Here a counted histogram (at most ``bins`` rows per group) locates the bins
    that hold the wanted ranks, and only the distinct values of those bins are
    ranked. Bins are even on a signed log scale, so a few outliers do not push
    everything else into one bin. Three scans, small shuffles, same numbers.
    Bounds and ranks are a few rows per group; they are checkpointed and joined
    by broadcast once counted, so the values themselves are never shuffled.
    """
    keys = list(keys) or ["__all"]
    source = df.filter(F.col(value).isNotNull())
    if keys == ["__all"]:
        # Always 1, but not a constant to the optimizer: a constant key would
        # turn the joins below into cross joins.
        source = source.withColumn("__all", F.signum(F.abs(F.col(value).cast("double")) + 1))
    source = source.select(*keys, F.col(value).cast("double").alias("__v")).withColumn(
        "__s", F.signum("__v") * F.log1p(F.abs("__v")))
    bounds = source.groupBy(*keys).agg(
        F.min("__s").alias("__lo"), F.max("__s").alias("__hi"), F.count("*").alias("__n"))
    slot = (F.when(F.col("__hi") == F.col("__lo"), F.lit(0))
            .otherwise(F.least(F.lit(bins - 1),
                               F.floor((F.col("__s") - F.col("__lo")) * bins
                                       / (F.col("__hi") - F.col("__lo"))))).cast("int"))
    binned = source.join(small_side(bounds), keys).withColumn("__bin", slot)
    running = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cells = (binned.groupBy(*keys, "__bin").agg(F.count("*").alias("__c"), F.first("__n").alias("__n"))
             .withColumn("__to", F.sum("__c").over(running))
             .withColumn("__from", F.col("__to") - F.col("__c")))
    wanted = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"),
                 (F.lit(float(p)) * (F.col("__n") - 1)).alias("pos"))
        for name, p in probabilities.items()]))
    ranks = (cells.withColumn("__w", wanted)
             .withColumn("__rank", F.explode(F.array_distinct(F.array(
                 F.floor("__w.pos"), F.ceil("__w.pos")))))
             .filter((F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
             .select(*keys, "__bin", "__from", F.col("__w.name").alias("__name"),
                     F.col("__w.pos").alias("__pos"), "__rank"))
    ranks = small_side(ranks)
    inside = Window.partitionBy(*keys, "__bin").orderBy("__v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    values = (binned.join(ranks.select(*keys, "__bin").distinct(), [*keys, "__bin"], "left_semi")
              .groupBy(*keys, "__bin", "__v").agg(F.count("*").alias("__c"))
              .withColumn("__to_v", F.sum("__c").over(inside))
              .withColumn("__from_v", F.col("__to_v") - F.col("__c")))
    weight = F.when(F.col("__rank") == F.floor("__pos"), 1 - (F.col("__pos") - F.floor("__pos"))
                    ).otherwise(F.col("__pos") - F.floor("__pos"))
    picked = (values.join(ranks, [*keys, "__bin"])
              .filter((F.col("__rank") - F.col("__from") >= F.col("__from_v"))
                      & (F.col("__rank") - F.col("__from") < F.col("__to_v")))
              .withColumn("__part", F.col("__v") * weight))
    out = picked.groupBy(*keys).agg(*[
        F.sum(F.when(F.col("__name") == name, F.col("__part"))).alias(name)
        for name in probabilities])
    return out.drop("__all")


def is_small(kept: DataFrame, limit: int = 16 << 20) -> bool:
    """Whether checkpointed rows, measured as text, are at most ``limit`` bytes."""
    return (kept.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0) <= limit


def small_side(df: DataFrame, limit: int = 16 << 20) -> DataFrame:
    """``df`` ready to be joined: broadcast when its checkpointed rows are
    proven to be small, else left to a shuffle join."""
    kept = cut(df)
    return F.broadcast(kept) if is_small(kept, limit) else kept


def spread(scan: DataFrame) -> DataFrame:
    """A plain table scan with at least one partition per core. A large table
    has many and is left alone; a small one in a single file, which would run
    a costly expression on a single core, is dealt out."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    parts = scan._jdf.queryExecution().toRdd().getNumPartitions()
    return scan if parts >= cores else scan.repartition(cores)


PART_ROWS = 250_000  # rows of one side that one task of a join sorts


def parted(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as ``rows`` need, if those are more than a shuffle has.
    Sides dealt with the same ``rows`` join without another exchange."""
    parts = -(-rows // PART_ROWS)
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")) else df
