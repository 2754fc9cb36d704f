"""Connected components by alternating star operations, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casequarry.session import cut


def components(edges: DataFrame, task_rows: int = 0) -> DataFrame:
    """node, root: the smallest node of its component for each end of ``edges`` (a, b).

    Each round hangs every node's larger neighbours on its smallest one (large
    star), then its smaller neighbours (small star), until nothing changes. The
    number of rounds grows with the logarithm of the longest chain; a node with
    very many neighbours stays one row per neighbour. Loops are allowed, nulls are not.
    With ``task_rows`` no exchange has more tasks than the rows need at so many a task.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    seen = None
    fit = lambda df: df
    if task_rows:
        tasks = tasks_for(edges, task_rows)
        edges = edges.coalesce(tasks)
        fit = lambda df: df.coalesce(tasks)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = fit(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where(
            "a != b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = fit(large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                    .unionByName(least.select("a", F.col("low").alias("b"))).where("a != b")).distinct()
        edges = cut(fit(small))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state


def tasks_for(rows: DataFrame, task_rows: int) -> int:
    """One task for each core, or as many as ``rows`` need at ``task_rows`` each."""
    return max(1, rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // task_rows))


def fitted(rows: DataFrame, task_rows: int) -> DataFrame:
    """Checkpointed ``rows`` in as many partitions as they need:
    a few rows in hundreds of partitions make hundreds of files in each exchange."""
    return rows.coalesce(tasks_for(rows, task_rows))
