"""Comparing two stores by digests over hash ranges of their keys, so that equal parts are not read.

A store's digests are a tree: level 0 is the whole store, each level splits every node in
16 by the next four bits of the key's hash, down to leaves. A node has the number
of its rows, the sum and the exclusive or of two row hashes over (key, checksum). These
are additive: all levels come from one aggregate with map-side combine, trees
of different depth compare at their common levels, and a changed row is taken out
and put in without reading the rest (``updated``). Digests are a few rows; write them beside the store.

Two stores are compared from the root down: only children of differing nodes are
looked at. Only rows of differing leaves are joined.

Cases: rows of null checksum never match, so their leaves always count as differing; a
null key belongs to the leaf of its hash like any other. Keys are taken to be
unique in a store. Different contents compare as equal only if 128 bits agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casequarry.operators.reconcile import compare_stores
from casequarry.session import cut
from casequarry.skew import small_side

BITS = 4  # of the hash per level
LEAF_ROWS = 10_000
DEEPEST = 8
SCHEMA = "level int, node long, n long, nulls long, total decimal(38,0), mixed long"


def depth_for(rows: int) -> int:
    """Levels below the root, for leaves of some ``LEAF_ROWS`` rows."""
    depth = 1
    while depth < DEEPEST and rows >> (BITS * depth) > LEAF_ROWS:
        depth += 1
    return depth


def node_of(key: str, depth: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - BITS * depth)


def digests(store: DataFrame, key: str, checksum: str = "checksum", depth: int | None = None) -> DataFrame:
    """level, node, n, nulls, total, mixed of every level."""
    depth = depth_for(store.count()) if depth is None else depth
    leaves = store.select(node_of(key, depth).alias("leaf"), F.col(checksum).isNull().cast("long").alias("nulls"),
                          F.xxhash64(key, checksum).cast("decimal(38,0)").alias("a"), F.xxhash64(checksum, key, F.lit(1)).alias("b"))
    leaves = leaves.groupBy("leaf").agg(F.count("*").alias("n"), F.sum("nulls").alias("nulls"), F.sum("a").alias("a"), F.bit_xor("b").alias("b"))
    levels = leaves.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    # A shift by 64 is one by none, so the root is named apart.
    node = reduce(lambda other, l: F.when(F.col("level") == l, F.shiftrightunsigned("leaf", BITS * (depth - l))).otherwise(other), range(1, depth + 1), F.lit(0).cast("long"))
    return levels.groupBy("level", node.alias("node")).agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.sum("a").cast("decimal(38,0)").alias("total"), F.bit_xor("b").alias("mixed"))


def updated(tree: DataFrame, removed: DataFrame, added: DataFrame, key: str, checksum: str = "checksum") -> DataFrame:
    """The digests after some rows left a store and others came; empty nodes are dropped."""
    depth = tree.agg(F.max("level")).first()[0] or 1
    out, new = (digests(rows, key, checksum, depth) for rows in (removed, added))
    minus = out.select("level", "node", *((-F.col(c)).alias(c) for c in ("n", "nulls", "total")), "mixed")
    both = tree.select(*out.columns).unionByName(minus).unionByName(new)
    return both.groupBy("level", "node").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.sum("total").cast("decimal(38,0)").alias("total"),
        F.bit_xor("mixed").alias("mixed")).filter("n != 0")


def write(tree: DataFrame, folder: str) -> None:
    tree.repartition(1, "level").write.mode("overwrite").partitionBy("level").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder)


def differing(a: DataFrame, b: DataFrame) -> tuple[int, DataFrame]:
    """Depth of the comparison and the nodes (node) of that level at which the stores differ."""
    spark = a.sparkSession
    depth = min(x.agg(F.max("level")).first()[0] or 0 for x in (a, b))
    if not depth:  # one store, or both, without rows
        empty = not (a.limit(1).count() or b.limit(1).count())
        return 0, spark.createDataFrame([] if empty else [(0,)], "node long")
    same = reduce(lambda x, y: x & y, [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("n", "total", "mixed")]) & (F.col("x.nulls") == 0)
    open_nodes = None
    for level in range(depth + 1):
        x, y = (t.filter(F.col("level") == level) for t in (a, b))
        if open_nodes is not None:
            up = open_nodes.select(F.col("node").alias("parent"))
            x, y = (t.join(F.broadcast(up), F.shiftrightunsigned("node", BITS) == F.col("parent"), "left_semi") if level > 1 else t for t in (x, y))
        pairs = x.alias("x").join(y.alias("y"), F.col("x.node") == F.col("y.node"), "full_outer")
        open_nodes = cut(pairs.filter(~F.coalesce(same, F.lit(False))).select(F.coalesce("x.node", "y.node").alias("node")))
        if not open_nodes.limit(1).count():
            break
    return depth, open_nodes


def _split(store: DataFrame, key: str, depth: int, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the nodes, and the others. Nodes are broadcast once measured, so rows stay where they are."""
    node = node_of(key, depth) if depth else F.lit(0).cast("long")
    here = store.withColumn("__node", node)
    wanted = nodes.withColumnRenamed("node", "__node")
    return here.join(wanted, "__node", "left_semi").drop("__node"), here.join(wanted, "__node", "left_anti").drop("__node")


def stored_rows(*trees: DataFrame) -> int:
    """Rows of the largest of the stores, by their digests."""
    return max(t.filter("level = 0").agg(F.sum("n")).first()[0] or 0 for t in trees)


def compare(source: DataFrame, stored: DataFrame, key: str, of_source: DataFrame, of_stored: DataFrame) -> DataFrame:
    """``reconcile.compare_stores`` of the two, by their digests: equal leaves are matches without a join."""
    depth, nodes = differing(of_source, of_stored)
    if not nodes.limit(1).count():
        return source.select(key, F.lit("MATCH").alias("outcome"))
    nodes = small_side(nodes)
    open_rows, equal = _split(source, key, depth, nodes)
    there, _ = _split(stored, key, depth, nodes)
    return compare_stores(open_rows, there, key, stored_rows(of_source, of_stored)).unionByName(equal.select(key, F.lit("MATCH").alias("outcome")))


def outcome_counts(source: DataFrame, stored: DataFrame, key: str, of_source: DataFrame, of_stored: DataFrame) -> DataFrame:
    """outcome, n; rows of equal leaves are counted from the digests and read from neither store."""
    depth, nodes = differing(of_source, of_stored)
    nodes = small_side(nodes)
    at_depth = of_source.filter(F.col("level") == depth)
    equal = at_depth.join(nodes, "node", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("MATCH").alias("outcome"), "n").filter("n > 0")
    open_rows, _ = _split(source, key, depth, nodes)
    there, _ = _split(stored, key, depth, nodes)
    return compare_stores(open_rows, there, key, stored_rows(of_source, of_stored)).groupBy("outcome").agg(F.count("*").alias("n")).unionByName(equal).groupBy("outcome").agg(F.sum("n").alias("n"))
