"""Snapshots that grow: extendible hash buckets, deletes as tombstones.

A snapshot is a folder of immutable files and a numbered manifest. The manifest's
lines are leaves: (depth, code) stands for all keys whose hash begins with these
bits, with the folder of their rows, the number of rows, and the folders of
tombstones that hide some of them. Together leaves cover every hash once.
Leaves that a batch writes share folders (shelves of some ``SHELF_ROWS`` rows) with
their neighbours, so there are as many files as the rows need, not as there are leaves; each
row has the batch and leaf it was written for, by which those of current leaves are told.

* ``upsert`` reads the shelves and writes the leaves that have changes; one that outgrows
  ``capacity`` splits into as many as it needs. All other leaves keep their files.
* ``delete`` writes only the ids; the leaf's rows stay where they are until the
  next upsert there, or ``vacuum``, leaves out what is hidden.

Each takes a number and counts once its manifest is complete; repeating a number changes
nothing, what a failed run left is replaced. Leaves are as many as rows / capacity.

Cases: of several versions of a key the greatest stays, of equal ones the change, of
equal changes the last by content; a null key is a key; null ids delete nothing;
deleting unknown ids, or from an empty snapshot, changes no row; columns
named like those of the manifest pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from casequarry.session import cut
from casequarry.skew import small_side
from casequarry.sources.sinks import current_version, upsert, write_version

CAPACITY = 1_000_000
DEEPEST = 40
SHELF_ROWS = 250_000
MANIFEST = "depth int, code long, path string, n long, hidden array<string>"


@dataclass(frozen=True)
class Leaf:
    depth: int
    code: int
    path: str | None = None
    n: int = 0
    hidden: tuple[str, ...] = ()


def code_of(key: str, depth: Column) -> Column:
    """The first ``depth`` bits of the key's hash."""
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftrightunsigned(xxhash64(`{key}`), 64 - __depth)"))


def shelf_bits(leaves: list[Leaf], rows: int) -> int:
    """So many first bits of the hash name the shelf of a leaf; at most as many as the shallowest leaf has."""
    return min([max(0, (rows - 1) // SHELF_ROWS).bit_length(), *(x.depth for x in leaves)])


def shelf_of(leaf: Leaf, bits: int) -> str:
    return f"__shelf={leaf.code >> leaf.depth - bits}"


@dataclass
class Snapshot:
    spark: SparkSession
    folder: str
    key: str
    version: str
    schema: StructType
    capacity: int = CAPACITY

    def leaves(self) -> tuple[int, list[Leaf]]:
        """Newest complete number (-1 if none) and its leaves."""
        newest = current_version(self.spark, f"{self.folder}/manifests")
        if newest is None:
            return -1, [Leaf(0, 0)]
        rows = self.spark.read.schema(MANIFEST).parquet(newest).collect()
        return int(newest.rsplit("=", 1)[1]), [Leaf(r["depth"], r["code"], r["path"], r["n"], tuple(r["hidden"])) for r in rows]

    def read(self) -> DataFrame:
        return self._rows(self.leaves()[1])

    # -- parts -------------------------------------------------------------------

    def _rows(self, leaves: list[Leaf]) -> DataFrame:
        """Rows of the leaves; only leaves with tombstones are joined with them."""
        plain, hidden = ([x for x in leaves if x.path and bool(x.hidden) == h] for h in (False, True))
        load = lambda some: self._stored([(x, x.path) for x in some], self.schema) if some else None
        out = load(plain)
        if hidden:
            ids = StructType([self.schema[self.key]])
            gone = self._stored([(x, p) for x in hidden for p in x.hidden], ids)
            rest = load(hidden).join(gone, self.key, "left_anti").select(*self.schema.names)
            out = rest if out is None else out.unionByName(rest)
        return self.spark.createDataFrame([], self.schema) if out is None else out

    def _stored(self, wanted: list[tuple[Leaf, str]], schema: StructType) -> DataFrame:
        """What the folders have of these leaves. A folder named by depth and code is a leaf's own."""
        own = sorted({p for _, p in wanted if "/__depth=" in p})
        shared = {(int(re.search(r"batch=(\d+)/__shelf", p)[1]), x.depth, x.code): p for x, p in wanted if "/__depth=" not in p}
        out = self.spark.read.schema(schema).parquet(*own) if own else None
        if shared:
            table = small_side(self.spark.createDataFrame([*shared], "__batch int, __depth int, __code long"))
            full = StructType([*schema]).add("__batch", IntegerType()).add("__depth", IntegerType()).add("__code", LongType())
            rows = self.spark.read.schema(full).parquet(*sorted(set(shared.values())))
            rows = rows.join(table, ["__batch", "__depth", "__code"], "left_semi").select(*schema.names)
            out = rows if out is None else out.unionByName(rows)
        return out

    def _store(self, rows: DataFrame, number: int, target: str, bits: int) -> None:
        """``rows`` with __depth and __code into their shelves."""
        shelf = F.expr(f"shiftrightunsigned(__code, __depth - {bits})")
        rows.withColumns({"__batch": F.lit(number).cast("int"), "__shelf": shelf}).hint("rebalance", F.col("__shelf")).write.mode(
            "overwrite").partitionBy("__shelf").parquet(target)

    def _placed(self, rows: DataFrame, leaves: list[Leaf]) -> DataFrame:
        """``rows`` as ``row`` with the depth and code of their leaf; those of no leaf are left out."""
        table = small_side(self.spark.createDataFrame([(x.depth, x.code) for x in leaves], "__depth int, __code long"))
        depths = F.array(*[F.lit(d) for d in sorted({x.depth for x in leaves})])
        place = rows.select(F.struct("*").alias("row"), F.col(self.key).alias("__key"), F.explode(depths).alias("__depth"))
        return place.withColumn("__code", code_of("__key", F.col("__depth"))).join(table, ["__depth", "__code"]).drop("__key")

    def _publish(self, number: int, leaves: list[Leaf]) -> None:
        lines = [(x.depth, x.code, x.path, x.n, list(x.hidden)) for x in leaves]
        write_version(self.spark.createDataFrame(lines, MANIFEST).coalesce(1), f"{self.folder}/manifests", number)

    def _written(self, number: int, rows: DataFrame, leaves: list[Leaf]) -> list[Leaf]:
        """The leaves that take the place of ``leaves`` once ``rows`` are theirs."""
        placed = cut(self._placed(rows, leaves))
        sizes = {(r["__depth"], r["__code"]): r["n"] for r in placed.groupBy("__depth", "__code").agg(F.count("*").alias("n")).collect()}
        deeper = {}
        for x in leaves:
            n, more = sizes.get((x.depth, x.code), 0), 0
            while n > self.capacity << more and x.depth + more < DEEPEST:
                more += 1
            deeper[x.depth, x.code] = more
        plan = small_side(self.spark.createDataFrame([(*k, k[0] + more) for k, more in deeper.items()], "__old int, __oldcode long, __new int"))
        target = f"{self.folder}/batches/batch={number:08d}"
        out = placed.withColumnsRenamed({"__depth": "__old", "__code": "__oldcode"}).join(plan, ["__old", "__oldcode"]).select(
            "row.*", F.col("__new").alias("__depth")).withColumn("__code", code_of(self.key, F.col("__depth")))
        counts = {(r["__depth"], r["__code"]): r["n"] for r in out.groupBy("__depth", "__code").agg(F.count("*").alias("n")).collect()}
        made = [Leaf(depth + more, child, n=counts.get((depth + more, child), 0)) for (depth, code), more in deeper.items()
                for child in range(code << more, code + 1 << more)]
        bits = shelf_bits(made, sum(counts.values()))
        self._store(out, number, target, bits)
        return [Leaf(x.depth, x.code, f"{target}/{shelf_of(x, bits)}" if x.n else None, x.n) for x in made]

    # -- changes ---------------------------------------------------------------------

    def upsert(self, changes: DataFrame, number: int) -> None:
        done, leaves = self.leaves()
        if done >= number:
            return
        changes = cut(changes.select(*self.schema.names))
        touched = {(r["__depth"], r["__code"]) for r in self._placed(changes, leaves).select("__depth", "__code").distinct().collect()}
        mine = [x for x in leaves if (x.depth, x.code) in touched]
        rest = [x for x in leaves if (x.depth, x.code) not in touched]
        made = self._written(number, upsert(self._rows(mine), changes, self.key, self.version), mine) if mine else []
        self._publish(number, [*rest, *made])

    def delete(self, ids: DataFrame, number: int) -> None:
        done, leaves = self.leaves()
        if done >= number:
            return
        gone = cut(ids.select(F.col(self.key).cast(self.schema[self.key].dataType)).filter(F.col(self.key).isNotNull()).distinct())
        full = [x for x in leaves if x.path] or [Leaf(0, 0)]
        placed = self._placed(gone, full)
        target = f"{self.folder}/deletes/batch={number:08d}"
        bits = shelf_bits(full, sum(x.n for x in full))
        self._store(placed.select("row.*", "__depth", "__code"), number, target, bits)
        touched = {(r["__depth"], r["__code"]) for r in placed.select("__depth", "__code").distinct().collect()}
        self._publish(number, [Leaf(x.depth, x.code, x.path, x.n, (*x.hidden, f"{target}/{shelf_of(x, bits)}"))
                               if x.path and (x.depth, x.code) in touched else x for x in leaves])

    def vacuum(self, number: int) -> None:
        """Leaves with tombstones are written again without what they hide."""
        done, leaves = self.leaves()
        if done >= number:
            return
        mine = [x for x in leaves if x.hidden]
        made = self._written(number, self._rows(mine), mine) if mine else []
        self._publish(number, [*[x for x in leaves if not x.hidden], *made])
