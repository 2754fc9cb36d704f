"""Centroid clustering (k-means) in exact integers, filtered by PCA-rotated bounds.

Every vector becomes integers floor(scale * x). One pass sums first and second
moments; the rotation by their principal axes puts most of the spread into the
first coordinates. Stored per vector: its integers, ``LEAD`` leading rotated
coordinates and the norm of the rest. For a centroid rotated alike,

    distance^2 >= |difference of leads|^2 + (difference of rest norms)^2

so centroids whose bound exceeds the best distance found so far are left out and
the others are measured in integers. A slack for rounding makes the bound safe,
so results do not depend on the rotation, the order of rows or the number of tasks.

A round is one pass over the stored vectors. Tasks send sums per centroid and
component, as parts of 32 bits, so sums are exact whatever their size; the driver gets
k x dimensions of them. No vector moves, so equal vectors cannot gather anywhere.

Cases: a vector with another number of components, a null one or a non-finite
one is left out, as is a null vector; equal vectors and repeated rows count
one by one; null ids are clustered, but start a cluster only if there are too
few other rows; fewer vectors than clusters make fewer clusters; ties in distance go to
the smaller cluster, ties among starts (repeated ids) to the smaller integers; an empty
table gives no rows; distances and inertias beyond a long are null; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from casequarry.session import cut

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, 3
LEAD = 16
SMALL = 1 << 27  # up to here 64 squared differences fit 64 bits
BLOCK = 8192
_LIMB = 32
_LONG = (1 << 63) - 1


def integers(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, v: the kept vectors as whole doubles (all integers they can become are doubles)."""
    x = F.col("embedding")
    fits = F.coalesce((F.size(x) == dimensions) & F.forall(x, lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")), F.lit(False))), F.lit(False))

    def run(batches):
        for batch in batches:
            flat = np.asarray(batch.column("v").flatten(), np.float64)
            whole = pa.array(np.floor(flat * scale))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.ListArray.from_arrays(np.arange(len(batch) + 1, dtype=np.int32) * dimensions, whole)],
                names=["vec_id", "v"])

    kind = dict(vectors.dtypes)["vec_id"]
    return vectors.where(fits).select("vec_id", x.cast("array<double>").alias("v")).mapInArrow(run, f"vec_id {kind}, v array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


@dataclass
class Rotation:
    axes: np.ndarray  # one row per rotated coordinate
    lead: int

    def stored(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and the norm of the others, both rounded to 32 bits."""
        with np.errstate(all="ignore"):
            turned = v @ self.axes.T
            rest = np.sqrt((turned[:, self.lead:] ** 2).sum(axis=1))
            return turned[:, :self.lead].astype(np.float32), rest.astype(np.float32)


def rotation(vectors: DataFrame, dimensions: int = DIMENSIONS, lead: int = LEAD) -> Rotation:
    """Principal axes of all vectors, by moments that Spark adds up."""
    def moments(batches):
        total = np.zeros((dimensions + 1, dimensions + 1))
        for batch in batches:
            with np.errstate(all="ignore"):
                v = np.hstack([_matrix(batch.column("v")), np.ones((len(batch), 1))])
                total += v.T @ v
        i, j = np.triu_indices(dimensions + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "s"])

    rows = vectors.select("v").mapInArrow(moments, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    m = np.zeros((dimensions + 1, dimensions + 1))
    for r in rows:
        m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["s"]
    n = max(m[-1, -1], 1)
    with np.errstate(all="ignore"):
        spread = m[:-1, :-1] / n - np.outer(m[-1, :-1], m[-1, :-1]) / n / n
    if not np.isfinite(spread).all():
        return Rotation(np.eye(dimensions), lead)
    return Rotation(np.linalg.eigh(spread)[1].T[::-1].copy(), lead)


def rotated(vectors: DataFrame, turn: Rotation) -> DataFrame:
    """vec_id, v, lead, rest. Vectors of ordinary size keep their integers in 32 bits each."""
    def run(batches):
        for batch in batches:
            v = _matrix(batch.column("v"))
            lead, rest = turn.stored(v)
            bodies = [(row.astype("<i4") if most <= SMALL else row.astype("<f8")).tobytes() for row, most in zip(v, np.abs(v).max(axis=1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(bodies, pa.binary()), pa.array([x.tobytes() for x in lead], pa.binary()), pa.array(rest)],
                names=["vec_id", "v", "lead", "rest"])

    kind = dict(vectors.dtypes)["vec_id"]
    return vectors.mapInArrow(run, f"vec_id {kind}, v binary, lead binary, rest float")


class Centroids:
    """Centroids as Python integers, with what the filter needs of them."""

    def __init__(self, rows: list[tuple[int, ...]], turn: Rotation):
        self.rows, self.turn = [tuple(map(int, r)) for r in rows], turn
        self.small = all(abs(x) <= SMALL for r in self.rows for x in r)
        floats = np.array([[float(x) for x in r] for r in self.rows]).reshape(len(self.rows), -1)
        self.lead, self.rest = (x.astype(np.float64) for x in turn.stored(floats))
        self.norm = np.sqrt((floats ** 2).sum(axis=1)) if self.small else None
        self.whole = np.array(self.rows, np.int64) if self.small else None
        self.measured = 0  # distances computed in integers

    def bounds(self, lead: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """No squared distance is smaller than this."""
        norm = np.sqrt((lead ** 2).sum(axis=1) + rest ** 2)
        away = ((lead[:, None, :] - self.lead[None]) ** 2).sum(axis=2) + (rest[:, None] - self.rest[None]) ** 2
        slack = 1e-6 * (norm[:, None] + self.norm[None]) + 1e-6  # 32-bit rounding is below 2e-7 of a norm
        return np.maximum(np.sqrt(away) - slack, 0) ** 2

    def nearest(self, v: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance of rows of whole numbers within ``SMALL``."""
        low = self.bounds(lead.astype(np.float64), rest.astype(np.float64))
        first = low.argmin(axis=1)
        cluster, best = first.copy(), self._exact(v, self.whole[first])
        for c in range(len(self.rows)):
            open_rows = np.flatnonzero((low[:, c] <= best) & (first != c))
            if len(open_rows):
                d = self._exact(v[open_rows], self.whole[c])
                won = (d < best[open_rows]) | ((d == best[open_rows]) & (c < cluster[open_rows]))
                cluster[open_rows[won]], best[open_rows[won]] = c, d[won]
        return cluster, best

    def _exact(self, v: np.ndarray, c: np.ndarray) -> np.ndarray:
        self.measured += len(v)
        return ((v - c) ** 2).sum(axis=1)

    def nearest_any(self, row: list[int]) -> tuple[int, int]:
        """The same for one vector of any size."""
        d, c = min((sum((a - b) ** 2 for a, b in zip(row, c)), k) for k, c in enumerate(self.rows))
        return c, d


def _assigned(batch: pa.RecordBatch, model: Centroids):
    """Per block of rows: the rows' numbers, their components, clusters and distances."""
    sizes = np.asarray(pc.binary_length(batch.column("v")))
    dimensions = len(model.rows[0])
    narrow = np.flatnonzero(sizes == 4 * dimensions) if model.small else np.zeros(0, np.int64)
    for at in range(0, len(narrow), BLOCK):
        mine = pa.array(narrow[at:at + BLOCK])
        v, lead = (np.frombuffer(b"".join(batch.column(c).take(mine).to_pylist()), t).reshape(len(mine), -1) for c, t in (("v", "<i4"), ("lead", "<f4")))
        rest = np.asarray(batch.column("rest").take(mine), np.float32)
        yield narrow[at:at + BLOCK], v, *model.nearest(v.astype(np.int64), lead, rest)
    for row in np.setdiff1d(np.arange(len(batch)), narrow).tolist():
        body = batch.column("v")[row].as_py()
        v = [int(x) for x in np.frombuffer(body, "<i4" if len(body) == 4 * dimensions else "<f8")]
        cluster, distance = model.nearest_any(v)
        yield np.array([row]), [v], np.array([cluster]), [distance]


def _limbs(x: int) -> list[int]:
    """Whole numbers of 32 bits that make up x, the last one with its sign."""
    out = []
    while not -(1 << _LIMB - 1) <= x < 1 << _LIMB - 1:
        out.append(x & (1 << _LIMB) - 1)
        x >>= _LIMB
    return [*out, x]


def sums(stored: DataFrame, model: Centroids) -> dict[tuple[int, int], int]:
    """Exact sum of each component per cluster; at component -1 the number of vectors."""
    def run(batches):
        totals: dict[tuple[int, int], int] = {}
        for batch in batches:
            for _, v, cluster, _ in _assigned(batch, model):
                for c in set(cluster.tolist()):
                    mine = np.flatnonzero(cluster == c)
                    parts = v[mine].sum(axis=0, dtype=np.int64).tolist() if isinstance(v, np.ndarray) else v[0]
                    for j, x in enumerate(parts):
                        totals[c, j] = totals.get((c, j), 0) + x
                    totals[c, -1] = totals.get((c, -1), 0) + len(mine)
        rows = [(c, j, at, x) for (c, j), total in totals.items() for at, x in enumerate(_limbs(total))]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                         names=["c", "j", "at", "x"])

    found = stored.mapInArrow(run, "c int, j int, at int, x long").groupBy("c", "j", "at").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    out: dict[tuple[int, int], int] = {}
    for r in found:
        out[r["c"], r["j"]] = out.get((r["c"], r["j"]), 0) + (int(r["x"]) << _LIMB * r["at"])
    return out


def starts(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[tuple[int, ...]]:
    """The vectors with the smallest sha256 of "seed:vec_id"."""
    text = F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string"))
    first = vectors.select(F.sha2(text, 256).alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(clusters).collect()
    return [tuple(int(x) for x in r["v"]) for r in first]


def fit(stored: DataFrame, rows: list[tuple[int, ...]], turn: Rotation, rounds: int = ROUNDS) -> Centroids:
    model = Centroids(rows, turn)
    for _ in range(rounds):
        found = sums(stored, model)
        moved = [tuple(found[c, j] // found[c, -1] for j in range(len(row))) if (c, -1) in found else row
                 for c, row in enumerate(model.rows)]
        if moved == model.rows:
            break  # further rounds would change nothing
        model = Centroids(moved, turn)
    return model


def assign(stored: DataFrame, model: Centroids) -> DataFrame:
    """vec_id, cluster, distance."""
    def run(batches):
        for batch in batches:
            cluster, distance = np.zeros(len(batch), np.int32), [0] * len(batch)
            for rows, _, c, d in _assigned(batch, model):
                cluster[rows] = c
                for row, x in zip(rows.tolist(), d if isinstance(d, list) else d.tolist()):
                    distance[row] = x if x <= _LONG else None
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster), pa.array(distance, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])

    return stored.mapInArrow(run, f"vec_id {dict(stored.dtypes)['vec_id']}, cluster int, distance long")


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
            scale: int = SCALE, seed: int = SEED, lead: int = LEAD) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    kept = integers(vectors, dimensions, scale)
    first = starts(kept, clusters, seed)
    turn = rotation(kept, dimensions, min(lead, dimensions))
    stored = cut(rotated(kept, turn))
    model = fit(stored, first, turn, rounds) if first else Centroids([(0,) * dimensions], turn)
    placed = cut(assign(stored, model))
    per = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"),
                                        F.count_if(F.col("distance").isNull()).alias("beyond")).collect()
    fits = lambda x: x if x is not None and x <= _LONG else None
    of = {r["cluster"]: None if r["beyond"] else int(r["s"]) for r in per}
    total = fits(None if None in of.values() else sum(of.values()))
    names = [(c, fits(of.get(c)), total, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(model.rows)]
    table = spark.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
