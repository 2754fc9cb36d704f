"""Nearest neighbours by cells with bounds: only part of the rows is scored, none is lost.

Every row belongs to the cell of its nearest centre. A cell knows its radius, the
largest distance of a row from the centre, and a row its own distance. For unit
vectors with distance d the cosine is 1 - d^2 / 2, and by the triangle inequality

* no row of a cell is nearer to a query than (distance of the centre) - radius,
* no row is nearer than the difference of its and the query's distance to the centre.

A search visits the cells of a query in order of the first bound, some per round and
twice as many in each further one, until no unvisited cell can hold a row better than
the k-th found. In a visited cell the second bound leaves rows out. The result is
that of scoring every row, whatever the centres are; they decide the share scored.

Rows and queries meet by cell, a cell is dealt over salts, ranking is in two levels.
Cells are at most ``MOST_CELLS``; their centres and radii ride along as one value.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isfinite

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.window import Window

from casequarry.functions import vectors as V
from casequarry.operators.search import DEFAULT_LIMIT, DIGITS, kmeans_centres
from casequarry.session import cut
from casequarry.skew import salt_of, salts, top_n

MOST_CELLS = 1024
BLOCK = 2048  # rows measured against all centres at once
SLACK = 1e-7  # of a distance or a cosine: far above rounding, far below what matters
SAMPLE = 100_000  # rows that centres are fitted on; every row is indexed


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def unit(vector: Column) -> Column:
    return V.l2_normalize(V.as_double(vector))


@dataclass
class CellIndex:
    """``rows``: id, cell, unit, off (distance to the centre); ``balls``: cell, centre, radius, n."""
    rows: DataFrame
    balls: DataFrame
    doc_id: str

    def write(self, folder: str) -> None:
        """Rows in one folder per cell, so that a reader of some cells opens no others."""
        self.rows.hint("rebalance", F.col("cell")).write.mode("overwrite").partitionBy("cell").parquet(f"{folder}/rows")
        self.balls.coalesce(1).write.mode("overwrite").parquet(f"{folder}/balls")

    @classmethod
    def read(cls, spark: SparkSession, folder: str, doc_id: str) -> "CellIndex":
        rows = spark.read.parquet(f"{folder}/rows")
        return cls(rows.select(doc_id, "cell", "unit", "off"), spark.read.parquet(f"{folder}/balls"), doc_id)


def build(corpus: DataFrame, doc_id: str, vector: str, cells: int = 0, centres: DataFrame | None = None) -> CellIndex:
    """An index of every row with a vector. ``centres`` (cell, centre) are given, or found by k-means on
    at most some ``SAMPLE`` rows; ``cells`` defaults to the root of the number of rows."""
    usable = corpus.filter(F.col(vector).isNotNull()).select(doc_id, unit(F.col(vector)).alias("unit"))
    if centres is None:
        n = usable.count()
        cells = cells or max(1, min(MOST_CELLS, round(n ** 0.5)))
        share = -(-n // SAMPLE) if n else 1
        centres = kmeans_centres(usable.filter(F.pmod(F.xxhash64(doc_id), F.lit(share)) == 0), "unit", min(cells, max(n, 1))) if n else (
            corpus.sparkSession.createDataFrame([], "cell int, centre array<double>"))
    rows = cut(nearest(usable, doc_id, centres.select("cell", unit(F.col("centre")).alias("centre"))))
    radii = rows.groupBy("cell").agg(F.max("off").alias("radius"), F.count("*").alias("n"))
    balls = cut(centres.select("cell", unit(F.col("centre")).alias("centre")).join(radii, "cell"))
    return CellIndex(rows, balls, doc_id)


def nearest(usable: DataFrame, doc_id: str, centres: DataFrame) -> DataFrame:
    """id, cell, unit, off of rows (id, unit): the nearest centre, ties to the smaller cell, by matrix products in blocks."""
    spark = usable.sparkSession
    found = sorted((r["cell"], r["centre"]) for r in centres.collect())  # MOST_CELLS at most
    # Null or unequal dimensions compare as in Column arithmetic, which rows without a distance get too.
    table = centres.agg(F.sort_array(F.collect_list(F.struct("cell", "centre")))).scalar()
    near = F.array_min(F.transform("__cells", lambda c: F.struct(distance(F.col("unit"), c["centre"]).alias("off"), c["cell"].alias("cell"))))
    by_column = lambda rows: rows.withColumn("__cells", table).withColumn("__near", near).select(
        doc_id, F.col("__near.cell").alias("cell"), "unit", F.col("__near.off").alias("off"))
    size = len(found[0][1]) if found and found[0][1] is not None else 0
    if not size or any(c is None or len(c) != size or not all(x is not None and isfinite(x) for x in c) for _, c in found):
        return by_column(usable)
    shared = spark.sparkContext.broadcast((np.array([c for c, _ in found]), np.array([c for _, c in found], np.float64)))

    def run(batches):
        names, points = shared.value
        own = (points * points).sum(axis=1)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                flat = batch.column("unit").flatten().to_numpy(zero_copy_only=False)
                rows = flat.reshape(-1, size)
                place = np.argmin(own - 2 * (rows @ points.T), axis=1)
                gap = rows - points[place]
                yield pa.RecordBatch.from_arrays([batch.column(doc_id), pa.array(names[place], pa.int64()), batch.column("unit"),
                                                  pa.array(np.sqrt((gap * gap).sum(axis=1)))], names=[doc_id, "cell", "unit", "off"])

    plain = F.coalesce((F.size("unit") == size) & F.forall("unit", lambda x: x.isNotNull() & (F.abs(x) <= 2)), F.lit(False))
    kind = dict(usable.dtypes)[doc_id]
    fast = usable.where(plain).select(doc_id, "unit").mapInArrow(run, f"`{doc_id}` {kind}, cell long, unit array<double>, off double")
    return fast.withColumn("cell", F.col("cell").cast(centres.schema["cell"].dataType)).unionByName(by_column(usable.where(~plain)))


def _reach(far: Column, radius: Column) -> Column:
    """The best cosine a row within ``radius`` of a point at distance ``far`` can have."""
    gap = F.greatest(far - radius - SLACK, F.lit(0.0))
    return 1 - gap * gap / 2


def search(index: CellIndex, queries: DataFrame, limit: int = DEFAULT_LIMIT, first: int = 2) -> tuple[DataFrame, int]:
    """Ranked results of every query (query_id, rank, id, score), and how many pairs of query and row were scored.

    ``queries`` has query_id and vector; null vectors are not searched. Scores are certainties, ties go to the smaller id.
    """
    spark, doc_id = queries.sparkSession, index.doc_id
    parts = salts(spark)
    asked = queries.filter(F.col("vector").isNotNull()).select("query_id", unit(F.col("vector")).alias("q")).dropDuplicates(["query_id"])
    table = index.balls.agg(F.sort_array(F.collect_list(F.struct("cell", "centre", "radius")))).scalar()
    ball = F.explode(F.transform("__balls", lambda b: F.struct(
        b["cell"].alias("cell"), distance(F.col("q"), b["centre"]).alias("far"), b["radius"].alias("radius"))))
    order = Window.partitionBy("query_id").orderBy(F.desc("reach"), "cell")
    plan = asked.withColumn("__balls", table).select("query_id", "q", ball.alias("b")).select(
        "query_id", "q", "b.cell", "b.far", _reach(F.col("b.far"), F.col("b.radius")).alias("reach")).withColumn(
        "turn", F.row_number().over(order))
    plan = cut(plan)
    rows = index.rows.select(doc_id, "cell", F.col("unit").alias("__unit"), "off", salt_of([F.col(doc_id)], parts).alias("__part"))
    best, total, done, width = None, 0, 0, first
    while True:
        visit = plan.filter((F.col("turn") > done) & (F.col("turn") <= done + width))
        if best is not None:
            visit = visit.join(worst, "query_id", "left").filter(F.col("least").isNull() | (F.col("reach") >= F.col("least")))
        else:
            visit = visit.withColumn("least", F.lit(None).cast("double"))
        # A row further out, or further in, than the query by more than this cannot be among the best.
        span = F.when(F.col("least").isNotNull(), F.sqrt(F.greatest(2 - 2 * F.col("least"), F.lit(0.0))) + SLACK)
        dealt = visit.withColumn("span", span).withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        met = rows.join(dealt, ["cell", "__part"]).filter(F.col("span").isNull() | (F.abs(F.col("off") - F.col("far")) <= F.col("span")))
        scored = met.select("query_id", doc_id, F.round(V.certainty(V.dot(F.col("__unit"), F.col("q"))), DIGITS).alias("score"))
        seen = Observation()
        scored = scored.observe(seen, F.count(F.lit(1)).alias("n"))
        found = scored if best is None else best.select("query_id", doc_id, "score").unionByName(scored)
        best = cut(top_n(found, ["query_id"], [F.desc("score"), F.asc(doc_id)], limit, "rank", [doc_id]))
        total += seen.get["n"]
        # The k-th cosine, a little lower; null while a query has fewer than k rows.
        worst = best.filter(F.col("rank") == limit).select("query_id", (2 * F.col("score") - 1 - SLACK).alias("least"))
        done, width = done + width, 2 * (done + width)
        left = plan.filter(F.col("turn") > done).join(worst, "query_id", "left").filter(
            F.col("least").isNull() | (F.col("reach") >= F.col("least"))).limit(1).count()
        if not left:
            break
    return best.select("query_id", "rank", doc_id, "score"), total
