"""Vector checks and maths, and the embedding hop."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, FloatType, StringType, StructField, StructType)

DIMENSIONS = 3072
Embedder = Callable[[list[str]], list[list[float]]]


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column, b: Column) -> Column:
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def certainty(cos: Column) -> Column:
    return (cos + 1) / 2


def l2_normalize(v: Column) -> Column:
    """Unit length; a zero vector stays as it is. The norm is folded once and
    carried into the map through a one-element array."""
    return F.flatten(F.transform(F.array(norm(v)), lambda n: F.transform(
        v, lambda x: F.when(n > 0, x / n).otherwise(x))))


def pad(v: Column, size: int) -> Column:
    """Zeros up to ``size``; longer vectors are kept for the size check."""
    missing = F.greatest(F.lit(0), F.lit(size) - F.size(v))
    return F.concat(v, F.array_repeat(F.lit(0.0), missing).cast("array<double>"))


def vector_error(v: Column, size: int = DIMENSIONS) -> Column:
    """Null when the vector can be loaded, else the first failed check."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (F.when(v.isNull(), "missing vector")
            .when(F.size(v) != size, F.concat(F.lit("wrong dimensions: "), F.size(v).cast("string")))
            .when(bad, "not finite")
            .when(norm(v) == 0, "zero magnitude"))


def profile(df: DataFrame, vector: str) -> DataFrame:
    v = as_double(F.col(vector))
    return df.withColumn("__v", v).select(
        *[c for c in df.columns if c != vector], F.size("__v").alias("dims"),
        norm(F.col("__v")).alias("magnitude"), F.array_min("__v").alias("smallest"),
        F.array_max("__v").alias("largest"))


class HashingEmbedder:
    """Offline default: signed hashed word counts, unit length. Stands in for
    a remote model; any ``texts -> vectors`` callable can replace it."""

    def __init__(self, size: int = DIMENSIONS):
        self.size = size

    def __call__(self, texts: list[str]) -> list[list[float]]:
        import re
        import zlib
        out = np.zeros((len(texts), self.size), dtype=np.float32)
        for row, text in enumerate(texts):
            for word in re.findall(r"\w+", text.lower()):
                code = zlib.crc32(word.encode())
                out[row, code % self.size] += 1.0 if code & 0x80000000 else -1.0
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return list(out / np.where(length > 0, length, 1))


def embed(df: DataFrame, text: str, embedder: Embedder, size: int = DIMENSIONS,
          out: str = "embedding", batch: int = 100, retries: int = 1) -> DataFrame:
    """Embed a text column in batches, order kept.

    Blank text gives a zero vector without a call. A failing batch is retried
    text by text; a text that still fails gives a zero vector and its message
    in ``<out>_error``. Only the text crosses to Python with the other columns.
    """
    error = f"{out}_error"
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(FloatType())),
                         StructField(error, StringType())])
    zero = [0.0] * size

    def one(value: str) -> tuple[list[float], str | None]:
        message = None
        for _ in range(retries + 1):
            try:
                return embedder([value])[0], None
            except Exception as failure:  # noqa: BLE001 - kept as a row value
                message = f"{type(failure).__name__}: {failure}"
        return zero, message

    def many(values: list[str]) -> list[tuple[list[float], str | None]]:
        try:
            return [(v, None) for v in embedder(values)]
        except Exception:  # noqa: BLE001 - fall back to single texts
            return [one(v) for v in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only ``batch`` rows at a time become Python values, whatever comes in one Arrow batch.
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                part = whole.slice(at, batch)
                texts = [t or "" for t in part.column(text).to_pylist()]
                filled = [t.strip() != "" for t in texts]
                results = iter(many([t for t, use in zip(texts, filled) if use]) if any(filled) else [])
                found = [next(results) if use else (zero, None) for use in filled]
                vectors = pa.array([np.asarray(v, np.float32) for v, _ in found], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([*part.columns, vectors, pa.array([m for _, m in found], pa.string())],
                                                 names=[*part.schema.names, out, error])

    return df.mapInArrow(run, schema)


def embed_issue_resolution(df: DataFrame, embedder: Embedder, size: int = DIMENSIONS, issue: str = "issue_text",
                           resolution: str = "resolution_text") -> DataFrame:
    """Two vectors per case: ``issue_vector`` and ``resolution_vector``."""
    first = embed(df, issue, embedder, size, "issue_vector")
    return embed(first, resolution, embedder, size, "resolution_vector")


def embed_distinct(df: DataFrame, text: str, embedder: Embedder, size: int = DIMENSIONS,
                   out: str = "embedding") -> DataFrame:
    """Embed each distinct text once, then give every copy its vector.

    The first shuffle keeps one row per text hash (map tasks drop copies
    first). In the way back the distinct side is unique, so a hot text only
    makes the row side skewed, which the adaptive skew join splits.
    """
    keyed = df.withColumn("__key", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    distinct = keyed.groupBy("__key").agg(F.first(text).alias(text))
    vectors = embed(distinct, text, embedder, size, out).drop(text)
    return keyed.join(vectors, "__key", "left").drop("__key")


def with_fallback(primary: Column, backup: Column, size: int, names: tuple[str, str]) -> list[Column]:
    """Primary vector, else the padded backup, and which one it was."""
    usable = vector_error(primary, size).isNull()
    return [F.when(usable, primary).otherwise(pad(backup, size)).alias("embedding"),
            F.when(usable, names[0]).when(backup.isNotNull(), names[1]).alias("embedding_model")]


def success_rate(df: DataFrame, vector: str, size: int) -> DataFrame:
    v = as_double(F.col(vector))
    return df.agg(
        F.count("*").alias("vectors"),
        F.avg(F.when(vector_error(v, size).isNull(), 1.0).otherwise(0.0)).alias("success_rate"),
        F.count_if(F.coalesce(F.size(v) != size, F.lit(True))).alias("wrong_dimensions"))
