"""From raw documents to packed training sequences.

Stages, in order: quality classifier, near-duplicates, benchmark decontamination,
personal data, packing. A stage is a function (spark, docs, sf_dir) -> DataFrame;
all but the last return the columns of the documents. ``run`` writes each result
as Parquet into the shared folder of ``spark.checkpoint.dir`` and reads it again,
so a lost executor never costs more than one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from casequarry.llm import decontaminate, near_copies, packing, quality, sanitise
from casequarry.llm.common import table
from casequarry.llm.queries import tokenizer_path
from casequarry.session import checkpoint_dir


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of rewritten texts, where the table has that column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.length("text").cast(docs.schema["n_chars"].dataType)))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (5-word Jaccard 0.8 or more) the document with the smallest id stays."""
    return near_copies.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside benchmark windows are cut out."""
    return _counted(decontaminate.clean(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and what reveals it is replaced."""
    return _counted(sanitise.clean(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

# A trained network, hashed shingle sets and a tokenizer are beyond SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
