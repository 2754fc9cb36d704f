"""Writers and the collection's load, upsert, delete and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry import schemas as S
from casequarry.functions import vectors as V
from casequarry.skew import latest


def stage(frames: dict[str, DataFrame], folder: str, partition_by: Sequence[str] = (),
          mode: str = "overwrite") -> None:
    """One compressed Parquet folder per table."""
    for name, df in frames.items():
        writer = df.write.mode(mode).option("compression", "zstd")
        columns = [c for c in partition_by if c in df.columns]
        (writer.partitionBy(*columns) if columns else writer).parquet(f"{folder}/{name}")


def hand_off(df: DataFrame, folder: str, run_id: str) -> DataFrame:
    """Write a stage's rows under its run id and read them back; the written
    rows, not their plan, feed the next stage."""
    path = f"{folder}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def backfill(df: DataFrame, folder: str, day_of: Column) -> DataFrame:
    """All days in one job. Only days present in ``df`` are replaced, so a
    re-run of some days leaves the others. Rebalancing keeps the files of a day
    together and splits a day that is much larger than the rest. Returns rows
    per written day."""
    df.withColumn("day", F.to_date(day_of)).hint("rebalance", F.col("day")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("day").parquet(folder)
    return df.groupBy(F.to_date(day_of).alias("day")).agg(F.count("*").alias("rows"))


def write_envelopes(df: DataFrame, folder: str, key: str, rows_per_file: int = 10_000) -> None:
    """``{records, totalSize, done}`` documents of bounded size, one per line.
    Rows are dealt over documents by a hash of ``key`` and their place, so rows
    that repeat a key do not meet in one document."""
    documents = F.ceil(df.agg(F.count("*")).scalar() / rows_per_file)
    slot = F.pmod(F.xxhash64(key, F.monotonically_increasing_id()), F.greatest(F.lit(1), documents))
    packed = df.groupBy(slot.alias("__slot")).agg(
        F.collect_list(F.struct(*df.columns)).alias("records"))
    packed.select(F.to_json(F.struct(
        "records", F.size("records").alias("totalSize"), F.lit(True).alias("done"))).alias("value")
    ).write.mode("overwrite").option("maxRecordsPerFile", 1).text(folder)


def write_csv(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(folder)


def dead_letters(df: DataFrame, key: str, error: str, stage_name: str, at: Column) -> DataFrame:
    """Rows with an error, each with its full payload as JSON."""
    payload = F.to_json(F.struct(*[c for c in df.columns if c != error]))
    return df.filter(F.col(error).isNotNull()).select(
        F.sha2(F.concat_ws("|", F.lit(stage_name), F.col(key).cast("string"), at.cast("string")), 256)
        .alias("failure_id"),
        F.col(key).cast("string").alias("record_id"), F.lit(stage_name).alias("stage"),
        F.split_part(F.col(error), F.lit(":"), F.lit(1)).alias("error_type"),
        F.col(error).alias("error_message"), payload.alias("payload"), at.alias("failed_at"),
        F.lit(0).alias("retry_count"), F.lit(False).alias("resolved"),
        F.lit(None).cast("timestamp").alias("resolved_at"))


def append(df: DataFrame, folder: str, day: str | None = None) -> None:
    """Append to a log table, partitioned by the day of ``day`` if given."""
    if day:
        df.withColumn("day", F.to_date(day)).write.mode("append").partitionBy("day").parquet(folder)
    else:
        df.write.mode("append").parquet(folder)


def search_log(requests: DataFrame, at: Column) -> DataFrame:
    """Log rows: who searched what with which filters, and how many results."""
    return requests.select("user_id", "query", F.to_json("filters").alias("filters"),
                           "result_count", at.alias("logged_at"))


# -- the collection -----------------------------------------------------------

def load_check(df: DataFrame, vector: str, size: int = V.DIMENSIONS) -> DataFrame:
    """Adds ``error``: null when the row's vector is present and sound."""
    return df.withColumn("error", V.vector_error(V.as_double(F.col(vector)), size))


def load_batch(df: DataFrame, folder: str, vector: str, key: str, size: int = V.DIMENSIONS
               ) -> DataFrame:
    """Write sound rows, properties and vectors apart, and return the counts.
    Failed rows go to ``<folder>/failed`` with their reason."""
    checked = load_check(df, vector, size)
    good = checked.filter(F.col("error").isNull())
    good.drop("error", vector).write.mode("append").parquet(f"{folder}/properties")
    good.select(key, F.col(vector).cast("array<float>").alias("vector")).write.mode(
        "append").parquet(f"{folder}/vectors")
    checked.filter(F.col("error").isNotNull()).write.mode("append").parquet(f"{folder}/failed")
    return load_counts(checked)


def load_counts(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count_if(F.col("error").isNull()).alias("success"),
                       F.count_if(F.col("error").isNotNull()).alias("failed"))


def upsert(current: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """Latest version of each key from both sides. An aggregate with map-side
    combine, so a key with many versions does not gather in one task. Of equal
    versions a change wins over what is stored, and of equal changes the one
    that is last by its content, so the result never depends on row order."""
    order = [version, "__new", "__content"]
    both = current.withColumn("__new", F.lit(0)).unionByName(changes.withColumn("__new", F.lit(1)))
    both = both.withColumn("__content", F.to_json(F.struct(*current.columns)))
    return latest(both, [key], order).drop("__new", "__content")


def write_version(df: DataFrame, folder: str, version: int) -> str:
    """Snapshots never overwrite what is being read: each goes to its own
    folder, and the newest complete one is current. What a failed run left of
    a version is replaced."""
    path = f"{folder}/version={version:08d}"
    if _exists(df.sparkSession, f"{path}/_SUCCESS"):
        raise ValueError(f"{path} is complete")
    df.write.mode("overwrite").parquet(path)
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def current_version(spark: SparkSession, folder: str) -> str | None:
    """Newest folder that has its commit marker."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    found = [str(s.getPath()) for s in fs.listStatus(root)
             if s.isDirectory() and _exists(spark, f"{s.getPath()}/_SUCCESS")]
    return max(found) if found else None


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bucket_paths(spark: SparkSession, folder: str) -> tuple[int, dict[int, str]]:
    """Number of the newest complete manifest (-1 if none) and where each
    bucket's rows are; as many lines as there are buckets."""
    newest = current_version(spark, f"{folder}/manifests")
    if newest is None:
        return -1, {}
    rows = spark.read.parquet(newest).collect()
    return int(newest.rsplit("=", 1)[1]), {r["bucket"]: r["path"] for r in rows}


def upsert_buckets(changes: DataFrame, folder: str, key: str, version: str, number: int, buckets: int = 64) -> None:
    """Merge a batch into a snapshot kept in hash buckets of the key.

    Only buckets with changes are read and written again; the others stay where
    they are. A batch counts once its manifest is complete, and repeating a
    batch changes nothing. ``buckets`` stays the same for the life of a folder.
    """
    spark = changes.sparkSession
    done, paths = bucket_paths(spark, folder)
    if done >= number:
        return
    touched = [r["bucket"] for r in changes.select(bucket_of(key, buckets).alias("bucket")).distinct().collect()]
    old = [paths[b] for b in touched if b in paths]
    base = spark.read.schema(changes.schema).parquet(*old) if old else spark.createDataFrame([], changes.schema)
    target = f"{folder}/batches/batch={number:08d}"
    (upsert(base, changes, key, version).withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", F.col("bucket"))
     .write.mode("overwrite").partitionBy("bucket").parquet(target))
    paths.update({b: f"{target}/bucket={b}" for b in touched})
    manifest = spark.createDataFrame(sorted(paths.items()), "bucket int, path string").coalesce(1)
    write_version(manifest, f"{folder}/manifests", number)


def read_buckets(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The current snapshot of ``upsert_buckets``."""
    paths = list(bucket_paths(spark, folder)[1].values())
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def delete(current: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return current.join(ids.select(key), key, "left_anti")


def mark_deleted(current: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    gone = ids.select(key).distinct().withColumn("deleted", F.lit(True))
    return current.join(gone, key, "left").withColumn(
        "deleted", F.coalesce("deleted", F.lit(False)))


def collection_stats(df: DataFrame, vector: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("objects"), F.count_if(F.col(vector).isNotNull()).alias("with_vector"),
        F.min(F.size(vector)).alias("min_dims"), F.max(F.size(vector)).alias("max_dims"))


def schema_gate(df: DataFrame) -> DataFrame:
    """``df`` if it has exactly the collection's columns and types."""
    wrong = S.schema_differences(df.schema, S.COLLECTION)
    if wrong:
        raise ValueError("; ".join(wrong))
    return df


def change_stream(spark: SparkSession, folder: str, schema, archive: str | None = None,
                  fmt: str = "json", **options: str) -> DataFrame:
    """Change events as a stream, from files or any streaming source Spark
    has (``fmt='kafka'`` with its options). With ``archive``, read files move
    there once their batch is complete."""
    reader = spark.readStream.format(fmt)
    if fmt != "kafka":
        reader = reader.schema(schema)
    for name, value in options.items():
        reader = reader.option(name, value)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder) if folder else reader.load()
