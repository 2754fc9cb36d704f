"""Session helpers. Cluster settings always win over the ones here."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "casequarry",
                  **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster use the one submitted."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CASEQUARRY_DRIVER_MEMORY", "12g"))
        .config("spark.log.level", "ERROR")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that results depend on (time zone), set on any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own;
    on a cluster a missing setting is an error, since a machine-local folder
    is lost with its machine.
    """
    context = spark.sparkContext
    configured = (context.getConf().get("spark.checkpoint.dir")
                  or spark.conf.get("spark.checkpoint.dir", None))
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="casequarry-ckpt-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder and drop its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
