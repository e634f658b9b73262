"""SparkSession construction and shared-folder resolution."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "pulseboard", shuffle_partitions: int = 8) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's own session instead."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", os.environ.get("PULSEBOARD_DRIVER_MEMORY", "8g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may
    leave it unset: a private temporary folder is then created and set. On any
    other master an unset folder is an error, because executors would each
    write their own disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master.startswith("local-cluster") or not master.startswith("local"):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        path = tempfile.mkdtemp(prefix="pulseboard-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:  # each call would add a new sub-folder
        sc.setCheckpointDir(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``: a lost executor costs the tasks it
    was writing and nothing that was committed. Each call takes a new folder.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
