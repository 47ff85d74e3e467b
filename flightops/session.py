"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "flightops") -> SparkSession:
    """Session tuned for these plans; an active session is reused as is."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus) * 2))
        .config("spark.driver.memory", os.environ.get("FLIGHTOPS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session without one gets a private scratch folder;
    a cluster session without the setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        configured = tempfile.mkdtemp(prefix="flightops-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: cuts lineage (recovery after executor loss restarts from the
    files) and gives later self-joins a short, distinct plan."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    forget_at_exit(spark, path)
    return spark.read.parquet(path)


def forget_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system drop a staged table when the driver ends, so that shared storage does not fill up."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
