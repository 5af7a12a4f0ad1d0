"""Session construction and the shared work folder.

Intermediate tables (published layers, incremental batches, checkpoints) are
written under the folder the cluster names in ``spark.checkpoint.dir``.  The
library only sets one itself when none is configured *and* the master is local
(tests, the bench); on a cluster an unset directory is an error, because a
machine-local folder would vanish with its executor.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "starmart") -> SparkSession:
    """Session for tests and the bench: UI off, UTC, AQE on."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STARMART_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: configure a shared folder "
                "(HDFS/S3/ABFS) for intermediate tables on this cluster")
        root = tempfile.mkdtemp(prefix="starmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


#: Written tables: the hex keys, half of a line's bytes, take half the room that Spark's default leaves them.
PARQUET = {"compression": "zstd"}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique table location under the shared work folder."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back: for what is read more than once."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**PARQUET).parquet(path)
    return df.sparkSession.read.parquet(path)
