"""Session helpers: sane defaults for local tests and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Conf keys this package relies on.
CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "irspark") -> SparkSession:
    """Local session for tests / bench.  On a cluster use the session you already have."""
    master = master or os.environ.get("IRSPARK_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("IRSPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator of the cluster sets it to a shared filesystem.  Only when
    it is unset (local tests) do we make a scratch folder of our own.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="irspark-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path
