"""Session helpers: settings for local runs and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "paceframe") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; only a local session gets one of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get(CHECKPOINT_KEY, None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="paceframe-ckpt-"))
    else:
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for a written table, below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write a table once to the shared folder and read it back.

    Fits scan their input several times. A written table cuts the lineage, keeps
    column pruning, survives lost executors, and gives later joins its true size.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
