"""Session helpers: durable checkpoints and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a private one only for local masters."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="pairloom-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage of a small table through a reliable checkpoint: lost executors cost no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """The same for tables that grow with the data: written as parquet to the shared folder, so later
    steps read only the columns they use and the planner knows the size."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_bytes: int = 16 << 20) -> DataFrame:
    """The table, written down once, with a broadcast hint only when its files are no larger than
    ``max_bytes``. Beyond that the join is left to the planner (shuffle join, split on skew by AQE)."""
    kept = store(df)
    size = int(kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(kept) if size <= max_bytes else kept
