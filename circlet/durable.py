"""Intermediate tables that outlive lost executors, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 50_000
TASK_ROWS = 400_000  # wide rows that a task sorts in memory
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names, else a fresh one in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if named.startswith("file:") and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must be a folder that all machines of the cluster share")
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
    return _LOCAL.setdefault(context.applicationId, tempfile.mkdtemp(prefix="circlet-"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write the table to the shared folder once and read it back; cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/circlet-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Broadcast hint only when the table really has at most ``rows`` rows."""
    small = df.limit(rows + 1).count() <= rows
    return (F.broadcast(df) if small else df), small


def spread(df: DataFrame, keys: list, rows: int, per_task: int = TASK_ROWS) -> DataFrame:
    """Rows with equal keys in one partition, of about ``per_task`` rows where ``rows`` come in all.

    A table too large for that leaves neither the configured number of partitions nor the size to which Spark merges
    them in force: both make tasks grow with the table until they spill.
    """
    n = -(-rows // per_task)
    return df.repartition(n, *keys) if n > df.sparkSession.sparkContext.defaultParallelism else df.repartition(*keys)
