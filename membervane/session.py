"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A single hot member can fill most of a join partition: split it, even where that
    # costs an extra exchange further down the plan.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_scratch: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators rely on; leaves sizing to the cluster."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir``, or a private one where driver and executors are one process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="membervane-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that nobody used before."""
    return f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and return a scan of what was written.

    Unlike a cached frame the result survives lost executors, keeps column pruning, and
    fixes the outcome of expressions that depend on the row order.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
