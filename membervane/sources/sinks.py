"""Writing tables, delimited deliverables and check results."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from membervane.operators.schema import upper_columns


def export_csv(df: DataFrame, path: str, compression: str | None = None, single_file: bool = False) -> None:
    """Write delimited files with a header: a folder of as many as the result has partitions.

    ``single_file`` writes one file under exactly that path instead; then all rows pass through one task, so
    the caller decides it for results known to be small.
    """
    folder = f"{path.rstrip('/')}-parts-{uuid.uuid4().hex}" if single_file else path
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(folder)
    if single_file:
        hadoop = df.sparkSession._jvm.org.apache.hadoop.fs
        source, target = hadoop.Path(folder), hadoop.Path(path)
        files = source.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
        (part,) = [s.getPath() for s in files.listStatus(source) if s.getPath().getName().startswith("part-")]
        files.delete(target, True)
        if not files.rename(part, target):
            raise OSError(f"cannot name the written file {path}")
        files.delete(source, True)


def replace_table(df: DataFrame, name: str, path: str | None = None, upper: bool = False) -> None:
    """Overwrite a catalog table and its schema; ``upper`` publishes upper-case names."""
    out = upper_columns(df) if upper else df
    writer = out.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def truncate_append(
    df: DataFrame, path: str, partition: str | None = None, single_value: bool = False
) -> None:
    """Replace a table's rows: all of them, or only those of the partitions ``df`` has rows for.

    Rows are first gathered by partition value, so that a partition gets few files; a value with
    very many rows is split over several tasks. Needless where there is a ``single_value``.
    """
    if partition is None:
        df.write.mode("overwrite").parquet(path)
        return
    gathered = df if single_value else df.hint("rebalance", F.col(partition))
    writer = gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)


def write_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, order: Sequence[str] = (), path: str | None = None
) -> None:
    """Overwrite a catalog table stored in ``buckets`` buckets of one key, one sorted file each.

    Tables with the same key and number of buckets join on it without an exchange (``joins.co_located``). Rows are dealt by the key once, here.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
    writer = writer.bucketBy(buckets, key).sortBy(key, *order)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_result(report: DataFrame, path: str) -> None:
    """Write a check report, one JSON object per line."""
    report.write.mode("overwrite").json(path)


def publish(tables: Mapping[str, DataFrame], folder: str, period: int) -> DataFrame:
    """Write several tables of one period, and last the manifest that names what was written.

    Every run writes to a path of its own, and rows are counted while they are written. A manifest row carries
    path and count, so readers that start from the manifest (``read_published``) see the former
    month until all tables of the new one are there, and an empty table replaces a full one.
    """
    spark = next(iter(tables.values())).sparkSession
    manifest = []
    for name, df in tables.items():
        target = f"{folder.rstrip('/')}/{name}/period={period}-{uuid.uuid4().hex}"
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(target)
        manifest.append((name, period, counted.get["rows"], target))
    listing = spark.createDataFrame(manifest, "table_name string, period int, row_count long, path string")
    truncate_append(listing, f"{folder.rstrip('/')}/manifest", "period", single_value=True)
    return listing


def read_published(spark: SparkSession, folder: str, name: str, period: int) -> DataFrame:
    """The rows of a table that the manifest names for a period."""
    listed = spark.read.parquet(f"{folder.rstrip('/')}/manifest")
    row = listed.filter((F.col("period") == period) & (F.col("table_name") == name)).first()
    if row is None:
        raise ValueError(f"{name} is not published for {period}")
    return spark.read.parquet(row["path"])
