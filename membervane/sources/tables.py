"""Reading tables, periods, delimited files and the newest snapshot of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from membervane.operators.schema import lower_columns, resolve_column


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or parquet files by path."""
    if "/" in name:
        return spark.read.parquet(name)
    return spark.table(name)


def scan_period(
    df: DataFrame, first: int, last: int | None = None, column: str = "periodo", require_rows: bool = True
) -> DataFrame:
    """Rows of one period, or of a range of periods, with lower-case column names.

    The comparison is on the plain column, so it prunes partitions and reaches the scan. An
    empty period is an error unless ``require_rows`` is off.
    """
    name = resolve_column(df, column)
    if name is None:
        raise ValueError(f"no column {column} to select a period by")
    period = F.col(name)
    rows = df.filter(period == first if last is None else period.between(first, last))
    if require_rows and rows.isEmpty():
        raise ValueError(f"no rows for period {first}" + ("" if last is None else f" to {last}"))
    return lower_columns(rows)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    index_column: str | None = None,
    separator: str = ",",
) -> DataFrame:
    """Delimited files with a header, plain or gzip, in a given schema.

    ``index_column`` names a leading column of row numbers in the schema that is dropped.
    """
    df = spark.read.schema(schema).option("header", True).option("sep", separator)
    df = df.option("enforceSchema", False).csv(path)
    return df.drop(index_column) if index_column else df


def list_files(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """Name, path and modification time of every file below the folders; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "path",
        F.col("modificationTime").alias("modified"),
    )


def list_snapshots(files: DataFrame) -> DataFrame:
    """Snapshots of a listing: a written folder of part files is one, under the folder's name; so is any other file.

    The newest of its files dates a snapshot.
    """
    part = F.col("name").rlike("^part-[0-9]{5}")
    path = F.when(part, F.regexp_replace("path", "/[^/]+$", "")).otherwise(F.col("path"))
    grouped = files.groupBy(path.alias("path")).agg(F.max("modified").alias("modified"))
    return grouped.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "modified")


def latest_snapshot(files: DataFrame, period: str | Column, token: str, exclude: str | None = None) -> DataFrame:
    """The newest file or snapshot whose name contains the token and the period tag; a single row.

    Without such a file the newest one with the token is taken, without that none. Names that
    contain ``exclude``, such as outputs of the same job, are left out.
    """
    tag = F.lit(period) if isinstance(period, str) else period
    named = files.filter(F.lower("name").contains(token.lower()))
    if exclude is not None:
        named = named.filter(~F.lower("name").contains(exclude.lower()))
    return (
        named.withColumn("in_period", F.col("name").contains(tag))
        .orderBy(F.col("in_period").desc(), F.col("modified").desc(), F.col("name"))
        .limit(1)
    )


def find_snapshot(
    spark: SparkSession, folder: str | list[str], period: str, token: str, exclude: str | None = None
) -> str:
    """Path of the newest snapshot of a period below the folders, see ``latest_snapshot``."""
    found = latest_snapshot(list_snapshots(list_files(spark, folder)), period, token, exclude).first()
    if found is None:
        raise FileNotFoundError(f"no snapshot with {token!r} in its name below {folder}")
    return found["path"]


def read_snapshot(
    spark: SparkSession,
    folder: str | list[str],
    period: str,
    token: str,
    schema: T.StructType | str,
    exclude: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """All rows of the newest snapshot of a period; ``path`` names one instead of the search."""
    return read_csv(spark, path or find_snapshot(spark, folder, period, token, exclude), schema)
