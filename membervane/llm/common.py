"""What the text operators share: reading, staging, word counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from membervane.session import scratch_path

#: A word: a run of anything but the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder (zstd) and scan it from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pd.DataFrame], rows: int = 500) -> Iterator[pd.DataFrame]:
    """Batches cut into smaller ones, so that what a function returns at once stays small beside what it was given."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows].reset_index(drop=True)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def nullable(df: DataFrame) -> T.StructType:
    """The schema of ``df`` with all columns nullable: for frames that Python functions return."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])


def with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """That schema with one more column."""
    return nullable(df).add(name, kind)


def unused(name: str, columns: list[str]) -> str:
    """A column name made of ``name`` that none of ``columns`` has, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
