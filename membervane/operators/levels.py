"""Level dictionaries: categories as the training months knew them.

A dictionary is a table (column, level, position, rows). Later months are read against it: a value that it doesn't have
counts as one agreed level, whatever the month brings, so that models and reports keep their categories.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The level of values that the dictionary doesn't have.
UNSEEN = "(unseen)"
#: Levels of one column that a model carries; longer columns are no categories.
MOST_LEVELS = 10_000


def count_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column and value (column, level, rows), missing values as a null level; all columns in one grouping."""
    pairs = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "level")
    return pairs.groupBy("column", "level").agg(F.count(F.lit(1)).alias("rows"))


def level_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The dictionary of ``df``: levels of every column, numbered from 0 by falling frequency, then by name."""
    order = Window.partitionBy("column").orderBy(F.col("rows").desc(), "level")
    known = count_levels(df, columns).where(F.col("level").isNotNull())
    return known.select("column", "level", (F.row_number().over(order) - 1).alias("position"), "rows")


def with_levels(df: DataFrame, levels: DataFrame, columns: Sequence[str], unseen: str = UNSEEN) -> DataFrame:
    """``df`` with the values of ``columns`` as text, those that the dictionary doesn't have as ``unseen``; missing values stay missing.

    One join per column with that column's levels; whether these are small enough to broadcast is left to Spark.
    """
    for at, c in enumerate(columns):
        known = levels.where(F.col("column") == c).select(F.col("level").alias(f"_level_{at}"))
        df = df.withColumn(c, F.col(c).cast("string")).join(known, F.col(c) == F.col(f"_level_{at}"), "left")
        lost = F.col(c).isNotNull() & F.col(f"_level_{at}").isNull()
        df = df.withColumn(c, F.when(lost, unseen).otherwise(F.col(c))).drop(f"_level_{at}")
    return df


def level_report(df: DataFrame, levels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What a month does to the dictionary, one row per column.

    rows; missing, known and unseen values; different unseen levels; and levels of the dictionary that no row has.
    """
    seen = count_levels(df, columns)
    known = levels.where(F.col("column").isin(*columns)).select(
        F.col("column").alias("_column"), F.col("level").alias("_level")
    )
    both = seen.join(known, (seen["column"] == known["_column"]) & (seen["level"] == known["_level"]), "full")
    number, is_known, has_level = F.coalesce("rows", F.lit(0)), F.col("_level").isNotNull(), F.col("level").isNotNull()

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, number)), F.lit(0))

    return both.groupBy(F.coalesce("column", "_column").alias("column")).agg(
        F.sum(number).alias("rows"),
        total(~is_known & ~has_level).alias("missing"),
        total(is_known & has_level).alias("known"),
        total(~is_known & has_level).alias("unseen"),
        F.count_if(~is_known & has_level).alias("unseen_levels"),
        F.count_if(is_known & ~has_level).alias("absent_levels"),
    )


def level_indexers(
    levels: DataFrame, columns: Sequence[str], prefix: str = "", out_prefix: str = "index_"
) -> list[StringIndexerModel]:
    """A transformer per column from levels to their positions; values that are missing or not in the dictionary get one position more.

    The levels travel inside the transformers: a column with more than ``MOST_LEVELS`` is refused.
    """
    listed = levels.where(F.col("column").isin(*columns))
    sizes = {r["column"]: r["n"] for r in listed.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    too_many = [c for c, n in sizes.items() if n > MOST_LEVELS]
    absent = [c for c in columns if c not in sizes]
    if too_many or absent:
        raise ValueError(f"columns with too many levels: {too_many}; without a level: {absent}")
    labels: dict[str, list[str]] = {c: [] for c in columns}
    for row in listed.orderBy("column", "position").collect():
        labels[row["column"]].append(row["level"])
    return [
        StringIndexerModel.from_labels(labels[c], inputCol=prefix + c, outputCol=out_prefix + c, handleInvalid="keep")
        for c in columns
    ]
