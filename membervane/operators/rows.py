"""Row filters, deduplication, previews, unions and the row index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from membervane.operators.quantiles import exact_quantiles
from membervane.session import stage


def drop_unparsed(df: DataFrame, col: str) -> DataFrame:
    """Keep rows where the column has a value, then drop the column."""
    return df.filter(F.col(col).isNotNull()).drop(col)


def nonnegative(df: DataFrame, col: str) -> DataFrame:
    """Keep rows with a value of zero or more."""
    return df.filter(F.col(col) >= 0)


def in_list(col: Column, values: Sequence[object]) -> Column:
    """Membership in a short list."""
    return col.isin(*values)


def top_quantile(df: DataFrame, col: str, q: float = 0.8) -> DataFrame:
    """Rows at or above an exact quantile of the column."""
    (threshold,) = exact_quantiles(df, [col], [q])[col]
    return df.filter(F.col(col) >= F.lit(threshold).cast("double"))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in the given order.

    The rank filter lets Spark cut every key to one row per task before the exchange, so a
    key with very many rows costs its final task only as many rows as there were tasks.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in the given order."""
    return dedup_first(df, keys, [F.col(c).desc() for c in order])


def latest_row(df: DataFrame, key: str, period: str, value: int, order: Sequence[str]) -> DataFrame:
    """Rows of one period, the last one per member in the given order."""
    return dedup_last(df.filter(F.col(period) == value), [key], order)


def order_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sort by keys."""
    return df.orderBy(*keys)


def preview(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*keys).limit(n)


def append_history(history: DataFrame, current: DataFrame) -> DataFrame:
    """Stack the current month on the history by column name; absent columns become NULL."""
    return history.unionByName(current, allowMissingColumns=True)


def with_index(
    df: DataFrame, order: Sequence[str] = (), out: str = "index", unique_order: bool = False
) -> DataFrame:
    """Zero-based row number as the first column: arrival order, or the order of given keys.

    The rows are sorted by range and written once. Each row then carries its partition and
    its place in it, and the numbers of rows before each partition (one row per partition)
    are broadcast. Rows with equal keys keep their arrival order, which also lets the range
    split cut through a key shared by very many rows; ``unique_order`` says that no two rows
    share a key and saves a pass.
    """
    arrival, place = "_arrival", "_place"
    if order and not unique_order:
        df = stage(df.withColumn(arrival, F.monotonically_increasing_id()), "arrival")
        df = df.orderBy(*order, arrival).drop(arrival)
    elif order:
        df = df.orderBy(*order)
    placed = stage(df.withColumn(place, F.monotonically_increasing_id()), "placed")
    # Spark numbers rows as partition * 2^33 + position in the partition.
    part = F.shiftrightunsigned(place, 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    position = F.col(place).bitwiseAND((1 << 33) - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_offset") + position).alias(out), *[c for c in df.columns])
    )
