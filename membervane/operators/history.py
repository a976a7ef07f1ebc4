"""Member history: features that look back over a member's periods.

A member may own a large share of all rows, so no window runs over rows. Rows are first
reduced to one per member and period, by hash aggregation before the exchange; what is left
of a member is bounded by the number of months in the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from membervane.fixed_values import AVERAGE_SPANS
from membervane.functions.dates import month_number, month_of_number, months_back


def period_max(df: DataFrame, key: str, period: str, columns: Mapping[str, str]) -> DataFrame:
    """Largest value per member and period, zero where there is none: ``{out: source}``."""
    return df.groupBy(key, period).agg(
        *[F.coalesce(F.max(src), F.lit(0)).alias(out) for out, src in columns.items()]
    )


def ever_flags(
    df: DataFrame,
    key: str,
    period: str,
    columns: Mapping[str, str],
    last_periods: int | None = None,
) -> DataFrame:
    """Add running maxima per member up to and including the row's period: ``{out: source}``.

    Rows of the same member and period get the same result. With ``last_periods`` only that
    many of the periods that occur anywhere in the table count back from the row's period.
    """
    monthly = period_max(df, key, period, columns)
    if last_periods is None:
        frame = Window.partitionBy(key).orderBy(period)
        frame = frame.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        # One row per month of the table; whether that is small enough to broadcast is left to Spark.
        months = df.select(period).distinct()
        months = months.withColumn("_month", F.dense_rank().over(Window.orderBy(period)))
        monthly = monthly.join(months, monthly[period].eqNullSafe(months[period])).drop(months[period])
        frame = Window.partitionBy(key).orderBy("_month").rangeBetween(1 - last_periods, 0)
    running = monthly.select(
        F.col(key).alias("_key"),
        F.col(period).alias("_period"),
        *[F.max(out).over(frame).alias(out) for out in columns],
    )
    same = df[key].eqNullSafe(running["_key"]) & df[period].eqNullSafe(running["_period"])
    return df.join(running, same, "left").drop("_key", "_period")


def running_max(df: DataFrame, key: str, period: str, columns: Mapping[str, str]) -> DataFrame:
    """Like ``ever_flags``, for rows that are one per member and period already: a single window, no join back.

    On stored buckets of the key (``joins.co_located``) it needs no exchange either.
    """
    frame = Window.partitionBy(key).orderBy(period).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({out: F.max(F.coalesce(F.col(src), F.lit(0))).over(frame) for out, src in columns.items()})


def rolling_max(
    df: DataFrame,
    key: str,
    period: str,
    columns: Mapping[str, str],
    shift: int = 0,
    window: int = 6,
    min_periods: int = 3,
) -> DataFrame:
    """Largest value over the member's last periods, per member and period: ``{out: source}``.

    Values are first moved ``shift`` of the member's periods forward. The result is NULL where
    fewer than ``min_periods`` values are present. Several rows of one period count as one.
    """
    monthly = df.groupBy(key, period).agg(
        *[F.max(src).alias(out) for out, src in columns.items()]
    )
    by_period = Window.partitionBy(key).orderBy(period)
    shifted = monthly.withColumns({out: F.lag(out, shift).over(by_period) for out in columns})
    frame = by_period.rowsBetween(1 - window, 0)
    return shifted.withColumns(
        {
            out: F.when(F.count(out).over(frame) >= min_periods, F.max(out).over(frame))
            for out in columns
        }
    )


def _is_date(df: DataFrame, period: str) -> bool:
    return dict(df.dtypes)[period] == "date"


def rolling_max_months(
    df: DataFrame,
    key: str,
    period: str,
    columns: Mapping[str, str],
    shift: int = 0,
    window: int = 6,
    min_periods: int = 3,
) -> DataFrame:
    """Like ``rolling_max``, but over calendar months: the ``window`` months that end ``shift`` months before the row's.

    ``period`` is a date or a ``YYYYMM`` int. Months without a row hold no value; they neither stretch the window nor count for ``min_periods``.
    """
    monthly = df.groupBy(key, period).agg(*[F.max(src).alias(out) for out, src in columns.items()])
    number = month_number(F.col(period), _is_date(df, period))
    frame = Window.partitionBy(key).orderBy("_number").rangeBetween(1 - window - shift, -shift)
    placed = monthly.withColumn("_number", number)
    found = {out: F.when(F.count(out).over(frame) >= min_periods, F.max(out).over(frame)) for out in columns}
    return placed.select(key, period, *[c.alias(out) for out, c in found.items()])


def dense_months(
    df: DataFrame, key: str, period: str, columns: Mapping[str, str], fill: float = 0, last: int | str | None = None
) -> DataFrame:
    """One row per member and calendar month from its first to the last of the table, the largest value or ``fill`` in it.

    ``last`` names another last month (of the type of ``period``: a date or a ``YYYYMM`` int). Members have as many rows
    as months, made by a sequence per member, so that windows over rows are windows over months. Rows without a month take no part.
    """
    dated = _is_date(df, period)
    monthly = df.where(F.col(period).isNotNull()).groupBy(key, F.col(period).alias(period)).agg(*[F.max(src).alias(out) for out, src in columns.items()])
    monthly = monthly.withColumn("_number", month_number(F.col(period), dated)).drop(period)
    if last is None:
        last = df.agg(F.max(period)).first()[0]
    end = month_number(F.lit(last).cast("date" if dated else "int"), dated)
    begun = monthly.groupBy(F.col(key).alias("_member")).agg(F.min("_number").alias("_first")).where(F.col("_first") <= end)
    every = begun.select("_member", F.explode(F.sequence(F.col("_first"), end)).alias("_month"))
    same = F.col("_member").eqNullSafe(F.col(key)) & (F.col("_month") == F.col("_number"))
    joined = every.join(monthly, same, "left")
    filled = [F.coalesce(out, F.lit(fill)).alias(out) for out in columns]
    return joined.select(F.col("_member").alias(key), month_of_number(F.col("_month"), dated).alias(period), *filled)


def window_averages(
    panel: DataFrame,
    key: str,
    period_date: str,
    as_of: Column,
    columns: Sequence[str],
    spans: Mapping[str, tuple[int, int]] = AVERAGE_SPANS,
) -> DataFrame:
    """Monthly averages per member over spans of months before ``as_of``, missing months as zero.

    Gives ``<column>_mva_<span>`` for members with at least one row in the months looked at.
    """
    back = months_back(F.col(period_date), as_of)
    first = min(lo for lo, _ in spans.values())
    last = max(hi for _, hi in spans.values())
    # Bounds on the plain column, so that they prune partitions and reach the scan.
    recent = panel.filter(
        F.col(period_date).between(
            F.trunc(F.add_months(as_of, -last), "MM"), F.last_day(F.add_months(as_of, -first))
        )
    ).withColumn("_back", back)
    averages = []
    for column in columns:
        for name, (lo, hi) in spans.items():
            inside = F.when(F.col("_back").between(lo, hi), F.col(column)).otherwise(F.lit(0))
            mean = F.sum(inside).cast("double") / (hi - lo + 1)
            averages.append(mean.alias(f"{column}_mva_{name}"))
    return recent.groupBy(key).agg(*averages)
