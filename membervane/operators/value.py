"""From percentiles back to money, and from money to lifetime value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membervane.fixed_values import DRIFT_TOLERANCE
from membervane.functions.numeric import (
    annual_current,
    annual_previous,
    nearest_bucket,
    percent_bucket,
)
from membervane.operators.quantiles import Ranking, rank_lookup


def annualize(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Add ``<measure>_cur`` and ``<measure>_prev``: money of the last and the previous year."""
    changes = {}
    for m in measures:
        changes[f"{m}_cur"] = annual_current(F.col(f"{m}_mva_1to6m"), F.col(f"{m}_mva_7to12m"))
        changes[f"{m}_prev"] = annual_previous(F.col(f"{m}_mva_13to24m"))
    return df.withColumns(changes)


def bucket_drifts(
    df: DataFrame,
    series: Mapping[str, tuple[str, str, str, str]],
    tolerance: int = DRIFT_TOLERANCE,
) -> DataFrame:
    """Mean yearly change of the members around each whole percentile, for several series at once.

    ``{series: (percentile before, percentile now, value before, value now)}`` gives 101 rows
    (series, bucket, delta, members) each. A member counts for every bucket within ``tolerance``
    points of its percentile in both years. A bucket nobody counts for has a delta of zero.
    Changes are summed per pair of percentiles first, a few hundred rows per series, and only
    these sums are spread over the buckets.
    """
    entries = [
        F.struct(
            F.lit(name).alias("series"),
            percent_bucket(F.col(p_prev)).alias("a"),
            percent_bucket(F.col(p_cur)).alias("b"),
            (F.col(v_cur) - F.col(v_prev)).alias("change"),
        )
        for name, (p_prev, p_cur, v_prev, v_cur) in series.items()
    ]
    pairs = (
        df.select(F.inline(F.array(*entries)))
        .filter(F.abs(F.col("a") - F.col("b")) <= 2 * tolerance)
        .groupBy("series", "a", "b")
        .agg(F.sum("change").alias("change"), F.count("change").alias("members"))
    )
    first = F.greatest(F.col("a"), F.col("b")) - tolerance
    last = F.least(F.col("a"), F.col("b")) + tolerance
    reached = F.explode(F.sequence(F.greatest(first, F.lit(0)), F.least(last, F.lit(100))))
    sums = (
        pairs.select("series", reached.alias("bucket"), "change", "members")
        .groupBy("series", "bucket")
        .agg(F.sum("change").alias("change"), F.sum("members").alias("members"))
    )
    buckets = df.sparkSession.range(101).select(
        F.explode(F.array(*[F.lit(name) for name in series])).alias("series"),
        F.col("id").cast("int").alias("bucket"),
    )
    # At most 101 rows per series on either side.
    return buckets.join(F.broadcast(sums), ["series", "bucket"], "left").select(
        "series",
        "bucket",
        F.coalesce(F.try_divide("change", "members"), F.lit(0.0)).alias("delta"),
        F.coalesce("members", F.lit(0)).alias("members"),
    )


def bucket_drift(
    df: DataFrame, p_prev: str, p_cur: str, v_prev: str, v_cur: str, tolerance: int = DRIFT_TOLERANCE
) -> DataFrame:
    """The same for one series: 101 rows (bucket, delta, members)."""
    return bucket_drifts(df, {v_prev: (p_prev, p_cur, v_prev, v_cur)}, tolerance).drop("series")


def percentile_to_value(
    df: DataFrame,
    key: str,
    requests: Mapping[str, tuple[str, str, int]],
    ranking: Ranking,
    drifts: DataFrame,
) -> DataFrame:
    """Money for predicted percentiles: ``{out: (percentile column, series, years ahead)}``.

    The value is the percentile of last year's distribution of the series plus, per year ahead,
    the drift of the nearest bucket. ``drifts`` has 101 rows per series. The member key must be
    unique. Returns the key and one column per request.
    """
    entries = [
        F.struct(
            F.lit(out).alias("out"),
            F.lit(series).alias("series"),
            F.lit(years).alias("years"),
            F.col(p).alias("p"),
        )
        for out, (p, series, years) in requests.items()
    ]
    asked = df.select(key, F.inline(F.array(*entries)))
    placed = rank_lookup(asked, ranking, [key, "out"], out="base")
    drift = drifts.select("series", "bucket", "delta")
    priced = placed.withColumn("bucket", nearest_bucket(F.col("p"))).join(
        F.broadcast(drift), ["series", "bucket"], "left"
    )
    money = F.col("base") + F.col("years") * F.col("delta")
    return (
        priced.select(key, "out", money.alias("money"))
        .groupBy(key)
        .agg(*[F.max(F.when(F.col("out") == out, F.col("money"))).alias(out) for out in requests])
    )
