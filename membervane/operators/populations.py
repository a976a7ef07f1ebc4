"""Two populations compared on many columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from membervane.operators.quantiles import bucket_cuts, count_values, with_buckets
from membervane.session import stage

#: Rows of a comparison: numbers and categories have the same columns.
COLUMNS = ("column", "kind", "missing_a", "missing_b", "distance", "largest_gap", "at")


def _tagged(a: DataFrame, b: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Both populations below each other in one type, with their number in ``in_a``."""
    def part(df: DataFrame, in_a: int) -> DataFrame:
        return df.select(*[F.col(c).cast(kind).alias(c) for c in columns], F.lit(in_a).alias("in_a"))

    return part(a, 1).unionByName(part(b, 0))


def compare_numbers(a: DataFrame, b: DataFrame, columns: Sequence[str], bucket_rows: int | None = None) -> DataFrame:
    """Distance of the distributions of every numeric column, one row each.

    ``distance`` is the area between the two cumulative distributions (Wasserstein), ``largest_gap`` their largest difference
    (Kolmogorov-Smirnov) and ``at`` the smallest value where it is, as text; missing values and NaN are left out and
    counted. A column that one population has no value of has no distance. All columns share one grouping by value and one window inside range buckets,
    so neither a column nor a value is one task's.
    """
    tagged = _tagged(a, b, columns, "double")
    tagged = tagged.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in columns], "in_a")
    sizes = count_values(tagged, columns)
    cuts = bucket_cuts(tagged, columns, sizes, bucket_rows)
    buckets = {c: f"_bucket_{i}" for i, c in enumerate(columns)}
    entries = [F.struct(F.lit(c).alias("column"), F.col(buckets[c]).cast("int").alias("bucket"), F.col(c).alias("value")) for c in columns]
    long = with_buckets(tagged, cuts, buckets).select("in_a", F.inline(F.array(*entries)))
    long = long.withColumn("bucket", F.when(F.col("value").isNotNull(), F.col("bucket")))
    counted = stage(
        long.groupBy("column", "bucket", "value").agg(F.sum("in_a").alias("n_a"), F.sum(1 - F.col("in_a")).alias("n_b")), "populations"
    )
    missing = counted.where("value is null").select("column", F.col("n_a").alias("missing_a"), F.col("n_b").alias("missing_b"))
    present = counted.where("value is not null")
    # One row per bucket of every column: what lies before it, all rows of the column, and the first value after it.
    bounds = present.groupBy("column", "bucket").agg(F.sum("n_a").alias("a"), F.sum("n_b").alias("b"), F.min("value").alias("low"))
    order = Window.partitionBy("column").orderBy("bucket")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bounds = bounds.select(
        "column", "bucket",
        F.coalesce(F.sum("a").over(past), F.lit(0)).alias("before_a"), F.coalesce(F.sum("b").over(past), F.lit(0)).alias("before_b"),
        F.sum("a").over(whole).alias("all_a"), F.sum("b").over(whole).alias("all_b"), F.lead("low").over(order).alias("next_low"),
    )
    inside = Window.partitionBy("column", "bucket").orderBy("value")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    share_a = F.try_divide(F.col("before_a") + F.sum("n_a").over(upto), F.col("all_a"))
    share_b = F.try_divide(F.col("before_b") + F.sum("n_b").over(upto), F.col("all_b"))
    step = F.coalesce(F.lead("value").over(inside), F.col("next_low")) - F.col("value")
    steps = present.join(F.broadcast(bounds), ["column", "bucket"]).select(
        "column", "value", F.abs(share_a - share_b).alias("gap"), step.alias("step")
    )
    found = steps.groupBy("column").agg(
        # The last value has no step, and a gap of zero.
        F.when(F.count("gap") > 0, F.coalesce(F.sum(F.col("gap") * F.col("step")), F.lit(0.0))).alias("distance"),
        F.max("gap").alias("largest_gap"),
        F.max(F.when(F.col("gap").isNotNull(), F.struct(F.round("gap", 12), -F.col("value")))).alias("_at"),
    )
    at = F.when(F.col("largest_gap") > 0, (-F.col("_at.col2")).cast("string"))
    names = a.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    joined = names.join(missing, "column", "left").join(found, "column", "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "column", F.lit("number").alias("kind"), F.coalesce("missing_a", zero).alias("missing_a"), F.coalesce("missing_b", zero).alias("missing_b"),
        "distance", "largest_gap", at.alias("at"),
    )


def compare_categories(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distance of the shares of every categorical column, one row each.

    ``distance`` is half the sum of the differences of shares (total variation), ``largest_gap`` the largest one and ``at`` its level, the first by name of
    several; a missing value is a level of its own, and counted. One grouping serves all columns.
    """
    pairs = _tagged(a, b, columns, "string").unpivot(["in_a"], list(columns), "column", "level")
    counted = pairs.groupBy("column", "level").agg(F.sum("in_a").alias("n_a"), F.sum(1 - F.col("in_a")).alias("n_b"))
    counted = stage(counted, "categories")
    totals = counted.groupBy("column").agg(F.sum("n_a").alias("all_a"), F.sum("n_b").alias("all_b"))
    gap = F.abs(F.try_divide("n_a", "all_a") - F.try_divide("n_b", "all_b"))
    gaps = counted.join(F.broadcast(totals), "column").withColumn("gap", gap)  # one row per column
    found = gaps.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("level").isNull(), F.col("n_a"))), F.lit(0)).alias("missing_a"),
        F.coalesce(F.sum(F.when(F.col("level").isNull(), F.col("n_b"))), F.lit(0)).alias("missing_b"),
        (F.sum("gap") / 2).alias("distance"),
        F.max("gap").alias("largest_gap"),
        F.min(F.when(F.col("gap") > 0, F.struct((-F.round("gap", 12)).alias("less"), F.col("level").alias("level")))).alias("_at"),
    )
    names = a.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    zero = F.lit(0).cast("long")
    return names.join(found, "column", "left").select(
        "column", F.lit("category").alias("kind"), F.coalesce("missing_a", zero).alias("missing_a"), F.coalesce("missing_b", zero).alias("missing_b"),
        "distance", "largest_gap", F.col("_at.level").alias("at"),
    )


def compare_columns(
    a: DataFrame, b: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bucket_rows: int | None = None
) -> DataFrame:
    """All model inputs of two populations, numbers and categories: see ``compare_numbers`` and ``compare_categories``."""
    parts = [compare_numbers(a, b, numeric, bucket_rows)] if numeric else []
    parts += [compare_categories(a, b, categorical)] if categorical else []
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
