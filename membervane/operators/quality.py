"""Profiles, checks and comparisons of whole tables."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from membervane.operators.quantiles import (
    bucket_cuts,
    count_values,
    exact_quantiles,
    with_buckets,
)
from membervane.session import stage


def distinct_members(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    """Number of different members."""
    count = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    return df.agg(count.alias("members"))


#: Logarithm of a sketch's registers.
SKETCH_LOG = 12


def member_sketches(df: DataFrame, key: str, groups: Sequence[str]) -> DataFrame:
    """A sketch of the different members of every group (such as a month), to be kept and merged: groups and ``sketch``.

    Some 2 KB a group, whatever its members; equal members of a task are combined before the exchange.
    """
    return df.groupBy(*groups).agg(F.hll_sketch_agg(F.col(key), F.lit(SKETCH_LOG)).alias("sketch"))


def merged_members(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Different members of larger groups (such as years) from kept sketches: ``estimate`` and the ``stated_error``.

    A member of several months counts once. The stated error is three standard errors, 3 * 1.04 / sqrt(registers): 4.9 % of the exact number.
    """
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate")
    return sketches.groupBy(*groups).agg(union).withColumn("stated_error", F.lit(3 * 1.04 / math.sqrt(2**SKETCH_LOG)))


def uniqueness_check(df: DataFrame, key: str) -> DataFrame:
    """Rows, different members, and whether these are equal."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("members"))
    return counts.withColumn("is_unique", F.col("rows") == F.col("members"))


def score_stats(df: DataFrame, col: str) -> DataFrame:
    """Mean, smallest, largest and sample deviation of a score."""
    return df.agg(
        F.avg(col).alias("mean"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        F.stddev_samp(col).alias("std"),
    )


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles, one row per numeric column.

    One pass gives the moments and the numbers of values that the quartiles are looked up by.
    """
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    moments = df.agg(
        *[f(c).cast("bigint" if m == "count" else "double").alias(f"{m}_{i}") for i, c in enumerate(columns) for m, f in measures.items()],
        *[F.count_if(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))).alias(f"values_{i}") for i, c in enumerate(columns)],
    ).first()
    sizes = {c: moments[f"values_{i}"] for i, c in enumerate(columns)}
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], sizes=sizes)
    rows = [
        (c, *[moments[f"{m}_{i}"] for m in ("count", "mean", "std", "min")], *quartiles[c], moments[f"max_{i}"])
        for i, c in enumerate(columns)
    ]
    kinds = "column string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    return df.sparkSession.createDataFrame(rows, kinds)


def null_report(df: DataFrame) -> DataFrame:
    """Columns with missing values and how many there are."""
    counts = df.agg(
        *[
            F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls")).alias(f"_{i}")
            for i, c in enumerate(df.columns)
        ]
    )
    rows = counts.select(F.inline(F.array(*[f"_{i}" for i in range(len(df.columns))])))
    return rows.filter(F.col("nulls") > 0)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Different values of a column."""
    return df.select(col).distinct()


def category_counts(df: DataFrame, before: str, after: str) -> DataFrame:
    """Number of different values before and after a simplification."""
    return df.agg(
        F.count_distinct(before).alias("before"), F.count_distinct(after).alias("after")
    )


def flag_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Number of rows, number of columns, and rows where each flag holds."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        *[F.count_if(F.col(f).cast("boolean")).alias(f) for f in flags],
    )


def shape(df: DataFrame) -> tuple[int, int]:
    """Number of rows and columns."""
    return df.count(), len(df.columns)


def _offends(kind: str, column: str, rule: Mapping[str, object]) -> Column:
    """Whether a row breaks a rule on single values; NULL where its value is missing."""
    col = F.col(column)
    if kind == "not_null":
        return col.isNull()
    if kind == "range":
        outside = F.lit(False)
        if rule.get("min") is not None:
            low = F.lit(rule["min"])
            outside = outside | (col <= low if rule.get("strict_min") else col < low)
        if rule.get("max") is not None:
            high = F.lit(rule["max"])
            outside = outside | (col >= high if rule.get("strict_max") else col > high)
        return outside
    if kind == "in_set":
        return ~col.isin(*rule["values"])
    raise ValueError(f"unknown expectation {kind!r}")


def _violation(kind: str, column: str, rule: Mapping[str, object], types: Mapping[str, str]) -> Column:
    if kind == "type":
        return F.lit(0 if types[column] == rule["type"] else 1).cast("bigint")
    return F.count_if(_offends(kind, column, rule))


# Check names of the common JSON suite format, and what they are here.
_SUITE_CHECKS = {
    "expect_column_values_to_not_be_null": ("not_null", {}),
    "expect_column_values_to_be_between": (
        "range",
        {"min_value": "min", "max_value": "max", "strict_min": "strict_min", "strict_max": "strict_max"},
    ),
    "expect_column_values_to_be_in_set": ("in_set", {"value_set": "values"}),
    "expect_column_values_to_be_unique": ("unique", {}),
    "expect_column_values_to_be_of_type": ("type", {"type_": "type"}),
}
# Arguments of a suite that change no result.
_SUITE_SILENT = {"column", "result_format", "include_config", "catch_exceptions", "meta"}


def expectations_of(suite: Mapping[str, object]) -> list[dict[str, object]]:
    """Expectations of a loaded JSON suite: ``{"expectations": [{"expectation_type", "kwargs"}]}``."""
    out = []
    for entry in suite["expectations"]:
        if entry["expectation_type"] not in _SUITE_CHECKS:
            raise ValueError(f"no check for {entry['expectation_type']}")
        kind, options = _SUITE_CHECKS[entry["expectation_type"]]
        kwargs = entry["kwargs"]
        options = {**options, "mostly": "mostly"}
        unknown = kwargs.keys() - options.keys() - _SUITE_SILENT
        if unknown:
            raise ValueError(f"{entry['expectation_type']} has options without a meaning here: {sorted(unknown)}")
        found = {ours: kwargs[theirs] for theirs, ours in options.items() if theirs in kwargs}
        out.append({"expect": kind, "column": kwargs["column"], **found})
    return out


def validate(
    df: DataFrame, expectations: Sequence[Mapping[str, object]], failures_only: bool = False
) -> DataFrame:
    """Check expectations; rows (expectation, column, violations, success).

    An expectation is a mapping with ``expect`` and ``column``: ``not_null``; ``range`` with
    ``min`` and/or ``max`` (``strict_min``, ``strict_max``: bounds excluded); ``in_set`` with ``values``; ``type`` with ``type``; ``unique``. Missing
    values only violate ``not_null``. ``unique`` counts the surplus rows. With ``mostly`` that share of the values
    (of the rows, for ``not_null``) has to be right. An absent column fails its check with NULL violations; no
    expectations give an empty report. One pass over the data
    serves all expectations but ``unique``, which needs one grouping per column.
    """
    types = dict(df.dtypes)
    report_type = "expectation string, column string, violations bigint, success boolean"

    def result(e: Mapping[str, object], violations: Column, values: Column) -> Column:
        right = violations == 0
        if e.get("mostly") is not None:
            right = (violations == 0) | (violations <= (1 - F.lit(float(e["mostly"]))) * values + F.lit(1e-9))
        return F.struct(
            F.lit(e["expect"]).alias("expectation"),
            F.lit(e["column"]).alias("column"),
            violations.cast("bigint").alias("violations"),
            right.alias("success"),
        )

    known = [e for e in expectations if e["column"] in types]
    absent = [(e["expect"], e["column"], None, False) for e in expectations if e["column"] not in types]
    plain = [e for e in known if e["expect"] != "unique"]
    parts = [df.sparkSession.createDataFrame(absent, report_type)] if absent else []
    if plain:
        counts = df.agg(
            *[
                result(
                    e,
                    _violation(e["expect"], e["column"], e, types),
                    F.count(F.lit(1)) if e["expect"] == "not_null" else F.count(e["column"]),
                ).alias(f"_{i}")
                for i, e in enumerate(plain)
            ]
        )
        parts.append(counts.select(F.inline(F.array(*[f"_{i}" for i in range(len(plain))]))))
    for e in known:
        if e["expect"] == "unique":
            c = e["column"]
            copies = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_held"))
            surplus = copies.agg(
                F.coalesce(F.sum(F.col("_held") - 1), F.lit(0)).alias("_surplus"),
                F.coalesce(F.sum("_held"), F.lit(0)).alias("_values"),
            )
            parts.append(surplus.select(F.inline(F.array(result(e, F.col("_surplus"), F.col("_values"))))))
    if not parts:
        return df.sparkSession.createDataFrame([], report_type)
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.filter(~F.col("success")) if failures_only else report


BASIC_RESULT = (
    "expectation string, column string, element_count bigint, missing_count bigint, missing_percent double, "
    "unexpected_count bigint, unexpected_percent double, unexpected_percent_nonmissing double, "
    "partial_unexpected_list array<string>, success boolean"
)


def validate_basic(df: DataFrame, expectations: Sequence[Mapping[str, object]], examples: int = 20) -> DataFrame:
    """Check expectations (see ``validate``) and tell how far they fail: counts, shares in percent, and the first offending values.

    Values of a list are the ``examples`` smallest, with repeats, as text. ``unique`` counts all rows whose value another row has. A check of a type or of an absent column has
    no counts. Two passes serve all checks: one counts; the other keeps offending values only, of which each task sends on no more than ``examples`` a check.
    ``unique`` needs one grouping per column.
    """
    types = dict(df.dtypes)
    spark = df.sparkSession
    rows = [(i, e["expect"], e["column"], float(e["mostly"]) if e.get("mostly") is not None else 1.0) for i, e in enumerate(expectations)]
    if not rows:
        return spark.createDataFrame([], BASIC_RESULT)
    rules = spark.createDataFrame(rows, "rule int, expectation string, column string, mostly double")
    single = [(i, e) for i, e in enumerate(expectations) if e["column"] in types and e["expect"] not in ("unique", "type")]
    whole = [(i, e) for i, e in enumerate(expectations) if e["column"] in types and e["expect"] == "type"]
    unique = [(i, e) for i, e in enumerate(expectations) if e["column"] in types and e["expect"] == "unique"]

    def counted(rule: int, elements: Column, missing: Column, unexpected: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"), elements.cast("bigint").alias("element_count"), missing.cast("bigint").alias("missing_count"),
            unexpected.cast("bigint").alias("unexpected_count"),
        )

    def example(rule: int, column: str) -> Column:
        """Numbers and dates in their own order, all else as text."""
        col = F.col(column)
        number = F.unix_date(col) if types[column] == "date" else col.try_cast("double")
        own = number.cast("double") if types[column] == "date" or re.match("(tinyint|smallint|int|bigint|float|double|decimal)", types[column]) else F.lit(None).cast("double")
        return F.struct(F.lit(rule).alias("rule"), own.alias("number"), col.cast("string").alias("text"))

    counts, samples = [], []
    if single:
        # A missing value is what not_null looks for, and no element of the other checks.
        every = [
            counted(
                i, F.count(F.lit(1)), F.count_if(F.lit(False) if e["expect"] == "not_null" else F.col(e["column"]).isNull()),
                F.count_if(_offends(e["expect"], e["column"], e)),
            ).alias(f"_{i}")
            for i, e in single
        ]
        counts.append(df.agg(*every).select(F.inline(F.array(*[f"_{i}" for i, _ in single]))))
        shown = [F.when(_offends(e["expect"], e["column"], e), example(i, e["column"])) for i, e in single if e["expect"] != "not_null"]
        if shown:
            samples.append(df.select(F.inline(F.array_compact(F.array(*shown)))))
    for i, e in unique:
        held = df.groupBy(e["column"]).agg(F.count(F.lit(1)).alias("_held"))
        value, missing = F.col(e["column"]).isNotNull(), F.sum(F.when(F.col(e["column"]).isNull(), F.col("_held")))
        copies = F.sum(F.when(value & (F.col("_held") > 1), F.col("_held")))
        zero = F.lit(0)
        counts.append(held.agg(counted(i, F.coalesce(F.sum("_held"), zero), F.coalesce(missing, zero), F.coalesce(copies, zero)).alias("_c")).select("_c.*"))
        several = held.where(value & (F.col("_held") > 1))
        copied = F.explode(F.array_repeat(example(i, e["column"]), F.least("_held", F.lit(examples)).cast("int"))).alias("_s")
        samples.append(several.select(copied).select("_s.*"))
    found = reduce(DataFrame.unionByName, counts) if counts else spark.createDataFrame([], "rule int, element_count bigint, missing_count bigint, unexpected_count bigint")
    joined = rules.join(F.broadcast(found), "rule", "left")  # both have a row per check
    if samples:
        # The rank filter is applied in each task before the exchange.
        order = Window.partitionBy("rule").orderBy(F.col("number").asc_nulls_last(), "text")
        first = reduce(DataFrame.unionByName, samples).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= examples)
        listed = first.groupBy("rule").agg(F.array_sort(F.collect_list(F.struct("_rank", "text"))).alias("_first"))
        joined = joined.join(F.broadcast(listed.select("rule", F.col("_first.text").alias("_listed"))), "rule", "left")
    else:
        joined = joined.withColumn("_listed", F.lit(None).cast("array<string>"))
    right = {i: types[e["column"]] == e["type"] for i, e in whole}
    by_type = F.lit(False)
    for i, fine in right.items():
        by_type = F.when(F.col("rule") == i, F.lit(fine)).otherwise(by_type)
    present = F.col("element_count") - F.col("missing_count")
    allowed = (1 - F.col("mostly")) * present + F.lit(1e-9)
    return joined.orderBy("rule").select(
        "expectation", "column", "element_count", "missing_count",
        (100 * F.try_divide("missing_count", "element_count")).alias("missing_percent"),
        "unexpected_count",
        (100 * F.try_divide("unexpected_count", "element_count")).alias("unexpected_percent"),
        (100 * F.try_divide("unexpected_count", present)).alias("unexpected_percent_nonmissing"),
        F.when(F.col("element_count").isNotNull(), F.coalesce("_listed", F.array().cast("array<string>"))).alias("partial_unexpected_list"),
        F.when(F.col("element_count").isNotNull(), F.col("unexpected_count") <= allowed).otherwise(by_type).alias("success"),
    )


def wasserstein(
    a: DataFrame, b: DataFrame, col_a: str, col_b: str, bucket_rows: int | None = None
) -> DataFrame:
    """First Wasserstein distance of two populations of one number: a single row ``distance``.

    The area between the two cumulative distributions, summed over the steps between
    neighbouring values. Values are counted first, then accumulated inside range buckets.
    """
    tagged = a.select(F.col(col_a).cast("double").alias("value"), F.lit(1).alias("in_a")).unionByName(
        b.select(F.col(col_b).cast("double").alias("value"), F.lit(0).alias("in_a"))
    )
    tagged = tagged.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    total = count_values(tagged, ["value"])["value"]
    cuts = bucket_cuts(tagged, ["value"], {"value": total}, bucket_rows)["value"]
    counted = (
        with_buckets(tagged, {"value": cuts}, {"value": "bucket"})
        .groupBy("bucket", "value")
        .agg(F.sum("in_a").alias("n_a"), F.sum(1 - F.col("in_a")).alias("n_b"))
    )
    inside = Window.partitionBy("bucket").orderBy("value")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    if cuts:
        counted = stage(counted, "distribution")
        counted = counted.join(F.broadcast(_bucket_bounds(counted)), "bucket")
    else:
        whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        counted = counted.withColumns(
            {
                "before_a": F.lit(0),
                "before_b": F.lit(0),
                "all_a": F.sum("n_a").over(whole),
                "all_b": F.sum("n_b").over(whole),
                "next_low": F.lit(None).cast("double"),
            }
        )
    steps = counted.select(
        ((F.col("before_a") + F.sum("n_a").over(upto)) / F.col("all_a")).alias("share_a"),
        ((F.col("before_b") + F.sum("n_b").over(upto)) / F.col("all_b")).alias("share_b"),
        (F.coalesce(F.lead("value").over(inside), F.col("next_low")) - F.col("value")).alias("step"),
    )
    area = F.abs(F.col("share_a") - F.col("share_b")) * F.col("step")
    return steps.agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("distance"))


def _bucket_bounds(counted: DataFrame) -> DataFrame:
    """Rows before each bucket, rows in all, and the first value after it: one row per bucket."""
    buckets = counted.groupBy("bucket").agg(
        F.sum("n_a").alias("bucket_a"), F.sum("n_b").alias("bucket_b"), F.min("value").alias("low")
    )
    order = Window.orderBy("bucket")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return buckets.select(
        "bucket",
        F.coalesce(F.sum("bucket_a").over(past), F.lit(0)).alias("before_a"),
        F.coalesce(F.sum("bucket_b").over(past), F.lit(0)).alias("before_b"),
        F.sum("bucket_a").over(everything).alias("all_a"),
        F.sum("bucket_b").over(everything).alias("all_b"),
        F.lead("low").over(order).alias("next_low"),
    )


def compare_categorical(a: DataFrame, b: DataFrame, col_a: str, col_b: str) -> DataFrame:
    """Share of each category in two populations and the difference."""

    def shares(df: DataFrame, col: str, name: str) -> DataFrame:
        counts = df.groupBy(F.col(col).alias("category")).agg(F.count(F.lit(1)).alias("n"))
        total = df.agg(F.count(F.lit(1))).scalar()
        return counts.select("category", (F.col("n") / total).alias(name))

    left, right = shares(a, col_a, "share_a"), shares(b, col_b, "share_b")
    joined = left.join(
        right, left["category"].eqNullSafe(right["category"]), "full"
    ).select(
        F.coalesce(left["category"], right["category"]).alias("category"),
        F.coalesce("share_a", F.lit(0.0)).alias("share_a"),
        F.coalesce("share_b", F.lit(0.0)).alias("share_b"),
    )
    return joined.withColumn("difference", F.col("share_a") - F.col("share_b"))


def compare_numeric(
    a: DataFrame,
    b: DataFrame,
    col_a: str,
    col_b: str,
    fractions: Sequence[float] = tuple(i / 10 for i in range(11)),
) -> DataFrame:
    """Exact quantiles of two populations side by side: rows (fraction, value_a, value_b). Both are found in one run."""
    left = a.select(F.col(col_a).cast("double").alias("value_a"), F.lit(None).cast("double").alias("value_b"))
    right = b.select(F.lit(None).cast("double").alias("value_a"), F.col(col_b).cast("double").alias("value_b"))
    found = exact_quantiles(left.unionByName(right), ["value_a", "value_b"], fractions)
    rows = [(float(q), x, y) for q, x, y in zip(fractions, found["value_a"], found["value_b"], strict=True)]
    return a.sparkSession.createDataFrame(rows, "fraction double, value_a double, value_b double")
