"""One query per operator, over the whole sample tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from membervane.catalog import standins as st
from membervane.fixed_values import CHURN_FRACTIONS, NO_END_PERIOD, SEGMENT_LABELS, VALUE_FRACTIONS
from membervane.functions import dates, flags, numeric, text
from membervane.functions.text import label
from membervane.operators import carried, ensembles, history, joins, levels, populations, quality, quantiles, rows, schema, scoring, segments, value
from membervane.plans import campaign as campaign_plan
from membervane.plans import lifetime, preparation
from membervane.session import scratch_path, stage, tune
from membervane.sources import delimited, sinks, tables, versions

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}

NAMES = campaign_plan.CampaignNames(
    member="member_id", age="age", complex_6m="complex_6m", claims_2m="claims_2m", churn="churn"
)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(tune(spark), sf)

    run.__doc__ = fn.__doc__
    _registry[fn.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating columns rounded, so that the last bits do not decide a comparison."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.round(c, digits) for c in floats})


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ``YYYY-MM-DD``, which every client shows alike."""
    return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"})


# Sources and sinks


@query
def scan_table(spark, sf):
    return tables.read_table(spark, f"{sf}/customer.parquet")


@query
def scan_period(spark, sf):
    orders = st.order_month(spark, sf).withColumnRenamed("period", "PERIODO")
    return tables.scan_period(orders, 199803).select("order_id", "member_id", "periodo", "status")


@query
def scan_period_range(spark, sf):
    orders = st.order_month(spark, sf)
    span = tables.scan_period(orders, 199803, 199805, column="PERIOD")
    return span.groupBy("period").agg(F.count(F.lit(1)).alias("n"))


@query
def csv_roundtrip(spark, sf):
    customer = st.table(spark, sf, "customer")
    path = scratch_path(spark, "csv")
    sinks.export_csv(customer, path, compression="gzip")
    return tables.read_csv(spark, path, customer.schema)


def _inferred(spark, sf):
    """Orders as a file of unknown types, with three rows that are bad in three ways."""
    orders = st.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")
    path = scratch_path(spark, "unknown")
    sinks.export_csv(orders, path, compression="gzip")
    lines = [",".join(orders.columns), "-1,x12,O,1.5,1998-01-01,5-LOW", "-2,7,O", "-3,7,F,2.5,1998-01-01,5-LOW,more"]
    spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.mode("append").text(path)
    return delimited.read_inferred(spark, path)


@query
def csv_inferred(spark, sf):
    """Types, values and bad rows of every column of a file read without a schema."""
    return _inferred(spark, sf).report()


@query
def csv_inferred_rows(spark, sf):
    return dates_as_text(_inferred(spark, sf).rows)


@query
def csv_bad_rows(spark, sf):
    bad = _inferred(spark, sf).bad
    return bad.select("o_orderkey", "o_custkey", F.col("_reason").alias("reason"))


@query
def table_roundtrip(spark, sf):
    """Replace a table, replace the rows of one of its periods, read it back."""
    months = st.order_month(spark, sf).select("order_id", "member_id", "status", "period")
    path = scratch_path(spark, "table")
    sinks.truncate_append(months, path, "period")
    changed = months.filter(F.col("period") == 199803).withColumn("status", F.lower("status"))
    sinks.truncate_append(changed, path, "period")
    return tables.read_table(spark, path).select("order_id", "member_id", "status", F.col("period").cast("int"))


@query
def publish_tables(spark, sf):
    """Three tables under one period and the manifest written last."""
    parts = {
        "members": st.member(spark, sf),
        "orders": st.order_month(spark, sf),
        "categories": st.category(spark, sf),
    }
    listing = sinks.publish(parts, scratch_path(spark, "published"), st.AS_OF_PERIOD)
    return listing.select("table_name", "period", "row_count")


@query
def republish_empty(spark, sf):
    """Two months published, one of them again without a row: what readers of the manifest find."""
    folder = scratch_path(spark, "published")
    months = st.order_month(spark, sf).select("order_id", "member_id", "status", "period")
    for period in (199803, 199804):
        sinks.publish({"orders": months.filter(F.col("period") == period).drop("period")}, folder, period)
    sinks.publish({"orders": months.filter("false").drop("period")}, folder, 199804)
    found = [
        sinks.read_published(spark, folder, "orders", period).withColumn("period", F.lit(period))
        for period in (199803, 199804)
    ]
    return found[0].unionByName(found[1])


@query
def publish_race(spark, sf):
    """Two publishers of one month start from the same version: one wins, and nothing of the other is left."""
    months = st.order_month(spark, sf).select("order_id", "member_id", "status", "period")
    month = months.where(F.col("period") == 199803)
    folder = scratch_path(spark, "race")
    versions.commit(folder, {"orders": months.where(F.col("period") == 199802)}, 199802)
    base = versions.version_of(spark, folder).number
    versions.commit(folder, {"orders": month, "members": month.select("member_id").distinct()}, 199803, base)
    lost = 0
    try:
        versions.commit(folder, {"orders": month.withColumn("status", F.lower("status")), "members": month.select("member_id")}, 199803, base)
    except versions.LostRace:
        lost = 1
    files = tables.list_files(spark, f"{folder}/data").select(F.regexp_extract("path", "/data/([^/]+/[^/]+)/", 1).alias("path")).distinct()
    orders = versions.read_version(spark, folder, "orders", 199803)
    members = versions.read_version(spark, folder, "members").withColumn("is_listed", F.lit(True))
    return orders.join(members, "member_id", "left").withColumns({"lost": F.lit(lost), "n_tables": F.lit(files.count())})


@query
def snapshot_roundtrip(spark, sf):
    """Snapshots of two months in several parts each: the newest of a month is found by its name and read whole."""
    folder = scratch_path(spark, "snapshots")
    months = st.order_month(spark, sf).select("order_id", "member_id", "status", "period")
    for period in (199803, 199804):
        rows = months.filter(F.col("period") == period)
        sinks.export_csv(rows.repartition(3, "order_id"), f"{folder}/{dates.snapshot_name('ready', period)}", compression="gzip")
    first = months.filter(F.col("period") == 199803).filter(F.col("status") == "F")
    sinks.export_csv(first, f"{folder}/{dates.snapshot_name('ready_score', 199803)}.csv", single_file=True)
    return tables.read_snapshot(spark, folder, "mar98", "ready", months.schema, exclude="score")


@query
def replace_table_roundtrip(spark, sf):
    """A catalog table written twice, the second time with other columns and upper-case names."""
    orders = st.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path, name = scratch_path(spark, "replaced"), f"replaced_{uuid.uuid4().hex}"
    sinks.replace_table(orders, name, path)
    sinks.replace_table(orders.select("o_orderkey", F.lower("o_orderstatus").alias("status")), name, path, upper=True)
    return tables.read_table(spark, name)


@query
def validate_result(spark, sf):
    """A check report written as JSON and read back."""
    path = scratch_path(spark, "report")
    rules = [
        {"expect": "range", "column": "o_totalprice", "min": 1000.0, "max": 400000.0},
        {"expect": "unique", "column": "o_custkey"},
        {"expect": "not_null", "column": "o_custkey"},
    ]
    report = quality.validate(st.table(spark, sf, "orders"), rules)
    sinks.write_result(report, path)
    return spark.read.schema(report.schema).json(path)


@query
def validate_suite(spark, sf):
    """A loaded JSON suite with strict bounds, shares of values, and a column that isn't there."""
    suite = json.loads(
        """{"expectations": [
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "c_nationkey", "min_value": 0, "max_value": 24, "strict_min": true, "strict_max": true}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "c_acctbal", "min_value": 0, "mostly": 0.5}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "c_acctbal", "min_value": 5000, "mostly": 0.9}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "c_custkey", "mostly": 1.0}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "c_phone"}}]}"""
    )
    return quality.validate(st.table(spark, sf, "customer"), quality.expectations_of(suite))


@query
def validate_basic(spark, sf):
    """Counts, shares and first offending values of a suite's checks."""
    orders = st.table(spark, sf, "orders").withColumns({"note": F.nullif("o_orderstatus", F.lit("P")), "day": F.col("o_orderdate").cast("date")})
    report = quality.validate_basic(
        orders,
        [
            {"expect": "range", "column": "o_custkey", "min": 10, "mostly": 0.5},
            {"expect": "range", "column": "day", "max": "2001-07-01"},
            {"expect": "in_set", "column": "note", "values": ["F"], "mostly": 0.3},
            {"expect": "not_null", "column": "note"},
            {"expect": "unique", "column": "o_custkey"},
            {"expect": "unique", "column": "o_orderkey"},
            {"expect": "type", "column": "o_custkey", "type": "bigint"},
            {"expect": "range", "column": "absent", "min": 0},
        ],
    )
    return rounded(report.withColumn("partial_unexpected_list", F.array_join("partial_unexpected_list", "|")))


@query
def latest_snapshot(spark, sf):
    found = tables.latest_snapshot(st.listing(spark, sf), "mar24", "ltv", exclude="score")
    return found.select("event_id", "name", "in_period")


@query
def latest_snapshot_fallback(spark, sf):
    """No file of the period: the newest one with the token."""
    found = tables.latest_snapshot(st.listing(spark, sf), "mar99", "ready")
    return found.select("event_id", "name", "in_period")


@query
def used_columns(spark, sf):
    return schema.used_columns(
        [
            st.table(spark, sf, "events").select("event_type"),
            st.table(spark, sf, "customer").select("c_mktsegment"),
            st.table(spark, sf, "part").select("p_type"),
        ]
    )


# Columns


@query
def upper_lower_columns(spark, sf):
    return schema.lower_columns(schema.upper_columns(st.table(spark, sf, "customer")))


@query
def rename_map(spark, sf):
    renamed = schema.rename_map(
        st.table(spark, sf, "customer"), {"c_custkey": "member_id", "c_name": "full_name", "absent": "x"}
    )
    return schema.rename_if(schema.rename_if(renamed, "c_acctbal", "balance"), "absent", "y")


@query
def schema_shape(spark, sf):
    wide = st.averages(spark, sf)
    kept = schema.keep_like(wide, ["member_", "income", "cost", "recency"])
    return rounded(schema.drop_existing(schema.drop_like(kept, ["7to12m", "13to24m"]), ["cost_mva_1to6m", "absent"]))


@query
def presence_report(spark, sf):
    months = st.order_month(spark, sf).withColumn("leaver", F.when(F.col("status") == "F", F.lit(1)))
    return schema.presence_report(months, ["member_id", "period", "leaver", "status", "absent"])


@query
def try_cast_columns(spark, sf):
    typed = schema.try_cast_columns(
        st.side(spark, sf), {"member_id": "bigint", "period": "int", "claims": "double", "order_id": "int"}
    )
    return typed.select("order_id", "member_id", "period", "claims")


@query
def decimals_to_double(spark, sf):
    return rounded(schema.decimals_to_double(st.panel(spark, sf)).select("member_id", "period", "income", "cost", "margin"))


@query
def coerce_inputs(spark, sf):
    months = st.side(spark, sf).select("order_id", "claims", "period")
    return schema.coerce_inputs(months, numeric=["claims"], categorical=["period"])


@query
def constants(spark, sf):
    return schema.with_constants(
        st.member(spark, sf), {"announced_5m": 0, "exchange_5m": 0}, {"churned_5m": "double"}
    )


@query
def row_index(spark, sf):
    orders = st.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return rows.with_index(orders, ["o_orderkey"], unique_order=True)


@query
def row_index_ties(spark, sf):
    """Index by a key many rows share; checked through the range of each key's numbers."""
    indexed = rows.with_index(st.table(spark, sf, "orders").select("o_orderstatus"), ["o_orderstatus"])
    return indexed.groupBy("o_orderstatus").agg(
        F.min("index").alias("first_index"), F.max("index").alias("last_index"), F.count_distinct("index").alias("n")
    )


# Filters and flags


@query
def orphan_flag(spark, sf):
    side = st.side(spark, sf).withColumn("end_period", dates.mixed_date_period(F.col("end_text")))
    side = side.withColumn(
        "orphan", flags.orphan_flag(F.col("end_period"), F.col("period").cast("int"), NO_END_PERIOD)
    )
    return rows.drop_unparsed(side, "end_period").select("order_id", "orphan")


@query
def filter_nonnegative(spark, sf):
    return rows.nonnegative(st.member(spark, sf), "balance")


@query
def shift_period(spark, sf):
    months = st.order_month(spark, sf)
    shifted = dates.shift_leavers(F.col("month"), F.col("status"), st.LEAVERS)
    listed = rows.in_list(F.col("status"), ["F", "P"])
    return dates_as_text(months.select("order_id", "month", shifted.alias("shifted"), listed.alias("listed")))


@query
def seniority_flag(spark, sf):
    months = st.order_month(spark, sf)
    back = dates.months_back(F.col("month"), F.lit(st.AS_OF).cast("date"))
    return months.select("order_id", back.alias("months"), flags.seniority_flag(back).alias("is_new"))


@query
def spend_flag(spark, sf):
    """Discount and tax as amounts, zero discounts as missing ones."""
    lines = st.table(spark, sf, "lineitem")
    missing = F.when(F.col("l_discount") != 0, F.col("l_discount"))
    return (
        lines.withColumn("spend", flags.spend_flag([missing, F.col("l_tax")]))
        .withColumn("spend_null", flags.spend_flag([missing, F.col("l_tax")], null_as_spend=True))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("spend").alias("with_spend"),
            F.sum("spend_null").alias("with_spend_or_missing"),
        )
    )


@query
def valid_period(spark, sf):
    key = F.col("order_id")
    months = st.order_month(spark, sf)
    period = F.col("period").cast("string")
    shown = F.when(key % 10 == 0, F.substring(period, 3, 4)).when(key % 10 == 1, F.concat(period, F.lit("a"))).otherwise(period)
    return months.select("order_id", shown.alias("text"), dates.valid_period(shown).alias("is_valid"))


@query
def top_quantile(spark, sf):
    return rows.top_quantile(st.member(spark, sf), "balance", 0.8).select("member_id", "balance")


def _campaign_rows(spark, sf):
    """Campaign inputs, churn score and a first-year margin per member; staged."""
    yearly = value.annualize(st.averages(spark, sf), ["income", "cost"])
    scored = scoring.score_churn(yearly, {"churn": st.CAMPAIGN_MODEL})
    worth = scored.select(
        "member_id",
        "churn",
        (F.col("income_cur") - F.col("cost_cur")).alias("predicted_margin_1"),
        ((F.col("income_cur") - F.col("cost_cur")) * 2.5).alias("ltv_no_churn_predicted"),
    )
    return stage(joins.attach_values(st.campaign_inputs(spark, sf), worth, "member_id"), "campaign")


@query
def eligibility(spark, sf):
    flagged = campaign_plan.eligibility(_campaign_rows(spark, sf), NAMES)
    strict = flags.within(F.col("predicted_margin_1"), 0.0, 1e7, include_low=False)
    return flagged.select(
        "member_id", "value_in_bounds", strict.alias("strictly_in_bounds"), "is_eligible", "top_churn", "meets_filters"
    )


@query
def flag_counts(spark, sf):
    flagged = campaign_plan.eligibility(_campaign_rows(spark, sf), NAMES)
    return quality.flag_counts(flagged, ["value_in_bounds", "is_eligible", "top_churn", "meets_filters"])


# Joins


@query
def join_two_key(spark, sf):
    side = schema.try_cast_columns(st.side(spark, sf), {"member_id": "bigint", "period": "int", "claims": "double"})
    fact = st.panel(spark, sf).filter(F.col("n_orders") >= 1).select("member_id", "period", "n_orders")
    shifted = side.withColumn("period", F.col("period") + (F.col("order_id") % 7 == 0).cast("int"))
    shifted = rows.dedup_first(shifted, ["member_id", "period"], ["order_id"])
    return joins.join_side(fact, shifted.select("member_id", "period", "claims", "end_text"), ["period", "member_id"])


@query
def join_stored(spark, sf):
    """Facts and side table stored in buckets of members: their join and the history of the result need no exchange."""
    side = schema.try_cast_columns(st.side(spark, sf), {"member_id": "bigint", "period": "int", "claims": "double"})
    fact = st.panel(spark, sf).select("member_id", "period", "n_orders", "urgent")
    names = {"fact": f"fact_{uuid.uuid4().hex}", "side": f"side_{uuid.uuid4().hex}"}
    for df, name in ((fact, names["fact"]), (side.select("member_id", "period", "claims"), names["side"])):
        sinks.write_bucketed(df, name, "member_id", 8, ["period"], scratch_path(spark, "buckets"))
    beside = joins.co_located(spark)
    joined = joins.join_side(beside.table(names["fact"]), beside.table(names["side"]), ["period", "member_id"])
    return history.running_max(joined, "member_id", "period", {"had_urgent": "urgent", "most_claims": "claims"})


@query
def join_category(spark, sf):
    lines = st.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    named = joins.lookup(lines, st.category(spark, sf), "l_partkey", "cod_categoria", ["preferente"])
    return named.groupBy("preferente").agg(F.count(F.lit(1)).alias("n"), F.count("cod_categoria").alias("matched"))


@query
def geo_chain(spark, sf):
    socio, codes, regions = st.geo(spark, sf)
    geo = joins.with_region(joins.communes(socio, codes), regions)
    located = joins.with_geo(st.located_members(spark, sf), geo)
    return located.select("member_id", "comuna_cod", "comuna", "cod_region", "gls_web_region", "norte_centro_sur", "avg_income")


@query
def join_scores(spark, sf):
    """Scores per order, one row per member kept, values attached."""
    scored = st.order_month(spark, sf).withColumn("score", F.round((F.col("order_id") % 100) / 100, 2))
    single = rows.dedup_first(scored.select("member_id", "order_id", "score"), ["member_id"], ["order_id"])
    values = rows.nonnegative(st.member(spark, sf), "balance").withColumn("score", F.lit(-1.0))
    return joins.attach_values(single, values.select("member_id", "balance", "score"), "member_id")


@query
def semi_members(spark, sf):
    rich = st.member(spark, sf).filter(F.col("balance") > 5000)
    return joins.keep_members(st.order_month(spark, sf), rich, "member_id").select("order_id", "member_id", "period")


# Aggregates and reports


@query
def distinct_members(spark, sf):
    return quality.distinct_members(st.order_month(spark, sf), "member_id")


@query
def distinct_members_sketched(spark, sf):
    """Members a year from sketches that were kept a month: is the merged estimate within the error stated for it?"""
    months = st.order_month(spark, sf).withColumn("year", F.floor(F.col("period") / 100).cast("int"))
    path = scratch_path(spark, "sketches")
    quality.member_sketches(months, "member_id", ["year", "period"]).write.parquet(path)
    merged = quality.merged_members(tables.read_table(spark, path), ["year"])
    exact = months.groupBy("year").agg(F.count_distinct("member_id").alias("members"))
    within = F.abs(F.col("estimate") - F.col("members")) <= F.col("members") * F.col("stated_error")
    return merged.join(exact, "year").select("year", "members", within.alias("is_within"))


@query
def uniqueness_check(spark, sf):
    months = st.order_month(spark, sf)
    before = quality.uniqueness_check(months, "member_id").withColumn("step", F.lit("before"))
    single = rows.dedup_first(months, ["member_id"], ["order_id"])
    return before.unionByName(quality.uniqueness_check(single, "member_id").withColumn("step", F.lit("after")))


@query
def score_stats(spark, sf):
    scored = scoring.score_churn(st.averages(spark, sf), {"churn": st.CAMPAIGN_MODEL})
    return rounded(quality.score_stats(scored, "churn"))


@query
def profile(spark, sf):
    return rounded(quality.profile(st.table(spark, sf, "customer"), ["c_custkey", "c_nationkey", "c_acctbal"]), 4)


@query
def null_report(spark, sf):
    lines = st.table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_returnflag", F.lit("R")).alias("flag"),
        "l_quantity",
    )
    return quality.null_report(lines)


@query
def distinct_values(spark, sf):
    return quality.distinct_values(st.table(spark, sf, "events"), "event_type")


@query
def simplify_category(spark, sf):
    """Short prefix of a category, and how many categories are left."""
    brands = st.table(spark, sf, "part").withColumn("simple", text.text_prefix(F.col("p_brand")))
    names = brands.withColumn("raw", F.when(F.col("p_partkey") % 7 == 0, F.concat(F.col("p_size").cast("string"), F.col("p_type"))).otherwise(F.col("p_brand")))
    names = names.withColumn("simple", text.text_prefix(F.col("raw")))
    return quality.category_counts(names, "raw", "simple")


@query
def text_prefix(spark, sf):
    parts = st.table(spark, sf, "part")
    raw = F.when(F.col("p_partkey") % 7 == 0, F.col("p_size").cast("string")).when(
        F.col("p_partkey") % 7 == 1, F.lit("")
    ).when(F.col("p_partkey") % 7 == 2, F.lit(None)).otherwise(F.col("p_brand"))
    return parts.select("p_partkey", text.text_prefix(raw).alias("prefix"))


@query
def quantile_cuts(spark, sf):
    return rounded(quantiles.quantile_table(st.member(spark, sf), ["balance"], [*VALUE_FRACTIONS, *CHURN_FRACTIONS]))


@query
def quantile_cuts_lines(spark, sf):
    """Quantiles of a longer column, cut into many buckets."""
    prices = st.table(spark, sf, "lineitem").select("l_extendedprice")
    fractions = [i / 20 for i in range(21)]
    found = quantiles.exact_quantiles(prices, ["l_extendedprice"], fractions, bucket_rows=2000)["l_extendedprice"]
    rows = [(float(q), v) for q, v in zip(fractions, found, strict=True)]
    return rounded(spark.createDataFrame(rows, "fraction double, value double"))


@query
def wasserstein_lines(spark, sf):
    """Distance of the prices of two kinds of lines, cut into many buckets."""
    lines = st.table(spark, sf, "lineitem")
    returned, others = lines.filter("l_returnflag = 'R'"), lines.filter("l_returnflag <> 'R'")
    return rounded(quality.wasserstein(returned, others, "l_extendedprice", "l_extendedprice", bucket_rows=2000))


@query
def row_mean(spark, sf):
    a = st.averages(spark, sf)
    spans = [F.nullif(F.col(f"income_mva_{s}"), F.lit(0.0)) for s in ("1to6m", "7to12m", "13to24m")]
    return rounded(a.select("member_id", numeric.row_mean(spans).alias("mean_income")), 8)


@query
def validate(spark, sf):
    orders = st.table(spark, sf, "orders").withColumn("note", F.nullif("o_orderstatus", F.lit("P")))
    return quality.validate(
        orders,
        [
            {"expect": "not_null", "column": "o_custkey"},
            {"expect": "not_null", "column": "note"},
            {"expect": "range", "column": "o_totalprice", "min": 1000.0, "max": 400000.0},
            {"expect": "in_set", "column": "o_orderstatus", "values": ["F", "O"]},
            {"expect": "type", "column": "o_custkey", "type": "bigint"},
            {"expect": "type", "column": "o_totalprice", "type": "decimal(12,2)"},
            {"expect": "unique", "column": "o_orderkey"},
            {"expect": "unique", "column": "o_custkey"},
        ],
    )


@query
def validate_failures(spark, sf):
    """Negative values first set to zero, as in the validated copy of a table."""
    customer = schema.zero_negatives(st.table(spark, sf, "customer"), ["c_acctbal"])
    return quality.validate(
        customer,
        [
            {"expect": "range", "column": "c_acctbal", "min": 0.0},
            {"expect": "range", "column": "c_acctbal", "max": 9000.0},
            {"expect": "in_set", "column": "c_mktsegment", "values": ["BUILDING", "MACHINERY"]},
            {"expect": "unique", "column": "c_custkey"},
        ],
        failures_only=True,
    )


# History


@query
def history_flags(spark, sf):
    months = st.order_month(spark, sf)
    months = months.withColumn("month", dates.shift_leavers(F.col("month"), F.col("status"), st.LEAVERS))
    months = months.withColumn("late", (F.col("status") == "O").cast("int"))
    flagged = history.ever_flags(months, "member_id", "month", {"had_urgent": "urgent", "had_late": "late"})
    return dates_as_text(flagged.select("order_id", "member_id", "month", "had_urgent", "had_late"))


@query
def history_carried(spark, sf):
    """The flags of ``history_flags`` with the months fed one batch after the other, the last ones singly, each from the state before it."""
    months = st.order_month(spark, sf)
    months = months.withColumn("month", dates.shift_leavers(F.col("month"), F.col("status"), st.LEAVERS))
    months = months.withColumns({"late": (F.col("status") == "O").cast("int"), "period": dates.period_of(F.col("month"))})
    months = stage(months.select("order_id", "member_id", "month", "period", "urgent", "late"), "months")
    folder, parts = scratch_path(spark, "history"), []
    periods = sorted(r["period"] for r in months.select("period").distinct().collect())
    steps = [periods[: len(periods) // 2], periods[len(periods) // 2 : -2], periods[-2:-1], periods[-2:-1], periods[-1:]]
    for step in steps:  # one month is run again
        batch = months.where(F.col("period").between(step[0], step[-1]))
        carried.advance(spark, folder, batch, "member_id", "period", {"had_urgent": "urgent", "had_late": "late"})
    for period in sorted({v.period for v in versions.versions(spark, folder)}):
        parts.append(versions.read_version(spark, folder, "flags", period).select("order_id", "member_id", "month", "had_urgent", "had_late"))
    return dates_as_text(reduce(DataFrame.unionByName, parts))


@query
def history_12(spark, sf):
    """The last 12 periods of the table, so that old months drop out."""
    flagged = history.ever_flags(st.order_month(spark, sf), "member_id", "month", {"had_urgent": "urgent"}, 12)
    return dates_as_text(flagged.select("order_id", "month", "had_urgent"))


@query
def history_100(spark, sf):
    """The last 100 periods, which here are all there are."""
    flagged = history.ever_flags(st.order_month(spark, sf), "member_id", "month", {"had_urgent": "urgent"}, 100)
    return dates_as_text(flagged.select("order_id", "month", "had_urgent"))


@query
def period_max(spark, sf):
    missing = st.order_month(spark, sf).withColumn("urgent", F.nullif("urgent", F.lit(0)))
    return history.period_max(missing, "member_id", "period", {"urgent": "urgent"})


@query
def rolling_max(spark, sf):
    months = st.panel(spark, sf).select("member_id", "period", "n_orders")
    return history.rolling_max(months, "member_id", "period", {"n_max": "n_orders"}, shift=1)


@query
def rolling_max_months(spark, sf):
    """Windows over calendar months: months without a row do not move them."""
    months = st.panel(spark, sf).select("member_id", "period", "n_orders")
    return history.rolling_max_months(months, "member_id", "period", {"n_max": "n_orders"}, shift=1, window=9, min_periods=2)


@query
def rolling_max_dense(spark, sf):
    """The same over a grid with a row for every month, zero where there was none."""
    months = st.panel(spark, sf).select("member_id", "month", "n_orders").where(F.col("month") >= "2000-01-01")
    dense = history.dense_months(months, "member_id", "month", {"n_orders": "n_orders"})
    return dates_as_text(history.rolling_max(dense, "member_id", "month", {"n_max": "n_orders"}, window=6, min_periods=3))


@query
def window_averages(spark, sf):
    as_of = F.lit(st.AS_OF).cast("date")
    return rounded(history.window_averages(st.panel(spark, sf), "member_id", "month", as_of, ["income", "cost", "margin"]))


@query
def dedup_first(spark, sf):
    months = st.order_month(spark, sf).select("member_id", "order_id", "status")
    return rows.dedup_first(months, ["member_id"], ["order_id"])


@query
def dedup_last(spark, sf):
    months = st.order_month(spark, sf).select("member_id", "period", "order_id", "urgent")
    return rows.order_rows(rows.dedup_last(months, ["member_id", "period"], ["urgent", "order_id"]), ["member_id", "period"])


@query
def latest_row(spark, sf):
    months = st.order_month(spark, sf).select("member_id", "period", "order_id", "urgent")
    return rows.latest_row(months, "member_id", "period", 200105, ["urgent", "order_id"])


@query
def top_members(spark, sf):
    return rows.preview(st.member(spark, sf), ["member_id"], 5)


@query
def append_history(spark, sf):
    months = st.order_month(spark, sf).select("order_id", "member_id", "period", "urgent")
    old = months.filter(F.col("period") < 200101).drop("urgent")
    return rows.append_history(old, months.filter(F.col("period") >= 200101))


# Scalar functions


@query
def period_dates(spark, sf):
    start = dates.period_date(F.col("period"))
    shown = st.order_month(spark, sf).select(
        "order_id", start.alias("start"), dates.previous_month(start).alias("previous"), dates.next_month(start).alias("next")
    )
    return dates_as_text(shown)


@query
def period_tag(spark, sf):
    month = F.col("month")
    return st.order_month(spark, sf).select(
        "order_id", dates.period_tag(month).alias("tag"), dates.period_tag(dates.previous_month(month)).alias("previous_tag")
    )


@query
def parse_mixed_dates(spark, sf):
    return st.side(spark, sf).select("order_id", "end_text", dates.mixed_date_period(F.col("end_text")).alias("end_period"))


@query
def clean_text(spark, sf):
    parts = st.table(spark, sf, "part").withColumn("p_type", F.concat("p_type", F.repeat(F.lit(" "), F.col("p_size") % 4)))
    trimmed = schema.rtrim_columns(parts, ["p_type", "absent"])
    return trimmed.select("p_partkey", "p_type", text.replace_all(F.col("p_brand"), st.REPLACEMENTS).alias("cleaned"))


@query
def plan_tier(spark, sf):
    return st.category(spark, sf).select("cod_categoria", text.tier(F.col("preferente"), st.TIERS, {"le": ["Brand#17"]}).alias("tier"))


@query
def capped_ratio(spark, sf):
    lines = st.table(spark, sf, "lineitem")
    ratio = numeric.capped_ratio(F.col("l_extendedprice"), F.nullif("l_quantity", F.lit(7.0)) - 3, 1500.0)
    return rounded(lines.select("l_orderkey", "l_linenumber", ratio.alias("ratio")), 9)


@query
def clamp(spark, sf):
    balance = F.nullif(F.col("balance"), F.lit(0.0))
    return rounded(
        st.member(spark, sf).select(
            "member_id", numeric.clamp01(balance / 5000).alias("share"), numeric.zero_if_negative(balance).alias("positive")
        )
    )


@query
def annualize(spark, sf):
    yearly = value.annualize(st.averages(spark, sf), ["income", "cost", "margin"])
    return rounded(schema.keep_like(yearly, ["member_id", "_cur", "_prev"]))


@query
def lifetime_value(spark, sf):
    """Three margins from the window averages, three churn scores."""
    yearly = value.annualize(st.averages(spark, sf), ["income", "cost"])
    models = {f"churn_{y}": m for y, m in zip(lifetime.YEARS, st.MODELS.churn, strict=True)}
    scored = scoring.score_churn(yearly, models)
    first = numeric.margin(F.col("income_cur"), F.col("cost_cur"))
    margins = [first, first * 0.9, numeric.margin(F.col("income_prev"), F.col("cost_prev"))]
    churns = [F.col(f"churn_{y}") for y in lifetime.YEARS]
    return rounded(
        scored.select(
            "member_id",
            numeric.lifetime_value(margins, churns).alias("ltv"),
            numeric.lifetime_value_no_churn(margins).alias("ltv_no_churn"),
        ),
        4,
    )


# Statistics, scores and segments


@query
def quantile_rank(spark, sf):
    ranked = quantiles.quantile_rank(st.member(spark, sf), {"balance": "balance_rank", "region_code": "region_rank"})
    return rounded(ranked.select("member_id", "balance_rank", "region_rank"))


@query
def nearest_bucket(spark, sf):
    lines = st.table(spark, sf, "orders")
    p = (F.col("o_orderkey") % 1001) / 1000
    return lines.select("o_orderkey", numeric.nearest_bucket(p).alias("nearest"), numeric.percent_bucket(p).alias("percent"))


def _placed(spark, sf):
    yearly = stage(value.annualize(st.averages(spark, sf), ["income", "cost"]), "yearly")
    return yearly, quantiles.quantile_rank(yearly, {"income_prev": "perc_prev", "income_cur": "perc_cur"})


@query
def bucket_drift(spark, sf):
    _, placed = _placed(spark, sf)
    return rounded(value.bucket_drift(placed, "perc_prev", "perc_cur", "income_prev", "income_cur"))


@query
def percentile_to_value(spark, sf):
    yearly, placed = _placed(spark, sf)
    scored = scoring.score_percentiles(yearly, {f"p_{y}": m for y, m in zip(lifetime.YEARS, st.MODELS.income, strict=True)})
    drift = value.bucket_drifts(placed, {"income_prev": ("perc_prev", "perc_cur", "income_prev", "income_cur")})
    pool = quantiles.rank_values(yearly, ["income_prev"])
    requests = {f"predicted_{y}": (f"p_{y}", "income_prev", y) for y in lifetime.YEARS}
    return rounded(value.percentile_to_value(scored, "member_id", requests, pool, drift))


@query
def score_linear(spark, sf):
    scored = scoring.score_churn(st.averages(spark, sf), {"churn": st.CAMPAIGN_MODEL})
    scored = scoring.score_percentiles(scored, {"p_income": st.MODELS.income[0]})
    return rounded(scored.select("member_id", "churn", "p_income"), 8)


@query
def score_ml_model(spark, sf):
    """A stored pipeline model, loaded and applied in place."""
    intercept, weights = st.CAMPAIGN_MODEL
    z = " + ".join([str(intercept), *[f"({w}D) * {c}" for c, w in weights.items()]])
    path = scratch_path(spark, "model")
    PipelineModel([SQLTransformer(statement=f"SELECT *, 1 / (1 + exp(-({z}))) AS p1 FROM __THIS__")]).save(path)
    scored = scoring.score_model(st.averages(spark, sf), PipelineModel.load(path), "churn", probability="p1")
    return rounded(scored.select("member_id", "churn"))


def _raw_members(spark, sf):
    """Orders in the shape of an export: upper-case names, several rows of a member in a month."""
    orders = st.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("RENTA_IMPONIBLE"))
    months = st.order_month(spark, sf).join(orders, "order_id")
    return months.select(
        F.col("order_id").alias("ORDER_ID"),
        F.col("member_id").alias("ID_TITULAR"),
        F.col("period").alias("PERIODO"),
        F.col("RENTA_IMPONIBLE"),
        F.when(F.col("order_id") % 5 == 0, 0.0).otherwise(2000.0).alias("VALOR_UF"),
        F.col("status").alias("LINEA_PLAN"),
        F.col("urgent").cast("string").alias("EDAD"),
    )


@query
def campaign_input_report(spark, sf):
    """Which of the 44 model inputs a raw month has."""
    rows = tables.scan_period(_raw_members(spark, sf), dates.check_period("199803"), column="PERIODO")
    shaped = campaign_plan.shape_inputs(rows, campaign_plan.CampaignNames(), ["order_id"])
    return campaign_plan.input_report(shaped)


@query
def score_raw_members(spark, sf):
    """A raw month to scores: one typed row per member, scored by a fitted pipeline with a probability vector.

    The model is a logistic regression on one yes-or-no input, whose probabilities are the shares of its groups.
    """
    raw = _raw_members(spark, sf)
    rows = tables.scan_period(raw, dates.check_period("199803"), column="PERIODO")
    shaped = campaign_plan.shape_inputs(rows, campaign_plan.CampaignNames(), ["order_id"])
    history_rows = raw.select(F.col("EDAD").cast("double").alias("edad"), (F.col("LINEA_PLAN") == "F").cast("double").alias("label"))
    counts = stage(history_rows.groupBy("edad", "label").agg(F.count(F.lit(1)).cast("double").alias("n")), "training")
    vectors = VectorAssembler(inputCols=["edad"], outputCol="features", handleInvalid="keep")
    model = LogisticRegression(weightCol="n", maxIter=500, tol=1e-14)
    fitted = Pipeline(stages=[vectors, model]).fit(counts)
    path = scratch_path(spark, "model")
    fitted.save(path)
    scored = scoring.score_model(shaped, PipelineModel.load(path), "prob_fuga")
    return scored.select("id_titular", F.round("renta_imponible_uf", 6).alias("renta_imponible_uf"), F.round("prob_fuga", 4).alias("prob_fuga"))


CATEGORIES = ["priority", "status", "segment_name"]


def _level_table(spark, sf):
    """The dictionary of the training months, written and read back."""
    training = st.contracts(spark, sf).where(F.col("period") < st.TRAINED_TO)
    path = scratch_path(spark, "levels")
    levels.level_table(training, CATEGORIES).write.parquet(path)
    return tables.read_table(spark, path)


@query
def level_table(spark, sf):
    return _level_table(spark, sf)


@query
def level_report(spark, sf):
    """Categories of the months after training, against the dictionary of the training months."""
    later = st.contracts(spark, sf).where(F.col("period") >= st.TRAINED_TO)
    return levels.level_report(later, _level_table(spark, sf), CATEGORIES)


@query
def with_levels(spark, sf):
    later = st.contracts(spark, sf).where(F.col("period") >= st.TRAINED_TO)
    return levels.with_levels(later, _level_table(spark, sf), CATEGORIES).select("order_id", *CATEGORIES)


@query
def score_trees(spark, sf):
    """Ten ensembles over the same inputs, trained on earlier months, stored, loaded, and applied to later ones in one pass."""
    contracts = st.contracts(spark, sf)
    training = contracts.where(F.col("period") < st.TRAINED_TO)
    targets = {f"{m}_{y}": ensembles.Target(f"{m}_label_{y}", "percentile", trees=1, depth=2, min_gain=1e-4)
               for m in ("income", "cost") for y in lifetime.YEARS}
    targets |= {f"churn_{y}": ensembles.Target(f"churn_label_{y}", trees=1, depth=1) for y in lifetime.YEARS}
    targets["churn_campaign"] = ensembles.Target("campaign_label", trees=1, depth=1)
    fitted = ensembles.fit_ensembles(training, _level_table(spark, sf), ["season"], ["priority", "status"], targets)
    folder = scratch_path(spark, "ensembles")
    fitted.save(folder)
    later = contracts.where(F.col("period") >= st.TRAINED_TO).select("order_id", "season", "priority", "status")
    scored = ensembles.score_ensembles(later, ensembles.EnsembleSet.load(spark, folder))
    return rounded(scored.select("order_id", *targets), 8)


@query
def compare_columns(spark, sf):
    """Two populations on numbers and categories at once: months before and after a cut."""
    contracts = st.contracts(spark, sf).withColumn("cost_known", F.when(F.col("order_id") % 11 != 0, F.col("cost_label_1")))
    old, new = contracts.where(F.col("period") < st.TRAINED_TO), contracts.where(F.col("period") >= st.TRAINED_TO)
    return rounded(populations.compare_columns(old, new, ["season", "cost_known", "income_label_2"], CATEGORIES))


@query
def compare_columns_buckets(spark, sf):
    """Numbers of two populations of lines, each column cut into many buckets."""
    lines = st.table(spark, sf, "lineitem")
    returned, others = lines.where("l_returnflag = 'R'"), lines.where("l_returnflag <> 'R'")
    found = populations.compare_numbers(returned, others, ["l_extendedprice", "l_quantity"], bucket_rows=2000)
    return rounded(found)


@query
def wasserstein(spark, sf):
    return rounded(quality.wasserstein(st.table(spark, sf, "customer"), st.table(spark, sf, "supplier"), "c_acctbal", "s_acctbal"))


@query
def score_drift(spark, sf):
    """Scores of members and of a training population, compared with the alarm level."""
    score = {"churn": (-1.0, {"balance_k": -0.2})}
    new = scoring.score_churn(st.member(spark, sf).select((F.col("balance") / 1000.0).alias("balance_k")), score)
    train = scoring.score_churn(st.table(spark, sf, "supplier").select((F.col("s_acctbal") / 1000.0).alias("balance_k")), score)
    return rounded(campaign_plan.score_drift(new, train, "churn"))


@query
def compare_categorical(spark, sf):
    a = st.table(spark, sf, "customer")
    return rounded(quality.compare_categorical(a, st.table(spark, sf, "supplier"), "c_nationkey", "s_nationkey"))


@query
def compare_numeric(spark, sf):
    return rounded(quality.compare_numeric(st.table(spark, sf, "customer"), st.table(spark, sf, "supplier"), "c_acctbal", "s_acctbal"))


@query
def grid_segments(spark, sf):
    rows_ = _campaign_rows(spark, sf)
    cuts = segments.grid_cuts(rows_, rows_, "predicted_margin_1", "churn")
    return segments.grid_segments(rows_, cuts, "predicted_margin_1", "churn").select("member_id", "segment")


@query
def grid_stats(spark, sf):
    rows_ = _campaign_rows(spark, sf)
    cuts = segments.grid_cuts(rows_, rows_, "predicted_margin_1", "churn")
    return rounded(segments.grid_stats(rows_, cuts, "member_id", "predicted_margin_1", "churn"), 4)


@query
def grid_pivot(spark, sf):
    rows_ = _campaign_rows(spark, sf)
    cuts = segments.grid_cuts(rows_, rows_, "predicted_margin_1", "churn")
    stats = segments.grid_stats(rows_, cuts, "member_id", "predicted_margin_1", "churn")
    return rounded(segments.grid_pivot(stats), 4)


def _segment_inputs(spark, sf):
    a = value.annualize(st.averages(spark, sf), ["income", "cost"])
    scored = scoring.score_churn(a, {"mean_churn": st.CAMPAIGN_MODEL})
    return scored.select(
        "member_id",
        F.col("income_cur").alias("mean_income"),
        F.col("cost_cur").alias("mean_cost"),
        "mean_churn",
        ((F.col("income_cur") - F.col("cost_cur")) * 2).alias("ltv_predicted"),
        ((F.col("income_cur") - F.col("cost_cur")) * 2.5).alias("ltv_no_churn_predicted"),
    )


@query
def segment_assign(spark, sf):
    assigned = segments.assign_segment(
        _segment_inputs(spark, sf), lifetime.SEGMENT_FEATURES, st.MODELS.centroids, st.MODELS.scale
    )
    return assigned.select("member_id", "cluster", "category")


@query
def segment_kmeans(spark, sf):
    """Segments of a fitted clustering model: k-means of the five given centroids, one cluster each.

    The model stands for a stored one; its cluster numbers are matched to those of the centroids.
    """
    inputs = _segment_inputs(spark, sf)
    features = list(lifetime.SEGMENT_FEATURES)
    scale = st.MODELS.scale or {}
    scaled = {f: segments.standardize(F.col(f), *scale[f]) if f in scale else F.col(f) for f in features}
    names = [f"_scaled_{i}" for i in range(len(features))]
    points = spark.createDataFrame([tuple(map(float, c)) for c in st.MODELS.centroids], [f"_feature_{i}" for i in range(len(features))])
    vectors = VectorAssembler(inputCols=points.columns, outputCol="features").transform(points)
    model = KMeans(k=len(st.MODELS.centroids), seed=1, initMode="random").fit(vectors)
    given = [[float(x) for x in c] for c in st.MODELS.centroids]
    number = {k: given.index([round(float(x), 9) for x in c]) + 1 for k, c in enumerate(model.clusterCenters())}
    ready = inputs.withColumns({n: scaled[f] for n, f in zip(names, features, strict=True)})
    found = segments.assign_segment_model(ready, names, model).select("member_id", F.col("cluster").alias("found"))
    cluster = F.element_at(F.create_map(*[F.lit(x) for k, n in number.items() for x in (k + 1, n)]), F.col("found"))
    return found.withColumn("cluster", cluster).select("member_id", "cluster", label(F.col("cluster"), SEGMENT_LABELS).alias("category"))


@query
def segment_fitted(spark, sf):
    """Clusters fitted on the members themselves, stored and loaded: is every member's the nearest of the model's centres?"""
    inputs = stage(_segment_inputs(spark, sf), "segment-members")
    features, path = list(lifetime.SEGMENT_FEATURES), scratch_path(spark, "model")
    segments.fit_segments(inputs, features, seed=3).save(path)
    model = PipelineModel.load(path)
    found = segments.assign_segment_model(inputs, features, model)
    centres, scale = segments.segment_centres(model, features)
    both = segments.assign_segment(found, features, centres, scale, out="nearest", out_label="nearest_category")
    return both.select("member_id", (F.col("cluster") == F.col("nearest")).alias("is_nearest"), F.lit(len(centres)).alias("n_centres"))


@query
def deliverable(spark, sf):
    """Orders of a member, the first one delivered with a reduced amount."""
    orders = st.table(spark, sf, "orders")
    return rounded(
        segments.deliverable(
            orders,
            "o_custkey",
            {"o_custkey": "member_id", "o_orderstatus": "status", "o_totalprice": "promised_amount"},
            "o_totalprice",
            ["o_orderkey"],
        )
    )


# Whole jobs


@query
def prepare_members(spark, sf):
    """Facts, side table and lookups to prepared rows."""
    socio, codes, regions = st.geo(spark, sf)
    places = st.located_members(spark, sf).withColumnRenamed("member_id", "id_titular")
    months = st.order_month(spark, sf).select(
        "order_id",
        F.col("member_id").alias("id_titular"),
        F.col("period").alias("periodo"),
        F.col("status").alias("tipo_transac"),
        F.col("urgent").alias("cie_complejo"),
        (F.col("order_id") % 24).cast("int").alias("antiguedad"),
        F.when(F.col("order_id") % 9 == 0, F.col("order_id") * 1.0).otherwise(F.lit(0.0)).alias("gasto_licencias"),
        F.when(F.col("order_id") % 4 == 0, F.lit(0.0)).alias("gasto_licencias_excl"),
        (F.col("order_id") % 2000).alias("categoria_cod"),
        F.concat(F.col("status"), F.lit("  ")).alias("serie"),
    )
    fact = months.join(places.select("id_titular", F.col("balance").alias("renta_imponible"), "comuna_cod"), "id_titular")
    side = st.side(spark, sf).select(
        F.col("member_id").alias("id_titular"), F.col("period").alias("periodo"),
        F.col("end_text").alias("fld_termino"), F.col("claims").alias("n_ges_mva_2m"),
    )
    lookups = preparation.Lookups(st.category(spark, sf), regions, codes, socio)
    names = preparation.PreparationNames(leaver_codes=st.LEAVERS, tiers=st.TIERS, replacements=st.REPLACEMENTS)
    prepared = preparation.prepare(fact, side, lookups, names=names)
    kept = prepared.select(
        "order_id", "id_titular", "periodo", "huerfano", "n_ges_mva_2m", "preferente", "cat_linea_plan", "comuna",
        "norte_centro_sur", "avg_income", "serie", "ant_m12_y_ges", "hubo_cie_complejo", "hay_gasto_licencia", "hubo_licencia",
        "hay_preges_5m", "fuga_5m",
    )
    return dates_as_text(kept)


def _values(spark, sf):
    return _valued(st.averages(spark, sf))


def _valued(averages):
    return lifetime.value_members(averages, "member_id", st.MODELS, ["member_id"])


@query
def value_members(spark, sf):
    """Window averages to lifetime value, ranks and segment."""
    kept = [f"predicted_{m}_{y}" for m in ("income", "cost", "margin") for y in lifetime.YEARS]
    kept += ["ltv_predicted", "ltv_no_churn_predicted", "ltv_predicted_perc", "predicted_margin_1_perc", "cluster", "category"]
    return rounded(_values(spark, sf).select("member_id", *kept))


def _campaign_frames(spark, sf):
    """Value table, and the joined table with its flags."""
    averages = stage(st.averages(spark, sf), "averages")
    scored = scoring.score_churn(averages, {"churn": st.CAMPAIGN_MODEL})
    inputs = st.campaign_inputs(spark, sf).join(scored.select("member_id", "churn"), "member_id")
    values = _valued(averages)
    table = campaign_plan.campaign_table(inputs, values, NAMES, ["member_id"])
    return values, campaign_plan.eligibility(stage(table, "campaign_table"), NAMES)


def _campaign(spark, sf, flagged=None):
    flagged = _campaign_frames(spark, sf)[1] if flagged is None else flagged
    columns = {
        "member_id": "member_id", "age": "age", "segment_name": "segment_name", "churn": "churn",
        "ltv_no_churn_predicted": "ltv_no_churn_predicted", "predicted_margin_1": "margin_1y",
    }
    return campaign_plan.campaign(flagged, NAMES, columns, ["member_id"])


@query
def campaign_segments(spark, sf):
    """Eligible members with their grid cell: the campaign's first deliverable."""
    return rounded(_campaign(spark, sf)["segments"])


@query
def campaign_everyone(spark, sf):
    """All members with the eligibility flag: the campaign's second deliverable."""
    return rounded(_campaign(spark, sf)["everyone"])


@query
def campaign_publish(spark, sf):
    """The campaign's tables published, and everyone's row read back with the segment of the clustered ones."""
    values, flagged = _campaign_frames(spark, sf)
    folder, period = scratch_path(spark, "campaign"), st.AS_OF_PERIOD
    scores = flagged.select("member_id", "churn", "ltv_predicted", "ltv_no_churn_predicted")
    campaign_plan.publish_campaign(_campaign(spark, sf, flagged), values.select("member_id", "ltv_predicted"), scores, folder, period)
    people, clusters, worth, scored = (
        versions.read_version(spark, folder, name, period) for name in ("predictions", "clusters", "values", "scores")
    )
    worth = worth.withColumnRenamed("LTV_PREDICTED", "LTV")
    joined = people.join(clusters.select("MEMBER_ID", "SEGMENT"), "MEMBER_ID", "left").join(worth, "MEMBER_ID", "left")
    joined = joined.join(scored.select("MEMBER_ID", "LTV_PREDICTED"), "MEMBER_ID", "left")
    return rounded(
        joined.select("MEMBER_ID", "CHURN", "MARGIN_1Y", "MEETS_FILTERS", "SEGMENT", (F.col("LTV") - F.col("LTV_PREDICTED")).alias("LTV_GAP"))
    )
