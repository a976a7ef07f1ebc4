"""Views of the sample tables that stand for members, member months and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from membervane.functions.dates import months_back, period_of, period_tag
from membervane.operators.history import window_averages
from membervane.operators.rows import dedup_first
from membervane.plans.lifetime import ValueModels

AS_OF = "2001-08-01"
AS_OF_PERIOD = 200107
LEAVERS = ("F",)
TIERS = {
    "alto": ("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5"),
    "medio": ("Brand#5", "Brand#6", "Brand#7", "Brand#8", "Brand#9"),
    "bajo": ("Brand#11", "Brand#12", "Brand#13", "Brand#14", "Brand#15"),
    "le": ("Brand#16",),
}
REPLACEMENTS = (("Brand#1", "first "), ("first 2", "UC "), ("#", " no. "))

CHURN_FEATURES = {"balance_k": -0.15, "recency": 0.08, "is_building": 0.5}
CAMPAIGN_MODEL = (-1.5, {"balance_k": -0.2, "recency": 0.05, "is_building": 0.7})
MODELS = ValueModels(
    income=[(0.36, {"balance_k": 0.07, "recency": -0.011}), (0.38, {"balance_k": 0.06, "recency": -0.009}),
            (0.40, {"balance_k": 0.05, "recency": -0.007})],
    cost=[(0.31, {"balance_k": 0.06, "recency": -0.008}), (0.33, {"balance_k": 0.05, "recency": -0.007}),
          (0.35, {"balance_k": 0.04, "recency": -0.006})],
    churn=[(-2.2, CHURN_FEATURES), (-1.9, CHURN_FEATURES), (-1.6, CHURN_FEATURES)],
    centroids=[(1.0, 1.0, -0.5, 0.8, 0.9), (-0.5, -0.4, 0.2, -0.4, -0.3), (0.2, 0.1, 0.0, 0.2, 0.1),
               (-1.0, -0.9, 1.5, -0.8, -0.7), (2.0, 1.8, -0.8, 2.1, 2.0)],
    scale={"mean_income": (200000.0, 100000.0), "mean_cost": (20000.0, 10000.0), "mean_churn": (0.2, 0.1),
           "ltv_predicted": (350000.0, 180000.0), "ltv_no_churn_predicted": (450000.0, 220000.0)},
)


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A sample table; its schema is read from the files once."""
    path = f"{sf}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def member(spark: SparkSession, sf: str) -> DataFrame:
    """One row per member."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("member_id"),
        F.col("c_nationkey").alias("region_code"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment_name"),
    )


def order_month(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order: several rows may share a member and a month."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("member_id"),
        F.trunc("o_orderdate", "MM").alias("month"),
        period_of(F.col("o_orderdate")).alias("period"),
        F.col("o_orderstatus").alias("status"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"),
    )


#: First period after the months that models and dictionaries are made of.
TRAINED_TO = 200001


def contracts(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order with model inputs, some of them missing, and labels for ten models.

    One priority and one segment do not occur before ``TRAINED_TO``. Labels follow season and priority, plus a remainder of the order number.
    """
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"))
    rows = order_month(spark, sf).join(orders, "order_id").join(member(spark, sf).select("member_id", "segment_name"), "member_id")
    old = F.col("period") < TRAINED_TO
    rows = rows.where(~old | ((F.col("priority") != "3-MEDIUM") & (F.col("segment_name") != "MACHINERY")))
    key = F.col("order_id")
    rows = rows.select(
        "order_id", "period", "status", "segment_name",
        F.when(key % 13 != 0, F.month("month")).alias("season"),
        F.when(key % 17 != 0, F.col("priority")).alias("priority"),
    )
    dear, low = F.coalesce(F.col("priority").isin("1-URGENT", "2-HIGH"), F.lit(False)), F.coalesce(F.col("priority") == "5-LOW", F.lit(False))
    income = F.when(F.col("season") <= 6, 20).when(dear, 50).otherwise(80)
    cost = F.when(low, 90).when(F.col("season") <= 3, 10).otherwise(40)
    leaving = F.when(F.col("season") <= 6, 2).otherwise(6)
    labels = {"campaign_label": (key % 10 < F.when(dear, 7).otherwise(2)).cast("int")}
    for year in (1, 2, 3):
        labels[f"income_label_{year}"] = (income + key % 7 + year) / 100.0
        labels[f"cost_label_{year}"] = (cost + key % 5 + year) / 100.0
        labels[f"churn_label_{year}"] = (key % 10 < leaving + year).cast("int")
    return rows.withColumns(labels)


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """One row per member and month with exact income, cost and margin.

    Lines are summed per order in whole hundredths of a cent before they meet their order.
    """
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    discount = F.rint(F.col("l_discount") * 100).cast("bigint")
    tax = F.rint(F.col("l_tax") * 100).cast("bigint")
    per_order = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(
            F.sum(cents * (100 - discount)).alias("income"),
            F.sum(cents * (discount + tax)).alias("cost"),
        )
    )

    def money(name: str):
        exact = F.sum(F.col(name).cast("decimal(20,0)")) / F.lit(10000).cast("decimal(5,0)")
        return exact.cast("decimal(28,4)").alias(name)

    months = (
        order_month(spark, sf)
        .join(per_order, "order_id")
        .groupBy("member_id", "month", "period")
        .agg(money("income"), money("cost"), F.count(F.lit(1)).alias("n_orders"), F.max("urgent").alias("urgent"))
    )
    return months.withColumn("margin", (F.col("income") - F.col("cost")).cast("decimal(28,4)"))


def averages(spark: SparkSession, sf: str) -> DataFrame:
    """Window averages of every member, zero for members without recent months, and score inputs."""
    as_of = F.lit(AS_OF).cast("date")
    recent = window_averages(panel(spark, sf), "member_id", "month", as_of, ["income", "cost", "margin"])
    last_seen = order_month(spark, sf).groupBy("member_id").agg(F.max("month").alias("last_month"))
    joined = member(spark, sf).join(last_seen, "member_id", "left").join(recent, "member_id", "left")
    filled = joined.fillna(0.0, [c for c in recent.columns if c != "member_id"])
    return filled.select(
        "member_id",
        (F.col("balance") / 1000.0).alias("balance_k"),
        F.coalesce(months_back(F.col("last_month"), as_of), F.lit(99)).cast("double").alias("recency"),
        (F.col("segment_name") == "BUILDING").cast("double").alias("is_building"),
        *[c for c in recent.columns if c != "member_id"],
    )


def side(spark: SparkSession, sf: str) -> DataFrame:
    """Side table as text, one row per member and period, with end dates in three formats."""
    orders = dedup_first(order_month(spark, sf), ["member_id", "period"], ["order_id"])
    key = F.col("order_id")
    end = F.when(key % 11 == 0, F.lit("1900-01-01").cast("date")).otherwise(
        F.add_months(F.col("month"), (key % 5 - 2).cast("int")) + (key % 28).cast("int")
    )
    text = (
        F.when(key % 97 == 0, F.lit("junk"))
        .when(key % 3 == 0, F.date_format(end, "MM/dd/yyyy"))
        .when(key % 3 == 1, F.date_format(end, "dd/MM/yyyy"))
        .otherwise(F.date_format(end, "yyyy/MM/dd"))
    )
    return orders.select(
        "order_id",
        F.col("member_id").cast("string").alias("member_id"),
        F.col("period").cast("string").alias("period"),
        text.alias("end_text"),
        F.when(key % 13 == 0, F.lit("x")).otherwise((key % 4).cast("string")).alias("claims"),
    )


def category(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("cod_categoria"), F.col("p_brand").alias("preferente")
    )


def geo(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Commune data, commune codes and regions; a region has one row per nation in it."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    socio = nation.select(
        F.col("n_name").alias("comuna"), (F.col("n_nationkey") * 100 + 50.0).alias("avg_income")
    )
    codes = nation.select(
        F.col("n_name").alias("con_comuna_gls"),
        ((F.col("n_regionkey") + 1) * 1000 + F.col("n_nationkey")).alias("cod_comuna"),
    )
    zone = F.when(F.col("r_regionkey") < 2, "norte").when(F.col("r_regionkey") == 2, "centro").otherwise("sur")
    regions = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        (F.col("r_regionkey") + 1).alias("cod_region"),
        F.col("r_name").alias("gls_web_region"),
        zone.alias("norte_centro_sur"),
    )
    return socio, codes, regions


def located_members(spark: SparkSession, sf: str) -> DataFrame:
    """Members with the commune code of their nation."""
    _, codes, _ = geo(spark, sf)
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("con_comuna_gls"))
    code_of = nation.join(codes, "con_comuna_gls").select("n_nationkey", F.col("cod_comuna").alias("comuna_cod"))
    members = member(spark, sf)
    return members.join(code_of, members["region_code"] == code_of["n_nationkey"], "left").drop("n_nationkey")


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """A folder listing: one file per event, named after a job and a month."""
    key = F.col("event_id")
    tag = period_tag(F.add_months(F.to_date("ts"), (key % 12).cast("int")))
    job = F.when(key % 3 == 0, "ltv").when(key % 3 == 1, "ready").otherwise("score_LTV")
    return table(spark, sf, "events").select(
        "event_id", F.concat(job, F.lit("_"), tag, F.lit(".gz")).alias("name"), F.col("ts").alias("modified")
    )


def campaign_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """Age, complex months and recent claims per member."""
    months = order_month(spark, sf).withColumn("back", months_back(F.col("month"), F.lit(AS_OF).cast("date")))
    recent = (
        months.filter((F.col("month") < AS_OF) & (F.col("month") >= "2001-02-01"))
        .groupBy("member_id")
        .agg(
            F.max("urgent").alias("complex_6m"),
            F.count_if(F.col("back") <= 2).alias("claims_2m"),
        )
    )
    members = member(spark, sf).select(
        "member_id", (F.col("member_id") * 7 % 60 + 20).cast("int").alias("age"), "segment_name", "region_code"
    )
    return members.join(recent, "member_id", "left").fillna(0, ["complex_6m", "claims_2m"])
