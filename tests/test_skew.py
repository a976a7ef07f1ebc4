"""One member, one value or one fraction that holds a third of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from membervane.operators import history, quantiles, rows, value
from membervane.session import stage


@pytest.fixture(scope="module")
def skewed(spark):
    """60,000 rows; member 7 has every third one, half of those in one month."""
    i = F.col("id")
    member = F.when(i % 3 == 0, F.lit(7)).otherwise((i * 31 % 5000).cast("int"))
    month = F.when((i % 3 == 0) & (i % 2 == 0), F.lit(12)).otherwise((i % 24).cast("int"))
    return spark.range(0, 60000, 1, 8).select(i, member.alias("m"), month.alias("p"), (i % 97 == 5).cast("int").alias("x"))


def test_first_row_of_a_hot_member(skewed):
    got = rows.dedup_first(skewed, ["m"], ["id"])
    want = {r["m"]: r["id"] for r in skewed.groupBy("m").agg(F.min("id").alias("id")).collect()}
    assert {r["m"]: r["id"] for r in got.collect()} == want


SMALL_SPLITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


def test_history_of_a_hot_member(spark, skewed):
    before = {k: spark.conf.get(k, None) for k in SMALL_SPLITS}
    for k, v in SMALL_SPLITS.items():
        spark.conf.set(k, v)
    try:
        got = history.ever_flags(skewed, "m", "p", {"seen": "x"})
        first = skewed.filter("x = 1").groupBy("m").agg(F.min("p").alias("hit"))
        both = got.join(first, "m", "left")
        wrong = both.filter(F.col("seen") != F.coalesce((F.col("p") >= F.col("hit")).cast("int"), F.lit(0)))
        assert wrong.count() == 0 and got.count() == 60000
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, "the hot month of the hot member must be split over tasks"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_index_cuts_through_a_hot_key(spark, skewed, monkeypatch):
    staged = []
    monkeypatch.setattr(rows, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = rows.with_index(skewed.select("m", "id"), ["m"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_task = staged[-1].groupBy(F.shiftrightunsigned("_place", 33)).count()
    assert per_task.agg(F.max("count")).first()[0] < 19000, "the rows of member 7 must not be in one task"
    assert got.agg(F.count_distinct("index"), F.min("index"), F.max("index")).first() == (60000, 0, 59999)
    order = got.groupBy("m").agg(F.min("index").alias("lo"), F.max("index").alias("hi"), F.count("*").alias("n"))
    assert order.filter("hi - lo + 1 <> n").count() == 0


def test_hot_fraction_is_dealt_out(spark, skewed, monkeypatch):
    """A third of the requests ask for the same fraction: no share gets more than its size."""
    monkeypatch.setattr(quantiles, "BUCKET_ROWS", 2000)
    pool = skewed.select((F.col("id") * 7919 % 60000).cast("double").alias("v"))
    ranking = quantiles.rank_values(pool, ["v"], bucket_rows=2000)
    p = F.when(F.col("id") % 3 == 0, F.lit(0.25)).otherwise(F.col("id") / 59999)
    asked = skewed.select("id", p.alias("p"), F.lit("v").alias("series"))
    got = quantiles.rank_lookup(asked, ranking, ["id"])
    wrong = got.filter(F.abs(F.col("value") - F.col("p") * 59999) > 1e-6)
    assert got.count() == 60000 and wrong.count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_lot" in plan


def test_hot_value_is_counted_before_it_travels(spark, skewed):
    hot = skewed.select(F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise(F.col("id") / 7).alias("v"))
    ranking = quantiles.rank_values(hot, ["v"], bucket_rows=1000)
    assert max(n for _, n, _ in ranking.totals["v"]) >= 20000
    distinct = ranking.values.groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert distinct < 4000
    plan = ranking.values.groupBy("series", "bucket", "value").count()._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan


def test_drift_groups_are_few(skewed):
    df = skewed.select(F.lit(0.5).alias("a"), F.lit(0.5).alias("b"), F.col("x").cast("double").alias("u"), F.col("p").cast("double").alias("v"))
    got = {r["bucket"]: r["members"] for r in value.bucket_drift(df, "a", "b", "u", "v").collect()}
    assert [k for k, n in got.items() if n] == [48, 49, 50, 51, 52] and got[50] == 60000
