from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from membervane.operators import history, joins, rows
from membervane.functions.text import region_of


@pytest.fixture(scope="module")
def months(spark):
    """Member 1 owns a third of the rows, some of them copies; member and value may be missing."""
    data = [(1 if i % 3 == 0 else i % 40, 202000 + i * 7 % 11 + 1, (i * 13 % 5) if i % 6 else None, i) for i in range(900)]
    data += [(None, 202001, 4, 900), (None, 202003, 1, 901)]
    return spark.createDataFrame(data, "m int, p int, x int, i int")


def test_filters(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 0.0), (3, None), (4, 5.0)], "k int, v double")
    assert [r["k"] for r in rows.nonnegative(df, "v").orderBy("k").collect()] == [2, 4]
    assert rows.drop_unparsed(df, "v").columns == ["k"] and rows.drop_unparsed(df, "v").count() == 3
    assert [r["k"] for r in rows.top_quantile(df, "v", 0.5).orderBy("k").collect()] == [2, 4]
    assert df.filter(rows.in_list(F.col("k"), [1, 9])).count() == 1


def test_dedup(months):
    pdf = months.toPandas()
    first = rows.dedup_first(months, ["m"], ["p", "i"]).toPandas()
    want = pdf.sort_values(["p", "i"]).drop_duplicates("m")
    assert sorted(first["i"]) == sorted(want["i"])
    again = rows.dedup_first(rows.dedup_first(months, ["m"], ["p", "i"]), ["m"], ["p", "i"]).toPandas()
    assert sorted(again["i"]) == sorted(first["i"])
    last = rows.dedup_last(months, ["m", "p"], ["x", "i"]).toPandas()
    want = pdf.sort_values(["x", "i"], na_position="first").drop_duplicates(["m", "p"], keep="last")
    assert sorted(last["i"]) == sorted(want["i"])


def test_dedup_cuts_groups_before_the_exchange(months):
    plan = rows.dedup_first(months, ["m"], ["i"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_latest_row_and_preview(months):
    got = rows.latest_row(months, "m", "p", 202003, ["i"])
    assert got.select("p").distinct().collect() == [(202003,)]
    assert got.count() == got.select("m").distinct().count()
    assert [r["i"] for r in rows.preview(months, ["i"], 3).collect()] == [0, 1, 2]
    assert [r["i"] for r in rows.order_rows(months.filter("i < 3"), ["i"]).collect()] == [0, 1, 2]


def test_append_history(spark):
    old = spark.createDataFrame([(1, 2)], "a int, b int")
    new = spark.createDataFrame([("x", 3)], "c string, a int")
    got = rows.append_history(old, new)
    assert got.columns == ["a", "b", "c"]
    assert sorted(map(tuple, got.collect())) == [(1, 2, None), (3, None, "x")]


@pytest.mark.parametrize("order,unique", [([], False), (["p"], False), (["p", "i"], True)])
def test_index(months, order, unique):
    pdf = rows.with_index(months.repartition(5), order, unique_order=unique).toPandas()
    assert list(pdf.columns) == ["index", "m", "p", "x", "i"]
    assert sorted(pdf["index"]) == list(range(902))
    assert sorted(pdf["i"]) == list(range(902))
    if order:
        assert pdf.sort_values("index").sort_values(order, kind="stable")["index"].is_monotonic_increasing


def test_index_in_arrival_order(spark):
    df = spark.range(0, 100, 1, 3).select(F.col("id").alias("v"))
    assert all(r["index"] == r["v"] for r in rows.with_index(df).collect())


def ever(pdf, column, last=None):
    """Brute force: largest value up to the row's period, zero where there is none."""
    periods = sorted(pdf["p"].unique())
    number = {p: n for n, p in enumerate(periods)}
    out = {}
    for r in pdf.itertuples():
        same = pdf[(pdf["m"] == r.m) | (pdf["m"].isna() & pd.isna(r.m))]
        seen = same[(same["p"] <= r.p) & (same["p"].map(number) > number[r.p] - (last or 10**6))]
        out[r.i] = max(0, seen[column].fillna(0).max())
    return out


@pytest.mark.parametrize("last", [None, 3])
def test_ever_flags(months, last):
    pdf = months.toPandas()
    got = {r["i"]: r["seen"] for r in history.ever_flags(months, "m", "p", {"seen": "x"}, last).collect()}
    assert got == ever(pdf, "x", last)


def test_ever_flags_split_a_hot_member_by_period(months):
    plan = history.ever_flags(months, "m", "p", {"seen": "x"})._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "Aggregate [m" in window, "rows must be reduced to months before the window"


@pytest.mark.parametrize("shift", [0, 2])
def test_rolling_max(months, shift):
    got = history.rolling_max(months, "m", "p", {"r": "x"}, shift, window=4, min_periods=2).toPandas()
    base = months.toPandas().groupby(["m", "p"], dropna=False)["x"].max().reset_index().sort_values(["m", "p"])
    rolled = base.groupby("m", dropna=False)["x"].transform(
        lambda s: s.shift(shift).rolling(4, min_periods=2).max()
    )
    base["r"] = rolled
    merged = got.merge(base, on=["m", "p"], suffixes=("", "_want"))
    assert len(merged) == len(base) == len(got)
    assert merged["r"].fillna(-1).tolist() == merged["r_want"].fillna(-1).tolist()


def test_window_averages(spark):
    panel = spark.createDataFrame(
        [(1, dt.date(2020, 12, 15), 6.0), (1, dt.date(2020, 7, 1), 6.0), (1, dt.date(2020, 6, 1), 12.0),
         (1, dt.date(2019, 1, 1), 24.0), (1, dt.date(2018, 12, 1), 999.0), (1, dt.date(2021, 1, 1), 999.0),
         (2, dt.date(2018, 1, 1), 5.0)],
        "m int, d date, v double",
    )
    got = history.window_averages(panel, "m", "d", F.lit("2021-01-01").cast("date"), ["v"]).collect()
    assert [tuple(r) for r in got] == [(1, 2.0, 2.0, 2.0)]


def test_window_averages_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "panel")
    spark.sql("select 1 as m, date'2020-01-01' as d, 2.0D as v, 'unused' as w").write.parquet(path)
    df = history.window_averages(spark.read.parquet(path), "m", "d", F.lit("2021-01-01").cast("date"), ["v"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2019-01-01)" in plan and "LessThanOrEqual(d,2020-12-31)" in plan
    assert "unused" not in plan and "w:string" not in plan


def test_joins(spark):
    fact = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, None)], "m int, p int, c string")
    side = spark.createDataFrame([(1, 10, "s"), (2, 99, "t")], "m int, p int, s string")
    got = joins.join_side(fact, side, ["p", "m"]).orderBy("m").collect()
    assert [r["s"] for r in got] == ["s", None, None]
    table = spark.createDataFrame([("a", 1, 0)], "code string, tier int, other int")
    got = joins.lookup(fact, table, "c", "code", ["tier"])
    assert got.columns == ["m", "p", "c", "code", "tier"] and got.count() == 3
    with pytest.raises(ValueError):
        joins.lookup(fact, table, "c", "code", ["absent"])
    kept = joins.keep_members(fact, spark.createDataFrame([(1,), (1,), (9,)], "m int"), "m")
    assert [r["m"] for r in kept.collect()] == [1]
    scored = spark.createDataFrame([(1, 0.5), (2, 0.6)], "m int, score double")
    values = spark.createDataFrame([(1, 0.9, 100.0)], "m int, Score double, ltv double")
    got = joins.attach_values(scored, values, "m").orderBy("m").collect()
    assert [tuple(r) for r in got] == [(1, 0.5, 100.0), (2, 0.6, None)]


def test_geography(spark):
    socio = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 3.0)], "comuna string, avg_income double")
    codes = spark.createDataFrame([("A", 13101), ("B", 1101)], "con_comuna_gls string, cod_comuna int")
    regions = spark.createDataFrame([("13", "z", "sur"), ("13", "m", "centro"), (None, "x", "y")],
                                    "cod_region string, gls_web_region string, norte_centro_sur string")
    geo = joins.with_region(joins.communes(socio, codes), regions)
    assert geo.count() == 2
    fact = spark.createDataFrame([(1, 13101), (2, 1101), (3, 999)], "m int, comuna_cod int")
    got = {r["m"]: (r["comuna"], r["gls_web_region"]) for r in joins.with_geo(fact, geo).collect()}
    assert got == {1: ("A", "m"), 2: ("B", None), 3: (None, None)}
    assert region_of(F.lit(13101)) is not None
