"""Golden rows for scalar functions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from membervane import fixed_values as fixed
from membervane.functions import dates, flags, numeric, text


def one(spark, ddl, values, *cols):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, " + ddl)
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


def test_mixed_dates_take_the_first_format_that_fits(spark):
    texts = ["03/04/2020", "13/04/2020", "2020/04/13", "02/30/2020", "31/04/2020", "29/02/2021", "29/02/2020",
             "1/2/2020", "junk", "", None, "2020-04-13", "12/31/1999 "]
    got = one(spark, "t string", [(t,) for t in texts], dates.mixed_date_period(F.col("t")))
    assert [g[0] for g in got] == [202003, 202004, 202004, None, None, None, 202002,
                                   None, None, None, None, None, None]


def test_mixed_dates_agree_with_the_formatter(spark):
    days = spark.range(0, 1500, 1).select(F.date_add(F.lit("1999-12-15").cast("date"), F.col("id").cast("int")).alias("d"))
    for pattern in fixed.DATE_FORMATS:
        shown = days.select("d", F.date_format("d", pattern).alias("t"))
        assert shown.filter(~dates.mixed_date(F.col("t"), [pattern]).eqNullSafe(F.col("d"))).count() == 0
    long = days.select("d", F.date_format("d", "dd MMM yyyy").alias("t"))
    assert long.filter(~dates.mixed_date(F.col("t"), ["dd MMM yyyy"]).eqNullSafe(F.col("d"))).count() == 0


def test_period_dates(spark):
    got = one(spark, "p int", [(202001,), (199912,), (202013,), (202000,), (20201,), (None,)],
              dates.period_date(F.col("p")), dates.previous_month(dates.period_date(F.col("p"))),
              dates.next_month(dates.period_date(F.col("p"))))
    assert got[0] == (dt.date(2020, 1, 1), dt.date(2019, 12, 1), dt.date(2020, 2, 1))
    assert got[1] == (dt.date(1999, 12, 1), dt.date(1999, 11, 1), dt.date(2000, 1, 1))
    assert all(g == (None, None, None) for g in got[2:])
    as_text = one(spark, "p string", [("202001",), ("junk",)], dates.period_date(F.col("p")))
    assert as_text == [(dt.date(2020, 1, 1),), (None,)]


def test_period_tag_rolls_the_year(spark):
    got = one(spark, "d date", [(dt.date(2024, 1, 1),), (dt.date(2009, 12, 1),)],
              dates.period_tag(F.col("d")), dates.period_tag(dates.previous_month(F.col("d"))))
    assert got == [("ene24", "dic23"), ("dic09", "nov09")]


def test_period_argument():
    assert dates.check_period("202401") == 202401
    for bad in ("20241", "ene24", "2024011"):
        with pytest.raises(ValueError):
            dates.check_period(bad)


def test_default_period_and_names():
    assert dates.default_period(dt.date(2024, 1, 31)) == 202312
    assert dates.default_period(dt.date(2024, 3, 1)) == 202402
    assert dates.snapshot_name("ltv", 202401) == "ltv_202401_ene24"
    assert dates.snapshot_name("ges", 200912) == "ges_200912_dic09"


def test_valid_period(spark):
    got = one(spark, "t string", [("202401",), ("20241",), ("20240a",), (None,)], dates.valid_period(F.col("t")))
    assert [g[0] for g in got] == [True, False, False, False]


def test_leavers_move_back(spark):
    got = one(spark, "p date, c string", [(dt.date(2020, 1, 1), "D2"), (dt.date(2020, 1, 1), "A1"), (dt.date(2020, 1, 1), None)],
              dates.shift_leavers(F.col("p"), F.col("c")))
    assert [g[0] for g in got] == [dt.date(2019, 12, 1), dt.date(2020, 1, 1), dt.date(2020, 1, 1)]


def test_text_prefix(spark):
    got = one(spark, "t string", [("ABC 12 D",), ("12A",), ("",), (None,), ("plain",)], text.text_prefix(F.col("t")))
    assert [g[0] for g in got] == ["ABC ", "", "", None, "plain"]


def test_replacements_see_former_results(spark):
    got = one(spark, "t string", [("UC X",), ("aab",), (None,)],
              text.replace_all(F.col("t"), fixed.PREFERRED_REPLACEMENTS),
              text.replace_all(F.col("t"), [("aa", "b"), ("bb", "c")]))
    assert got == [("UNIVERSIDAD CATOLICAX", "UC X"), ("aab", "c"), (None, None)]


def test_first_tier_wins(spark):
    col = text.tier(F.col("t"), fixed.PLAN_TIERS, {"bajo": ["OUR PLAN"]})
    got = one(spark, "t string", [("SAN CARLOS-UC",), ("LIBRE ELECCION",), ("OUR PLAN",), ("other",), (None,)], col)
    assert [g[0] for g in got] == ["alto", "le", "bajo", None, None]


def test_region_of(spark):
    got = one(spark, "c int", [(13101,), (1101,), (101,), (None,)], text.region_of(F.col("c")))
    assert [g[0] for g in got] == [13, 1, None, None]


def test_count_amount_text(spark):
    got = one(spark, "n bigint, a double", [(12, 123456.0), (0, 0.0)], text.count_amount_text(F.col("n"), F.col("a")))
    assert [g[0] for g in got] == ["12 | 1.23E+05", "0 | 0.00E+00"]


def test_capped_ratio(spark):
    got = one(spark, "a double, b double", [(843.0, 10.0), (900.0, 10.0), (1.0, 0.0), (None, 1.0), (1.0, None)],
              numeric.capped_ratio(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [84.3, 84.3, None, None, None]


def test_clamps_keep_null(spark):
    got = one(spark, "x double", [(-0.5,), (0.4,), (1.5,), (None,)],
              numeric.clamp01(F.col("x")), numeric.zero_if_negative(F.col("x")))
    assert got == [(0.0, 0.0), (0.4, 0.4), (1.0, 1.5), (None, None)]


def test_buckets(spark):
    got = one(spark, "p double", [(0.005,), (0.015,), (0.0,), (1.0,), (0.5049,), (0.506,)],
              numeric.percent_bucket(F.col("p")), numeric.nearest_bucket(F.col("p")))
    assert got == [(0, 0), (2, 1), (0, 0), (100, 100), (50, 50), (51, 51)]


def test_row_mean(spark):
    got = one(spark, "a double, b double, c double", [(1.0, 2.0, 6.0), (None, 2.0, 4.0), (None, None, None)],
              numeric.row_mean([F.col("a"), F.col("b"), F.col("c")]))
    assert [g[0] for g in got] == [3.0, 3.0, None]


def test_lifetime_value(spark):
    margins, churns = [F.col("m")] * 3, [F.col("c")] * 3
    got = one(spark, "m double, c double", [(100.0, 0.0), (100.0, 1.0), (None, 0.1), (100.0, None)],
              numeric.lifetime_value(margins, churns), numeric.lifetime_value_no_churn(margins))
    full = 100 / 1.1 + 100 / 1.21 + 100 / 1.331
    assert got[0] == pytest.approx((full, full))
    assert got[1] == pytest.approx((0.0, full))
    assert got[2] == (None, None)
    assert got[3][0] is None


def test_flags(spark):
    got = one(spark, "e int, p int", [(202001, 202002), (202003, 202002), (190001, 202002), (None, 202002)],
              flags.orphan_flag(F.col("e"), F.col("p")))
    assert [g[0] for g in got] == [True, False, False, None]
    got = one(spark, "m int", [(7,), (8,)], flags.seniority_flag(F.col("m")))
    assert [g[0] for g in got] == [True, False]
    pair = [F.col("a"), F.col("b")]
    got = one(spark, "a double, b double", [(0.0, 0.0), (1.0, None), (None, 0.0), (None, None), (-1.0, 0.0)],
              flags.spend_flag(pair), flags.spend_flag(pair, null_as_spend=True))
    assert got == [(0, 0), (1, 1), (0, 1), (0, 1), (1, 1)]


def test_eligibility(spark):
    got = one(spark, "a int, x double, n double", [(65, 0.0, 0.0), (66, 0.0, 0.0), (30, 1.0, 0.0), (30, 0.0, None)],
              flags.eligible(F.col("a"), F.col("x"), F.col("n")))
    assert [g[0] for g in got] == [True, False, False, False]
    got = one(spark, "v double", [(0.0,), (1e7,), (1e7 + 1,), (None,)],
              flags.within(F.col("v"), 0, 1e7), flags.within(F.col("v"), 0, 1e7, include_low=False))
    assert got == [(True, False), (True, True), (False, False), (False, False)]
    got = one(spark, "a boolean, b boolean", [(True, True), (True, None), (False, True)],
              flags.all_flags([F.col("a"), F.col("b")]))
    assert [g[0] for g in got] == [1, 0, 0]
