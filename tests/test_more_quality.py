"""BASIC check results, populations on many columns, sketches, inferred files, stored buckets and calendar windows."""

from __future__ import annotations

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from membervane.operators import history, joins, populations, quality
from membervane.session import scratch_path
from membervane.sources import delimited, sinks


def test_basic_results(spark):
    rows = [(i, float(i) if i % 5 else None, "abc"[i % 3], datetime.date(2024, 1, 1 + i)) for i in range(30)] + [(3, -0.5, None, None)]
    df = spark.createDataFrame(rows, "k int, v double, s string, d date").repartition(4)
    rules = [
        {"expect": "range", "column": "v", "min": 0.0, "max": 20.0, "mostly": 0.6},
        {"expect": "in_set", "column": "s", "values": ["a"]},
        {"expect": "not_null", "column": "v", "mostly": 0.8},
        {"expect": "unique", "column": "k"},
        {"expect": "unique", "column": "d", "mostly": 1.0},
        {"expect": "type", "column": "k", "type": "int"},
        {"expect": "type", "column": "k", "type": "bigint"},
        {"expect": "range", "column": "nowhere", "min": 1},
        {"expect": "range", "column": "d", "max": "2024-01-27"},
    ]
    found = [tuple(r)[2:] for r in quality.validate_basic(df, rules, examples=4).collect()]
    pct = pytest.approx
    assert found[0] == (31, 6, pct(600 / 31), 9, pct(900 / 31), pct(36.0), ["-0.5", "21.0", "22.0", "23.0"], True)
    assert found[1] == (31, 1, pct(100 / 31), 20, pct(2000 / 31), pct(2000 / 30), ["b"] * 4, False)
    assert found[2] == (31, 0, 0.0, 6, pct(600 / 31), pct(600 / 31), [], True)
    assert found[3] == (31, 0, 0.0, 2, pct(200 / 31), pct(200 / 31), ["3", "3"], False)
    assert found[4][3:] == (0, 0.0, 0.0, [], True)
    assert [f[-1] for f in found[5:8]] == [True, False, False] and found[7][0] is None
    assert found[8][3] == 3 and found[8][6] == ["2024-01-28", "2024-01-29", "2024-01-30"]
    empty = [tuple(r)[2:] for r in quality.validate_basic(df.where("false"), rules).collect()]
    assert empty[0] == (0, 0, None, 0, None, None, [], True) and empty[3] == (0, 0, None, 0, None, None, [], True)
    assert quality.validate_basic(df, []).count() == 0
    # The plain report says the same of checks on single values.
    plain = quality.validate(df, rules[:3]).collect()
    assert [(r.violations, r.success) for r in plain] == [(f[3], f[-1]) for f in found[:3]]


def test_offending_values_are_cut_before_the_exchange(spark):
    df = spark.range(0, 50_000, 1, 8).select((F.col("id") % 40_000).alias("v"))
    report = quality.validate_basic(df, [{"expect": "range", "column": "v", "max": 5}])
    assert report.first()["partial_unexpected_list"] == [str(v) for i in range(6, 16) for v in (i, i)]
    assert "WindowGroupLimit" in report._jdf.queryExecution().executedPlan().toString()


def brute_numbers(a, b):
    missing = [sum(x is None or x != x for x in xs) for xs in (a, b)]
    a, b = (np.sort([x for x in xs if x is not None and x == x]) for xs in (a, b))
    if not len(a) or not len(b):
        return (*missing, None, None)
    grid = np.unique(np.concatenate([a, b]))
    gap = abs(np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b))
    return (*missing, (gap[:-1] * np.diff(grid)).sum(), gap.max())


@pytest.mark.parametrize("bucket_rows", [None, 20])
def test_populations(spark, bucket_rows):
    rng = np.random.default_rng(6)
    kinds = "x double, y int, z double, s string, t string"

    def rows(n, shift):
        return [(float("nan") if i % 31 == 0 else float(rng.normal(shift, 1)), int(rng.integers(0, 4 + shift)), None if shift else 1.0,
                 rng.choice(["p", "q", None]), "same") for i in range(n)]

    left, right = rows(300, 0), rows(500, 1)
    frames = [spark.createDataFrame(r, kinds).repartition(3) for r in (left, right)]
    found = {r.column: r for r in populations.compare_columns(*frames, ["x", "y", "z"], ["s", "t"], bucket_rows).collect()}
    for k, c in enumerate("xyz"):
        want = brute_numbers([r[k] for r in left], [r[k] for r in right])
        assert tuple(found[c])[2:6] == (want[0], want[1], pytest.approx(want[2]) if want[2] is not None else None, pytest.approx(want[3]) if want[3] is not None else None)
    shares = [{v: sum(r[3] == v for r in rs) / len(rs) for v in ("p", "q", None)} for rs in (left, right)]
    gaps = {v: abs(shares[0][v] - shares[1][v]) for v in shares[0]}
    assert found["s"].distance == pytest.approx(sum(gaps.values()) / 2) and found["s"].largest_gap == pytest.approx(max(gaps.values()))
    assert found["s"].at == max(gaps, key=gaps.get) and found["s"].missing_a == sum(r[3] is None for r in left)
    assert (found["t"].distance, found["t"].largest_gap, found["t"]["at"]) == (0.0, 0.0, None)
    same = populations.compare_numbers(frames[0], frames[0], ["x", "y"], bucket_rows).collect()
    assert all(r.distance == 0 and r.largest_gap == 0 and r["at"] is None for r in same)
    none = populations.compare_columns(frames[0].where("false"), frames[1], ["y"], ["s"]).collect()
    assert [(r.distance, r.largest_gap) for r in none] == [(None, None), (None, None)]


def test_sketches_merge(spark):
    df = spark.range(0, 60_000, 1, 6).select((F.col("id") % 9_000).alias("m"), (F.col("id") % 12).alias("month"))
    sketches = quality.member_sketches(df, "m", ["month"])
    row = quality.merged_members(sketches.withColumn("year", F.lit(2024)), ["year"]).first()
    assert sketches.count() == 12 and abs(row.estimate - 9_000) <= 9_000 * row.stated_error and row.stated_error == pytest.approx(0.04875)
    assert quality.merged_members(quality.member_sketches(df.where("false"), "m", ["month"]), ["month"]).count() == 0


def write_lines(spark, *lines):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.text(path)
    return path


def test_inferred_types(spark):
    good = [f"{i},{i}.5,2024-01-{1 + i % 28:02d},2024-01-01 10:00:{i % 60:02d},true,0{i},txt {i},," for i in range(200)]
    bad = ["x,1.5,2024-01-01,2024-01-01 10:00:00,true,01,t,,", "7,1.5,yesterday,2024-01-01 10:00:00,maybe,01,t,,", "1,2", "1,2,3,4,5,6,7,8,9,10", '5,"1.5",,,,02,"a, b",,9']
    path = write_lines(spark, "id,amount,day,at,flag,code,name,empty,seldom", *good, *bad)
    found = delimited.read_inferred(spark, path, text_columns=["code"])
    assert found.types == {"id": "bigint", "amount": "double", "day": "date", "at": "timestamp", "flag": "boolean", "code": "string", "name": "string", "empty": "string", "seldom": "bigint"}
    assert dict(found.rows.dtypes) == found.types and found.rows.count() == 201
    last = found.rows.where("name = 'a, b'").first()
    assert (last.id, last.amount, last.day, last.code, last.seldom) == (5, 1.5, None, "02", 9)
    assert sorted(r._reason for r in found.bad.collect()) == ["day,flag", "fields", "fields", "id"]
    assert {r._line for r in found.bad.where("_reason = 'fields'").collect()} == {"1,2", "1,2,3,4,5,6,7,8,9,10"}
    report = {r.column: (r.type, r.filled, r.failed) for r in found.report().collect()}
    assert report["id"] == ("bigint", 201, 1) and report["day"] == ("date", 200, 1) and report["empty"] == ("string", 0, 0)
    assert found.rows.select("id").distinct().count() == 200  # a read of one column sees bad rows, too
    strict = delimited.read_inferred(spark, path, most_bad=0.0)
    assert strict.types["id"] == "string" and strict.types["amount"] == "double" and strict.bad.count() == 2


def test_inferred_files_of_little(spark, tmp_path):
    only = delimited.read_inferred(spark, write_lines(spark, "a;n", "1;7", ";8"), separator=";", index_column="n")
    assert only.types == {"a": "bigint"} and [r.a for r in only.rows.orderBy("a").collect()] == [None, 1]
    none = delimited.read_inferred(spark, write_lines(spark, "a,b"))
    assert none.types == {"a": "string", "b": "string"} and none.rows.count() == none.bad.count() == 0


def test_stored_join_needs_no_exchange(spark):
    rng = random.Random(8)
    rows = [(rng.choice([7, 7, *range(30)]), 202000 + k % 12, k % 3) for k in range(600)]
    fact = spark.createDataFrame(rows, "m int, p int, x int").dropDuplicates(["m", "p"])
    side = spark.createDataFrame([(m, p, m + p) for m in range(20) for p in (202001, 202004)], "m int, p int, y int")
    for df, name in ((fact, "stored_fact"), (side, "stored_side")):
        sinks.write_bucketed(df, name, "m", 4, ["p"], scratch_path(spark, name))
    beside = joins.co_located(spark)
    joined = joins.join_side(beside.table("stored_fact"), beside.table("stored_side"), ["p", "m"])
    got = history.running_max(joined, "m", "p", {"seen": "x", "top": "y"})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    plain = history.ever_flags(joins.join_side(fact, side, ["p", "m"]), "m", "p", {"seen": "x", "top": "y"})
    assert sorted(map(str, got.select("m", "p", "seen", "top").collect())) == sorted(map(str, plain.select("m", "p", "seen", "top").collect()))
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


@pytest.mark.parametrize("kind", ["int", "date"])
def test_calendar_windows(spark, kind):
    def month(n):
        return datetime.date(n // 12, n % 12 + 1, 1) if kind == "date" else n // 12 * 100 + n % 12 + 1

    rng = random.Random(4)
    rows = [(m, rng.randrange(2021 * 12 + 8, 2023 * 12), rng.choice([None, 1, 2, 3])) for m in [None, *range(12)] for _ in range(14)]
    df = spark.createDataFrame([(m, month(n), x) for m, n, x in rows], f"m int, p {kind}, x int").repartition(3)
    got = history.rolling_max_months(df, "m", "p", {"top": "x"}, shift=2, window=4, min_periods=2)
    held = {}
    for m, n, x in rows:
        held.setdefault((m, n), []).append(x)
    best = {k: max((x for x in v if x is not None), default=None) for k, v in held.items()}
    want = {}
    for m, n in held:
        seen = [best[m, k] for k in range(n - 5, n - 1) if best.get((m, k)) is not None]
        want[m, month(n)] = max(seen) if len(seen) >= 2 else None
    assert {(r.m, r.p): r.top for r in got.collect()} == want
    dense = {(r.m, r.p): r.top for r in history.dense_months(df, "m", "p", {"top": "x"}).collect()}
    last = max(n for _, n in held)
    grid = {(m, month(k)): best.get((m, k)) or 0 for m in {m for m, _ in held} for k in range(min(n for o, n in held if o == m), last + 1)}
    assert dense == grid
    cut = history.dense_months(df, "m", "p", {"top": "x"}, fill=-1, last=month(2022 * 12))
    assert cut.agg(F.max("p")).first()[0] == month(2022 * 12) and history.dense_months(df.where("false"), "m", "p", {"top": "x"}, last=month(2022 * 12)).count() == 0
