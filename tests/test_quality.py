from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from membervane.operators import quality
from membervane.session import scratch_path
from membervane.sources import sinks, tables


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, 1.0, "a"), (2, 2.0, "b"), (2, None, "b"), (3, 9.0, None)], "k int, v double, s string"
    )


def test_reports(df):
    assert quality.distinct_members(df, "k").first()[0] == 3
    assert quality.distinct_members(df, "k", approximate=True).first()[0] == 3
    assert tuple(quality.uniqueness_check(df, "k").first()) == (4, 3, False)
    stats = quality.score_stats(df, "v").first()
    assert (stats["mean"], stats["min"], stats["max"]) == (4.0, 1.0, 9.0)
    profile = {r["column"]: r for r in quality.profile(df, ["k", "v"]).collect()}
    assert (profile["v"]["count"], profile["v"]["p25"], profile["v"]["p50"], profile["v"]["p75"]) == (3, 1.5, 2.0, 5.5)
    assert profile["k"]["p50"] == 2.0
    assert {tuple(r) for r in quality.null_report(df).collect()} == {("v", 1), ("s", 1)}
    assert {r[0] for r in quality.distinct_values(df, "s").collect()} == {"a", "b", None}
    assert tuple(quality.category_counts(df, "k", "s").first()) == (3, 2)
    assert quality.shape(df) == (4, 3)
    flagged = df.withColumn("f", F.col("v") > 1).withColumn("g", F.lit(1))
    assert tuple(quality.flag_counts(flagged, ["f", "g"]).first()) == (4, 5, 2, 4)


def test_validate(df):
    rules = [
        {"expect": "not_null", "column": "v"},
        {"expect": "range", "column": "v", "min": 1.0, "max": 5.0},
        {"expect": "range", "column": "v", "max": 9.0},
        {"expect": "in_set", "column": "s", "values": ["a"]},
        {"expect": "type", "column": "k", "type": "int"},
        {"expect": "type", "column": "k", "type": "bigint"},
        {"expect": "unique", "column": "k"},
        {"expect": "unique", "column": "s"},
    ]
    got = [tuple(r) for r in quality.validate(df, rules).collect()]
    assert sorted(got) == sorted([
        ("not_null", "v", 1, False), ("range", "v", 1, False), ("range", "v", 0, True), ("in_set", "s", 2, False),
        ("type", "k", 0, True), ("type", "k", 1, False), ("unique", "k", 1, False), ("unique", "s", 1, False),
    ])
    assert quality.validate(df, rules, failures_only=True).count() == 6
    assert quality.validate(df.limit(0), rules[:2] + rules[6:]).filter("not success").count() == 0
    with pytest.raises(ValueError):
        quality.validate(df, [{"expect": "nonsense", "column": "k"}])


def test_suite_format(df):
    suite = {"expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "v"}},
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "v", "min_value": 2}},
        {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "s", "value_set": ["a", "b"]}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "k"}},
        {"expectation_type": "expect_column_values_to_be_of_type", "kwargs": {"column": "k", "type_": "int"}},
    ]}
    got = {(r["expectation"], r["violations"]) for r in quality.validate(df, quality.expectations_of(suite)).collect()}
    assert got == {("not_null", 1), ("range", 1), ("in_set", 0), ("unique", 1), ("type", 0)}
    with pytest.raises(ValueError):
        quality.expectations_of({"expectations": [{"expectation_type": "other", "kwargs": {}}]})


def test_comparisons(spark, df):
    other = spark.createDataFrame([("b",), ("c",), (None,), (None,)], "t string")
    got = {r["category"]: (r["share_a"], r["share_b"]) for r in quality.compare_categorical(df, other, "s", "t").collect()}
    assert got == {"a": (0.25, 0.0), "b": (0.5, 0.25), "c": (0.0, 0.25), None: (0.25, 0.5)}
    rows = quality.compare_numeric(df, df.withColumn("w", F.col("v") * 2), "v", "w", [0.0, 0.5, 1.0]).collect()
    assert [tuple(r) for r in rows] == [(0.0, 1.0, 2.0), (0.5, 2.0, 4.0), (1.0, 9.0, 18.0)]


def test_scan_period(spark):
    df = spark.createDataFrame([(202001, "A"), (202002, "B")], "PERIODO int, X string")
    assert [tuple(r) for r in tables.scan_period(df, 202001).collect()] == [(202001, "A")]
    assert tables.scan_period(df, 202001).columns == ["periodo", "x"]
    assert tables.scan_period(df, 202001, 202012).count() == 2
    with pytest.raises(ValueError, match="no rows"):
        tables.scan_period(df, 201901)
    assert tables.scan_period(df, 201901, require_rows=False).count() == 0
    with pytest.raises(ValueError, match="no column"):
        tables.scan_period(df.drop("PERIODO"), 202001)


def test_scan_period_prunes_partitions(spark):
    path = scratch_path(spark, "months")
    df = spark.createDataFrame([(p, i) for p in (202001, 202002) for i in range(5)], "periodo int, v int")
    sinks.truncate_append(df, path, "periodo")
    scan = tables.scan_period(tables.read_table(spark, path), 202002)
    assert scan.count() == 5
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(periodo" in plan


def test_csv(spark, df):
    for compression in (None, "gzip"):
        path = scratch_path(spark, "csv") + (".csv.gz" if compression else ".csv")
        for _ in range(2):  # the second run replaces the file of the first
            sinks.export_csv(df.repartition(3), path, compression, single_file=True)
        files = tables.list_files(spark, path).collect()
        assert len(files) == 1 and files[0]["path"].removeprefix("file:").lstrip("/") == path.lstrip("/")
        assert sorted(map(str, tables.read_csv(spark, path, df.schema).collect())) == sorted(map(str, df.collect()))
    path = scratch_path(spark, "csv")
    sinks.export_csv(df.repartition(3), path)
    assert tables.list_files(spark, path).filter(F.col("name").startswith("part-")).count() > 1
    without = tables.read_csv(spark, path, df.schema, index_column="k")
    assert without.columns == ["v", "s"]


def test_snapshots(spark, df):
    folder = scratch_path(spark, "folder")
    for name in ("24.01.01_ltv_ene24", "24.02.01_LTV_ene24_b", "24.03.01_ltv_feb24", "24.03.01_ltv_out_ene24", "other_ene24"):
        sinks.export_csv(df.repartition(3), f"{folder}/{name}", single_file=name.startswith("other"))
        time.sleep(1.1)
    named = tables.list_snapshots(tables.list_files(spark, folder))
    pick = lambda *a, **k: tables.latest_snapshot(named, *a, **k).first()
    assert named.count() == 5
    assert pick("ene24", "ltv")["name"] == "24.03.01_ltv_out_ene24"
    assert pick("ene24", "ltv", exclude="out")["name"] == "24.02.01_LTV_ene24_b"
    assert pick("mar24", "ltv", exclude="out")["name"] == "24.03.01_ltv_feb24"
    assert pick("ene24", "none") is None
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, folder, "ene24", "none", df.schema)
    want = sorted(map(str, df.collect()))
    for token in ("ltv", "other"):
        assert sorted(map(str, tables.read_snapshot(spark, folder, "ene24", token, df.schema).collect())) == want
    path = tables.find_snapshot(spark, [folder], "feb24", "ltv")
    assert path.endswith("24.03.01_ltv_feb24")
    assert tables.read_snapshot(spark, "", "", "", df.schema, path=path).count() == df.count()


def test_tables(spark, df):
    sinks.replace_table(df, "published", scratch_path(spark, "t"), upper=True)
    assert tables.read_table(spark, "published").columns == ["K", "V", "S"]
    sinks.replace_table(df.select("k"), "published", scratch_path(spark, "t"))
    assert tables.read_table(spark, "published").columns == ["k"]
    path = scratch_path(spark, "t")
    sinks.truncate_append(df.withColumn("period", F.col("k") % 2), path, "period")
    sinks.truncate_append(df.filter("k = 2").withColumn("period", F.lit(0)).limit(1), path, "period")
    got = spark.read.parquet(path).groupBy("period").count().collect()
    assert {tuple(r) for r in got} == {(0, 1), (1, 2)}
    sinks.truncate_append(df.limit(1), path)
    assert spark.read.parquet(path).count() == 1


def test_publish(spark, df):
    folder = scratch_path(spark, "published")
    for period in (202001, 202002):
        manifest = sinks.publish({"one": df, "two": df.limit(2)}, folder, period)
        assert {tuple(r)[:3] for r in manifest.collect()} == {("one", period, 4), ("two", period, 2)}
    assert spark.read.parquet(f"{folder}/manifest").count() == 4
    sinks.publish({"one": df.limit(1), "two": df.filter("false")}, folder, 202002)
    found = {(t, p): sinks.read_published(spark, folder, t, p).count() for t in ("one", "two") for p in (202001, 202002)}
    assert found == {("one", 202001): 4, ("two", 202001): 2, ("one", 202002): 1, ("two", 202002): 0}
    assert sinks.publish({"one": df.filter("false")}, folder, 202003).first()["row_count"] == 0
    with pytest.raises(ValueError):
        sinks.read_published(spark, folder, "two", 202003)


def test_suite_options(spark, df):
    between = "expect_column_values_to_be_between"
    suite = {"expectations": [{"expectation_type": between, "kwargs": {"column": "k", "min_value": 1, "strict_min": True, "mostly": m}} for m in (0.7, 0.8)]}
    report = quality.validate(df, quality.expectations_of(suite)).collect()
    assert [(r.violations, r.success) for r in report] == [(1, True), (1, False)]
    assert quality.validate(df, []).count() == 0
    assert quality.validate(df, [{"expect": "unique", "column": "absent"}]).collect()[0][2:] == (None, False)
    with pytest.raises(ValueError):
        quality.expectations_of({"expectations": [{"expectation_type": between, "kwargs": {"column": "k", "parse_strings_as_datetimes": True}}]})


def test_result(spark, df):
    path = scratch_path(spark, "result")
    sinks.write_result(quality.validate(df, [{"expect": "not_null", "column": "v"}]), path)
    assert spark.read.json(path).first()["violations"] == 1
