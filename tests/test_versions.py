"""Versioned tables, and history that is carried from version to version."""

from __future__ import annotations

import random
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from membervane.operators import carried, history
from membervane.session import scratch_path
from membervane.sources import tables, versions


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "k int, v string")


def names_of(spark, folder):
    return {r["path"].split("/data/")[1].rsplit("/", 1)[0] for r in tables.list_files(spark, f"{folder}/data").select("path").collect()}


def test_commits(spark, df):
    folder = scratch_path(spark, "versions")
    assert versions.versions(spark, folder) == [] and versions.version_of(spark, folder) is None
    one = versions.commit(folder, {"x": df, "y": df.where("false")}, 202001)
    two = versions.commit(folder, {"x": df.limit(1)}, 202002)
    three = versions.commit(folder, {"x": df.limit(2)}, 202001)
    assert [v.number for v in versions.versions(spark, folder)] == [1, 2, 3] and one.rows == {"x": 3, "y": 0}
    assert versions.read_version(spark, folder, "x").count() == 2
    assert versions.read_version(spark, folder, "x", period=202002).count() == 1
    assert versions.read_version(spark, folder, "y", number=1).columns == ["k", "v"]
    for wrong in ({"name": "y"}, {"name": "x", "period": 202003}, {"name": "x", "number": 9}):
        with pytest.raises(ValueError):
            versions.read_version(spark, folder, **wrong)
    assert versions.vacuum(spark, folder, oldest=two.number) == []  # touched a moment ago
    time.sleep(1.1)
    gone = versions.vacuum(spark, folder, oldest=two.number, idle_seconds=0)
    assert len(gone) == 2 and [v.number for v in versions.versions(spark, folder)] == [2, 3]
    assert names_of(spark, folder) == {p.split("/data/")[1] for v in (two, three) for p in v.paths.values()}


def test_two_writers(spark, df):
    folder = scratch_path(spark, "race")
    base = versions.commit(folder, {"x": df}, 202001).number

    def write(k):
        try:
            return versions.commit(folder, {"x": df.withColumn("k", F.lit(k)), "y": df}, 202002, base)
        except versions.LostRace:
            return None

    with ThreadPoolExecutor(3) as pool:
        won = [v for v in pool.map(write, range(3)) if v]
    assert len(won) == 1 and [v.number for v in versions.versions(spark, folder)] == [1, 2]
    assert len(names_of(spark, folder)) == 3  # nothing of the losers
    failing = df.withColumn("k", F.raise_error(F.lit("bad row")).cast("int"))
    with pytest.raises(Exception, match="bad row"):
        versions.commit(folder, {"x": df, "y": failing}, 202003)
    assert len(names_of(spark, folder)) == 3 and versions.version_of(spark, folder).number == 2


def test_a_commit_without_its_end_is_not_there(spark, df):
    folder = scratch_path(spark, "half")
    versions.commit(folder, {"x": df}, 202001)
    files, path = versions._files(spark, f"{folder}/commits/0000000002.json")
    stream = files.create(path, False)
    stream.write(b'{"period": 2020')
    stream.close()
    assert versions.version_of(spark, folder).number == 1
    with pytest.raises(versions.LostRace):  # the number is taken all the same
        versions.commit(folder, {"x": df}, 202002)
    versions.vacuum(spark, folder)  # it may still be at work
    with pytest.raises(versions.LostRace):
        versions.commit(folder, {"x": df}, 202002)
    time.sleep(1.1)
    assert versions.vacuum(spark, folder, idle_seconds=0) == []
    assert versions.commit(folder, {"x": df}, 202002).number == 2 and len(versions.versions(spark, folder)) == 2


def month_rows(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice([7, 7, 7, None, *range(20)]), rng.choice([202001, 202002, 202003, 202004, 202005]), rng.choice([0, 0, 1, None]), rng.choice([0.0, 2.5, None])) for i in range(n)]


def test_months_one_by_one_equal_all_at_once(spark):
    df = spark.createDataFrame(month_rows(600, 4), "i int, m int, p int, x int, y double").repartition(3)
    columns = {"seen": "x", "top": "y"}
    want = sorted(map(str, history.ever_flags(df, "m", "p", columns).select("i", "m", "p", "seen", "top").collect()))
    folder = scratch_path(spark, "carried")
    for low, high in ((202001, 202002), (202003, 202003), (202004, 202004), (202004, 202004), (202005, 202005)):
        carried.advance(spark, folder, df.where(F.col("p").between(low, high)), "m", "p", columns)
    flags = [versions.read_version(spark, folder, "flags", p) for p in (202002, 202003, 202004, 202005)]
    got = flags[0].unionByName(flags[1]).unionByName(flags[2]).unionByName(flags[3]).select("i", "m", "p", "seen", "top")
    assert sorted(map(str, got.collect())) == want
    state = versions.read_version(spark, folder, "state")
    assert state.count() == df.select("m").distinct().count() and state.columns == ["m", "seen", "top"]
    for low, high in ((202003, 202003), (202002, 202005), (202004, 202005)):
        with pytest.raises(ValueError):
            carried.advance(spark, folder, df.where(F.col("p").between(low, high)), "m", "p", columns)
    with pytest.raises(ValueError):
        carried.advance(spark, folder, df.where("false"), "m", "p", columns)


def test_former_months_are_not_read(spark):
    """The plan of a further month scans the state and that month only."""
    folder = scratch_path(spark, "carried")
    df = spark.createDataFrame(month_rows(200, 5), "i int, m int, p int, x int, y double")
    first = carried.advance(spark, folder, df.where("p = 202001"), "m", "p", {"seen": "x"})
    path = scratch_path(spark, "month")
    df.where("p = 202002").write.parquet(path)
    after, flagged = carried.carry_forward(spark.read.parquet(first.paths["state"]), spark.read.parquet(path), "m", "p", {"seen": "x"})
    for frame in (after, flagged):
        scanned = {f.split("/")[-2] for f in frame.inputFiles()}
        assert first.paths["state"].split("/")[-1] in scanned and first.paths["flags"].split("/")[-1] not in scanned
