"""Exact quantiles, ranks and lookups against numpy, on both the short and the bucketed route."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from membervane.operators import quantiles as q


def frame(spark, values):
    return spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "k int, v double")


def reference_rank(values, n_quantiles=100):
    """Mean of interpolating from the left and from the right; ends fixed at 0 and 1."""
    x = np.array(values, dtype=float)
    n = max(2, min(n_quantiles, len(x)))
    grid = np.linspace(0, 1, n)
    knots = np.quantile(x, grid)
    out = 0.5 * (np.interp(x, knots, grid) - np.interp(-x, -knots[::-1], -grid[::-1]))
    out[x >= knots[-1]] = 1.0
    out[x <= knots[0]] = 0.0
    return out


rng = np.random.default_rng(7)
CASES = {
    "spread": list(rng.normal(0, 1000, 700)),
    "ties": [0.0] * 250 + list(rng.integers(1, 40, 500)),
    "hot top": [5.0] * 400 + list(rng.uniform(0, 5, 300)),
    "constant": [3.0] * 20,
    "few": [1.0, 2.0, 2.0, 9.0],
    "single": [4.0],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("bucket_rows", [q.BUCKET_ROWS, 50, 0])
def test_quantiles(spark, name, bucket_rows):
    values = CASES[name]
    fractions = [0.0, 0.1, 0.33, 0.5, 0.66, 0.8, 0.95, 0.999, 1.0]
    got = q.exact_quantiles(frame(spark, values), ["v"], fractions, bucket_rows)["v"]
    assert got == pytest.approx(list(np.quantile(values, fractions)), abs=1e-9)


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("bucket_rows", [q.BUCKET_ROWS, 60])
def test_rank(spark, name, bucket_rows):
    values = CASES[name]
    ranked = q.quantile_rank(frame(spark, values), {"v": "r"}, bucket_rows=bucket_rows).orderBy("k").collect()
    got = np.array([r["r"] for r in ranked])
    assert got == pytest.approx(reference_rank(values), abs=1e-9)
    assert got.min() >= 0 and got.max() <= 1
    order = np.argsort(values, kind="stable")
    assert (np.diff(got[order]) >= -1e-12).all()


def test_rank_ignores_missing(spark):
    df = frame(spark, [1.0, None, 2.0, float("nan"), 3.0]).withColumn("empty", F.lit(None).cast("double"))
    rows = q.quantile_rank(df, {"v": "r", "empty": "e"}).orderBy("k").collect()
    assert [r["r"] for r in rows] == [0.0, None, 0.5, None, 1.0]
    assert [r["e"] for r in rows] == [None] * 5


def test_quantiles_of_nothing(spark):
    assert q.exact_quantiles(frame(spark, [None, None]), ["v"], [0.5])["v"] == [None]


def test_several_columns_share_the_passes(spark):
    df = frame(spark, CASES["ties"]).withColumn("w", F.col("v") * -2)
    got = q.exact_quantiles(df, ["v", "w"], {"v": [0.2, 0.7], "w": [0.5]}, bucket_rows=100)
    assert got["v"] == pytest.approx(list(np.quantile(CASES["ties"], [0.2, 0.7])))
    assert got["w"] == pytest.approx([-2 * np.quantile(CASES["ties"], 0.5)])


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("bucket_rows", [q.BUCKET_ROWS, 40])
def test_lookup(spark, name, bucket_rows, monkeypatch):
    if bucket_rows < 100:
        # Few requests per share as well, so that hot buckets are dealt out.
        monkeypatch.setattr(q, "BUCKET_ROWS", bucket_rows)
    values = CASES[name]
    ranking = q.rank_values(frame(spark, values), ["v"], bucket_rows=bucket_rows)
    fractions = [0.0] * 150 + [1.0] * 150 + list(rng.uniform(0, 1, 200)) + [None, 0.5]
    asked = frame(spark, fractions).select("k", F.col("v").alias("p"), F.lit("v").alias("series"))
    got = {r["k"]: r["value"] for r in q.rank_lookup(asked, ranking, ["k"]).collect()}
    assert len(got) == len(fractions)
    for k, p in enumerate(fractions):
        if p is None:
            assert got[k] is None
        else:
            assert got[k] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_lookup_in_two_series(spark):
    df = frame(spark, CASES["ties"]).withColumn("w", F.col("v") + 100)
    ranking = q.rank_values(df, ["v", "w"], bucket_rows=50)
    asked = spark.createDataFrame([(1, "v", 0.4), (2, "w", 0.4), (3, "other", 0.4)], "k int, series string, p double")
    got = {r["k"]: r["value"] for r in q.rank_lookup(asked, ranking, ["k"]).collect()}
    want = np.quantile(CASES["ties"], 0.4)
    assert got[1] == pytest.approx(want) and got[2] == pytest.approx(want + 100) and got[3] is None
