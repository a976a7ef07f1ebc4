from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from membervane import fixed_values as fixed
from membervane.operators import quality, quantiles, scoring, segments, value
from membervane.plans import campaign as campaign_plan


def drift_by_masks(p_prev, p_cur, v_prev, v_cur):
    """Brute force: one mask per whole percentile."""
    a, b = np.rint(np.array(p_prev) * 100), np.rint(np.array(p_cur) * 100)
    out = []
    for k in range(101):
        hit = (abs(a - k) <= 2) & (abs(b - k) <= 2)
        out.append((np.array(v_cur) - np.array(v_prev))[hit].mean() if hit.any() else 0.0)
    return out


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    n = 600
    prev = np.where(rng.uniform(size=n) < 0.35, 0.0, rng.gamma(2, 500, n))
    cur = np.where(prev == 0, rng.gamma(1, 100, n), prev * rng.normal(1.1, 0.1, n))
    data = [(i, float(prev[i]), float(cur[i]), float(min(1, max(0, rng.normal(0.5, 0.4))))) for i in range(n)]
    return spark.createDataFrame(data, "m int, prev double, cur double, p double")


def test_drift_and_money(spark, scored):
    placed = quantiles.quantile_rank(scored, {"prev": "pp", "cur": "pc"})
    drift = value.bucket_drift(placed, "pp", "pc", "prev", "cur")
    pdf = placed.toPandas()
    got = drift.orderBy("bucket").toPandas()
    want = drift_by_masks(pdf.pp, pdf.pc, pdf.prev, pdf.cur)
    assert got["bucket"].tolist() == list(range(101))
    assert got["delta"].tolist() == pytest.approx(want)

    for bucket_rows in (quantiles.BUCKET_ROWS, 50):
        ranking = quantiles.rank_values(scored, ["prev"], bucket_rows=bucket_rows)
        money = value.percentile_to_value(
            scored, "m", {"y1": ("p", "prev", 1), "y3": ("p", "prev", 3)}, ranking, drift.withColumn("series", F.lit("prev"))
        ).toPandas().merge(pdf[["m", "p"]], on="m")
        base = np.quantile(pdf.prev, money.p)
        nearest = np.array([np.abs(np.arange(101) / 100 - p).argmin() for p in money.p])
        delta = np.array(want)[nearest]
        assert len(money) == 600
        assert money.y1.tolist() == pytest.approx(list(base + delta))
        assert money.y3.tolist() == pytest.approx(list(base + 3 * delta))


def test_drift_of_nobody(spark):
    df = spark.createDataFrame([(0.1, 0.9, 1.0, 2.0), (None, None, 1.0, 2.0)], "a double, b double, x double, y double")
    assert {r["delta"] for r in value.bucket_drift(df, "a", "b", "x", "y").collect()} == {0.0}


def test_annualize(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "c_mva_1to6m double, c_mva_7to12m double, c_mva_13to24m double")
    row = value.annualize(df, ["c"]).first()
    assert (row["c_cur"], row["c_prev"]) == (18.0, 36.0)


def test_scores(spark):
    df = spark.createDataFrame([(1, 0.0, 2), (2, None, 1), (3, 9.0, 0)], "m int, a double, b int")
    got = scoring.score_churn(df, {"c": (0.5, {"a": -1.0, "b": 0.25})}).orderBy("m").collect()
    assert got[0]["c"] == pytest.approx(1 / (1 + np.exp(-1.0))) and got[1]["c"] is None
    got = scoring.score_percentiles(df, {"p": (-0.5, {"a": 1.0})}).orderBy("m").collect()
    assert [r["p"] for r in got] == [0.0, None, 1.0]


def test_pipeline_model_keeps_the_key(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 3), float(i % 7 > 3)) for i in range(60)],
                               "m int, a double, b double, label double")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), LogisticRegression()])
    pipe.fit(df).save(f"{tmp_path}/model")
    model = PipelineModel.load(f"{tmp_path}/model")  # jobs score with stored models
    got = scoring.score_model(df.select("m", "a", "b"), model, "churn")
    assert got.columns == ["m", "a", "b", "churn"]
    fitted = model.stages[1]
    z = fitted.intercept
    weights = {"a": float(fitted.coefficients[0]), "b": float(fitted.coefficients[1])}
    twin = scoring.score_churn(got, {"twin": (z, weights)})
    assert twin.filter(F.abs(F.col("churn") - F.col("twin")) > 1e-9).count() == 0


GRID = segments.GridCuts((0.0, 10.0, 20.0, 30.0), (0.8, 0.9, 0.95, 1.0))


def test_grid_takes_the_higher_band_on_a_cut(spark):
    data = [(0, 0.0, 0.8), (1, 10.0, 0.85), (2, 20.0, 0.9), (3, 30.0, 1.0), (4, 15.0, 0.79), (5, None, 0.9),
            (6, 31.0, 0.9), (7, 5.0, None), (8, 9.99, 0.95)]
    df = spark.createDataFrame(data, "m int, v double, c double")
    got = {r["m"]: r["segment"] for r in segments.grid_segments(df, GRID, "v", "c").collect()}
    assert got == {0: 1, 1: 4, 2: 8, 3: 9, 4: None, 5: None, 6: None, 7: None, 8: 3}


def test_grid_stats_count_cut_rows_twice(spark):
    df = spark.createDataFrame([(1, 10.0, 0.9), (1, 10.0, 0.9), (2, 5.0, 0.85)], "m int, v double, c double")
    stats = segments.grid_stats(df, GRID, "m", "v", "c")
    got = {(r["value_band"], r["churn_band"]): (r["members"], r["mean_value"], r["sum_value"]) for r in stats.collect()}
    assert len(got) == 9
    assert got[0, 0] == (2, pytest.approx(7.5), pytest.approx(22.5))
    assert got[0, 1] == got[1, 0] == got[1, 1] == (1, pytest.approx(9.0), pytest.approx(18.0))
    assert got[2, 2] == (0, None, 0.0)
    pivot = {r["value_band"]: r for r in segments.grid_pivot(stats).collect()}
    assert pivot[0]["members_prob_baja"] == 2 and pivot[0]["text_prob_baja"] == "2 | 2.25E+01"
    assert pivot[2]["text_prob_alta"] == "0 | 0.00E+00"


def test_grid_without_values(spark):
    df = spark.createDataFrame([(1, None, 0.9), (2, None, 0.5)], "m int, v double, c double")
    cuts = segments.grid_cuts(df, df, "v", "c")
    assert cuts.value == (None,) * 4
    assert {r["segment"] for r in segments.grid_segments(df, cuts, "v", "c").collect()} == {None}
    assert segments.grid_stats(df, cuts, "m", "v", "c").agg(F.sum("members")).first()[0] == 0


def test_segments(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(0, 1, (200, 2))
    centroids = [(0.0, 0.0), (1.0, 1.0), (-1.0, 1.0), (2.0, -1.0), (-2.0, -2.0)]
    df = spark.createDataFrame([(i, float(a), float(b) * 10 + 5) for i, (a, b) in enumerate(points)] + [(999, None, 1.0)],
                               "m int, a double, b double")
    got = segments.assign_segment(df, ["a", "b"], centroids, {"b": (5.0, 10.0)}).toPandas().set_index("m")
    want = ((points[:, None, :] - np.array(centroids)[None]) ** 2).sum(-1).argmin(1) + 1
    assert got.loc[range(200), "cluster"].astype(int).tolist() == want.tolist()
    assert got.loc[0, "category"] == fixed.SEGMENT_LABELS[want[0]]
    assert np.isnan(got.loc[999, "cluster"]) and got.loc[999, "category"] is None


def test_segments_of_a_model(spark):
    df = spark.createDataFrame([(i, float(i % 5) * 10, 0.0) for i in range(50)], "m int, a double, b double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = KMeans(k=5, seed=1).fit(vectors)
    got = segments.assign_segment_model(df, ["a", "b"], model)
    assert got.columns == ["m", "a", "b", "cluster", "category"]
    assert got.groupBy("a").agg(F.count_distinct("cluster").alias("n")).filter("n <> 1").count() == 0
    twin = segments.assign_segment(df, ["a", "b"], [tuple(c) for c in model.clusterCenters()], out="twin", out_label="t")
    assert twin.join(got, "m").filter("twin <> cluster").count() == 0


def test_deliverable(spark):
    df = spark.createDataFrame([(1, 2, 50.0), (1, 1, 100.0), (2, 1, None)], "m int, i int, v double")
    got = segments.deliverable(df, "m", {"m": "id", "v": "amount"}, "v", ["i"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 90.0), (2, None)]


def test_campaign(spark):
    names = campaign_plan.CampaignNames("m", "age", "cx", "cl", "churn", "v", "ltv")
    data = [(i, 20 + i % 60, 0.0, 0.0 if i % 4 else None, i / 200, float(i * 37 % 101), 100.0 - i % 110) for i in range(200)]
    flagged = campaign_plan.eligibility(
        spark.createDataFrame(data, "m int, age int, cx double, cl double, churn double, v double, ltv double"), names
    )
    pdf = flagged.toPandas()
    want = (pdf.ltv.between(0, 1e7) & (pdf.age <= 65) & (pdf.cl == 0) & (pdf.churn >= np.quantile(pdf.churn, 0.8))).astype(int)
    assert pdf.meets_filters.tolist() == want.tolist()
    out = campaign_plan.campaign(flagged, names, {"m": "id", "v": "v"}, ["m"])
    assert out["everyone"].count() == 200 and out["segments"].count() == want.sum()
    assert out["segments"].filter("segment is null").count() == 0
    alarm = campaign_plan.score_drift(flagged, flagged.withColumn("churn", F.col("churn") + 0.1), "churn").first()
    assert alarm["distance"] == pytest.approx(0.1) and alarm["alarm"]


@pytest.mark.parametrize("bucket_rows", [quantiles.BUCKET_ROWS, 20])
def test_wasserstein(spark, bucket_rows):
    rng = np.random.default_rng(11)
    a = [0.0] * 100 + list(rng.normal(0, 1, 150))
    df = spark.createDataFrame([(float(x),) for x in a] + [(None,)], "x double")
    assert quality.wasserstein(df, df, "x", "x", bucket_rows).first()[0] == 0.0
    moved = df.select((F.col("x") + 2.5).alias("y"))
    assert quality.wasserstein(df, moved, "x", "y", bucket_rows).first()[0] == pytest.approx(2.5)
    half = spark.createDataFrame([(float(x),) for x in a[::3]], "x double")
    grid = np.sort(np.concatenate([a, a[::3]]))
    fa = np.searchsorted(np.sort(a), grid[:-1], "right") / len(a)
    fb = np.searchsorted(np.sort(a[::3]), grid[:-1], "right") / len(a[::3])
    want = (abs(fa - fb) * np.diff(grid)).sum()
    assert quality.wasserstein(df, half, "x", "x", bucket_rows).first()[0] == pytest.approx(want)


def test_fitted_segments(spark, tmp_path):
    rng = np.random.default_rng(12)
    middles = np.array([(0, 0), (50, 1), (0, 2), (50, 3), (25, 9)])
    points = middles[rng.integers(0, 5, 400)] + rng.normal(0, (2, 0.1), (400, 2))
    rows = [(i, float(a), float(b), 1.0) for i, (a, b) in enumerate(points)] + [(900, None, 1.0, 1.0), (901, 1.0, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "m int, a double, b double, same double")
    segments.fit_segments(df, ["a", "b", "same"], seed=2).save(f"{tmp_path}/segments")
    model = PipelineModel.load(f"{tmp_path}/segments")
    got = segments.assign_segment_model(df, ["a", "b", "same"], model)
    assert got.columns == ["m", "a", "b", "same", "cluster", "category"]
    centres, scale = segments.segment_centres(model, ["a", "b", "same"])
    twin = segments.assign_segment(got, ["a", "b", "same"], centres, scale, out="twin", out_label="t").toPandas().set_index("m")
    assert (twin.loc[range(400), "cluster"] == twin.loc[range(400), "twin"]).all() and twin.loc[[900, 901], "cluster"].isna().all()
    cost = ((twin.loc[range(400), ["a", "b"]] - twin.loc[range(400)].groupby("cluster")[["a", "b"]].transform("mean")) ** 2).sum().sum()
    assert twin.loc[range(400), "cluster"].nunique() == 5 and cost < 0.3 * ((points - points.mean(axis=0)) ** 2).sum()
