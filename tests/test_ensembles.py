"""Level dictionaries, and ensembles that share their inputs."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from membervane.operators import ensembles, levels
from membervane.session import scratch_path

KINDS = "k int, a double, b string, plan string, zone string, y int, z double"


def rows_of(n, plans, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        a = rng.choice([None, float("nan"), float("inf"), -1e305, *[rng.uniform(-3, 3)] * 8])
        b = rng.choice([None, "junk", *[str(rng.randrange(9))] * 6])
        plan, zone = rng.choice([None, *plans]), rng.choice(["n", "s", None])
        high = (plan == "gold") + ((a or 0) > 0.5)
        out.append((k, a, b, plan, zone, int(rng.random() < 0.2 + 0.3 * high), high + rng.random() / 9))
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    training = spark.createDataFrame(rows_of(900, ["gold", "gold", "tin", "zinc"], 1), KINDS)
    table = levels.level_table(training, ["plan", "zone"])
    targets = {"churn": ensembles.Target("y", trees=4, depth=3), "share": ensembles.Target("z", "percentile", trees=3, depth=2),
               "amount": ensembles.Target("z", "value", trees=3, depth=3)}
    return training, table, ensembles.fit_ensembles(training, table, ["a", "b"], ["plan", "zone"], targets)


def test_levels(spark, fitted):
    training, table, _ = fitted
    found = {(r.column, r.level): r.position for r in table.collect()}
    assert found["plan", "gold"] == 0 and set(found) == {("plan", p) for p in ("gold", "tin", "zinc")} | {("zone", "n"), ("zone", "s")}
    later = spark.createDataFrame([(1, "gold", "n"), (2, "lead", None), (3, None, "n"), (4, "lead", "w"), (5, "iron", "(unseen)")], "k int, plan string, zone string")
    kept = {r.k: (r.plan, r.zone) for r in levels.with_levels(later, table, ["plan", "zone"]).collect()}
    assert kept == {1: ("gold", "n"), 2: ("(unseen)", None), 3: (None, "n"), 4: ("(unseen)", "(unseen)"), 5: ("(unseen)", "(unseen)")}
    report = {r.column: tuple(r)[1:] for r in levels.level_report(later, table, ["plan", "zone"]).collect()}
    assert report == {"plan": (5, 1, 1, 3, 2, 2), "zone": (5, 1, 2, 2, 2, 1)}
    assert levels.level_table(training.where("false"), ["plan"]).count() == 0
    assert {tuple(r) for r in levels.level_report(later.where("false"), table, ["plan"]).collect()} == {("plan", 0, 0, 0, 0, 0, 3)}


def test_levels_of_a_number_and_too_many(spark, fitted, monkeypatch):
    _, table, _ = fitted
    numbers = spark.range(40).select((F.col("id") % 7).cast("int").alias("n"))
    found = levels.level_table(numbers, ["n"])
    assert sorted(r.level for r in found.collect()) == [str(i) for i in range(7)]
    assert levels.with_levels(numbers, found.where("level <> '3'"), ["n"]).where("n = '(unseen)'").count() == 6
    monkeypatch.setattr(levels, "MOST_LEVELS", 2)
    with pytest.raises(ValueError, match="plan"):
        levels.level_indexers(table, ["plan"])
    with pytest.raises(ValueError, match="absent"):
        levels.level_indexers(table, ["absent"])


def vector(row, table):
    """The inputs as the models should see them, written out by hand."""
    a = ensembles.LARGEST if row.a is None or row.a != row.a else max(-ensembles.LARGEST, min(ensembles.LARGEST, row.a))
    b = float(row.b) if row.b is not None and row.b.isdigit() else ensembles.LARGEST
    sizes = {"plan": 3, "zone": 2}
    return Vectors.dense([a, b, *[float(table.get((c, row[c]), sizes[c])) for c in ("plan", "zone")]])


def test_scores_of_a_stored_set(spark, fitted):
    _, table, models = fitted
    folder = scratch_path(spark, "set")
    models.save(folder)
    loaded = ensembles.EnsembleSet.load(spark, folder)
    later = spark.createDataFrame(rows_of(200, ["gold", "tin", "lead", "(unseen)"], 2), KINDS)
    scored = ensembles.score_ensembles(later.drop("y", "z").withColumn("share", F.lit("former")), loaded)
    assert scored.columns == ["k", "a", "b", "plan", "zone", "churn", "share", "amount"]
    known = {(r.column, r.level): r.position for r in table.collect()}
    rows = scored.collect()
    for row in rows[:60]:
        x = vector(row, known)
        assert row.churn == pytest.approx(models.models["churn"][1].stages[0].predictProbability(x)[1])
        assert row.amount == pytest.approx(models.models["amount"][1].stages[0].predict(x))
        assert row.share == pytest.approx(min(1.0, max(0.0, models.models["share"][1].stages[0].predict(x))))
    assert len(rows) == 200 and len({round(r.churn, 6) for r in rows}) > 3 and {r.share for r in rows} <= {r.share for r in rows if 0 <= r.share <= 1}
    # An unseen plan and a missing one are one category.
    one = later.limit(1).withColumns({"a": F.lit(0.1), "b": F.lit("1"), "zone": F.lit("n")})
    pair = one.withColumn("plan", F.lit("lead")).unionByName(one.withColumn("plan", F.lit(None).cast("string")))
    assert ensembles.score_ensembles(pair, loaded).select("churn", "share", "amount").distinct().count() == 1
    assert ensembles.score_ensembles(later.where("false"), loaded).count() == 0
    with pytest.raises(ValueError, match="zone"):
        ensembles.score_ensembles(later.drop("zone"), loaded)


def test_one_pass(spark, fitted, tmp_path):
    _, _, models = fitted
    path = scratch_path(spark, "members")
    spark.createDataFrame(rows_of(50, ["gold"], 3), KINDS).write.parquet(path)
    scored = ensembles.score_ensembles(spark.read.parquet(path).drop("y"), models, ["churn"])
    assert scored.columns[-1] == "churn" and "amount" not in scored.columns
    plan = scored.select("k", "churn")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "ReadSchema: struct<k:int,a:double,b:string,plan:string,zone:string>" in plan


def test_unknown_kind_and_missing_labels(spark, fitted):
    training, table, _ = fitted
    with pytest.raises(ValueError, match="rank"):
        ensembles.fit_ensembles(training, table, ["a"], [], {"x": ensembles.Target("y", "rank")})
    holes = training.withColumn("z", F.when(F.col("k") % 3 == 0, F.col("z")))
    found = ensembles.fit_ensembles(holes, table, ["a"], [], {"x": ensembles.Target("z", "value", trees=1, depth=1)})
    assert ensembles.score_ensembles(training, found).where("x is null").count() == 0
