"""Whole jobs on hand-made rows."""

from __future__ import annotations

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from membervane import fixed_values as fixed
from membervane.operators.segments import assign_segment
from membervane.plans import campaign, lifetime, preparation


@pytest.fixture(scope="module")
def lookups(spark):
    return preparation.Lookups(
        category=spark.createDataFrame([("P1", "SAN CARLOS-UC", 1), ("P2", "UC SJ - BICENTENARIO - VESPUCIO", 2)],
                                       "COD_CATEGORIA string, PREFERENTE string, other int"),
        regions=spark.createDataFrame([(13, "RM", "centro"), (13, "RM", "centro"), (1, "T", "norte")],
                                      "COD_REGION int, GLS_WEB_REGION string, norte_centro_sur string"),
        commune_codes=spark.createDataFrame([("Santiago", 13101)], "con_comuna_gls string, cod_comuna int"),
        commune_socio=spark.createDataFrame([("Santiago", 500.0, 10.0)], "COMUNA string, avg_income double, pobreza_multi_ptje double"),
    )


def test_preparation(spark, lookups):
    columns = ("ID_TITULAR bigint, PERIODO int, tipo_transac string, renta_imponible double, antiguedad int, cie_complejo double, "
               "gasto_licencias double, gasto_licencias_excl double, categoria_cod string, comuna_cod int, categoria_gls string, anno int, serie string")
    fact = spark.createDataFrame([
        (1, 202001, "A", 10.0, 7, None, None, None, "P1", 13101, "X1", 2020, "s  "),
        (1, 202002, "A", 10.0, 8, 1.0, 0.0, 0.0, "P2", 13101, "X1", 2020, "s"),
        # A leaver: shares period 202002 after the shift, and must see what the other row has.
        (1, 202003, "D2", 10.0, 9, 0.0, 5.0, None, None, 1, "X1", 2020, None),
        (1, 202004, "A", 10.0, 10, 0.0, 0.0, 0.0, "P9", None, "X1", 2020, "s"),
        (2, 202001, "A", -1.0, 1, 1.0, 1.0, 1.0, "P1", 13101, "X1", 2020, "s"),
        (3, 202001, "A", None, 1, 1.0, 1.0, 1.0, "P1", 13101, "X1", 2020, "s"),
        (4, 202001, "A", 0.0, 1, 0.0, 0.0, 0.0, "P1", 13101, "X1", 2020, "s"),
    ], columns)
    side = spark.createDataFrame([
        ("1", "202001", "12/31/2019", "0"), ("1", "202002", "01/01/1900", "x"), ("1", "202003", "31/12/2030", "2"),
        ("1", "202004", "junk", "3"),
    ], "id_titular string, periodo string, FLD_TERMINO string, n_ges_mva_2m string")
    prepared = preparation.prepare(fact, side, lookups)
    got = {(r["id_titular"], r["antiguedad"]): r for r in prepared.collect()}
    assert set(got) == {(1, 7), (1, 8), (1, 9), (1, 10), (4, 1)}
    assert [got[1, a]["periodo"] for a in (7, 8, 9, 10)] == [dt.date(2020, m, 1) for m in (1, 2, 2, 4)]
    assert [got[1, a]["huerfano"] for a in (7, 8, 9, 10)] == [True, False, False, None]
    assert [got[1, a]["n_ges_mva_2m"] for a in (7, 8, 9, 10)] == [0.0, None, 2.0, None]
    assert [got[1, a]["cat_linea_plan"] for a in (7, 8, 9, 10)] == ["alto", "bajo", None, None]
    assert got[1, 8]["preferente"] == "UNIVERSIDAD CATOLICASJ - BICENTENARIO - VESPUCIO"
    assert [got[1, a]["comuna"] for a in (7, 9, 10)] == ["Santiago", None, None]
    assert got[1, 7]["norte_centro_sur"] == "centro" and got[1, 7]["serie"] == "s"
    assert [got[1, a]["ant_m12_y_ges"] for a in (7, 8)] == [True, False]
    assert [got[1, a]["hubo_cie_complejo"] for a in (7, 8, 9, 10)] == [0, 1, 1, 1]
    assert [got[1, a]["hay_gasto_licencia"] for a in (7, 8, 9, 10)] == [0, 0, 1, 0]
    assert [got[1, a]["hubo_licencia"] for a in (7, 8, 9, 10)] == [0, 1, 1, 1]
    for gone in ("anno", "cod_categoria", "comuna_cod", "cod_region", "gls_web_region", "categoria_gls"):
        assert gone not in prepared.columns
    assert "categor__a_gls" in prepared.columns and dict(prepared.dtypes)["fuga_5m"] == "double"
    indexed = preparation.prepared_table(prepared, ["id_titular", "periodo"])
    assert indexed.columns[0] == "index" and sorted(r["index"] for r in indexed.collect()) == list(range(5))


def test_preparation_wants_its_columns(spark, lookups):
    fact = spark.createDataFrame([(1,)], "id_titular int")
    with pytest.raises(ValueError, match="periodo"):
        preparation.prepare(fact, fact, lookups)
    with pytest.raises(ValueError, match="fld_termino"):
        preparation.shape_side(spark.createDataFrame([(1, 2)], "id_titular int, periodo int"))


def test_value_inputs(spark):
    df = spark.createDataFrame([("AB 12", "L9", "7", "c", 1.0, 2)],
                               "categoria_gls string, linea_plan string, x string, y_cod string, m_sum_future_1y double, id int")
    got = lifetime.shape_inputs(df, numeric=["x"], categorical=["id"])
    assert got.columns == ["x", "id", "categ_simplificada", "linea_plan_simplificada"]
    assert got.first().asDict() == {"x": 7.0, "id": "2", "categ_simplificada": "AB ", "linea_plan_simplificada": "L"}


def test_value_inputs_with_defaults(spark):
    df = spark.createDataFrame([("1", "2.5", "x", 3, 4)], "RUT string, Costos_mva_1to6m string, serie string, vigente int, benef_adic int")
    got = lifetime.shape_inputs(df)
    assert got.first().asDict() == {"costos_mva_1to6m": 2.5, "serie": "x", "vigente": "3", "costo_benef_adic": 4}


def test_campaign_inputs(spark):
    df = spark.createDataFrame([(1, 2, 900.0, 10.0, "7", 1), (1, 1, 100.0, 10.0, "x", 2), (2, 1, None, 0.0, None, None)],
                               "ID_TITULAR int, i int, renta_imponible double, valor_uf double, edad string, sexo int")
    shaped = campaign.shape_inputs(df, campaign.CampaignNames(), ["i"]).orderBy("id_titular")
    got = [(r["id_titular"], r["renta_imponible_uf"], r["edad"], r["sexo"]) for r in shaped.collect()]
    assert got == [(1, 10.0, None, "2"), (2, None, None, None)]
    report = {r["column"]: (r["present"], r["filled"]) for r in campaign.input_report(shaped).collect()}
    assert len(report) == 44 and report["sexo"] == (True, 1) and report["comuna"] == (False, 0)


def test_deliverables_with_default_columns(spark):
    names = ", ".join(f"{c} {'int' if c == 'id_titular' else 'double'}" for c in fixed.CAMPAIGN_COLUMNS)
    width = len(fixed.CAMPAIGN_COLUMNS)
    rows = [(i, *[float(i + 1)] * (width - 1), int(i % 2)) for i in range(20)]
    flagged = spark.createDataFrame(rows, names + ", meets_filters int")
    out = campaign.campaign(flagged, campaign.CampaignNames())
    assert len(out["segments"].columns) == len(out["everyone"].columns) == 16
    assert out["segments"].columns[-1] == "segment" and out["everyone"].columns[-1] == "meets_filters"
    row = out["everyone"].filter("id_titular = 9").first()
    assert row["ltv_predicted_1y"] == pytest.approx(9.0) and row["prob_fuga_1y"] == 10.0


MODELS = lifetime.ValueModels(
    income=[(0.1, {"f": 1.0})] * 3,
    cost=[(-0.1, {"f": 1.0})] * 3,
    churn=[(-1.0, {"f": 1.0}), (-1.0, {"f": 0.5}), (-1.0, {})],
    centroids=[(0.0,) * 5, (1.0,) * 5, (2.0,) * 5, (3.0,) * 5, (4.0,) * 5],
    scale={c: (0.0, 1000.0) for c in lifetime.SEGMENT_FEATURES},
)


@pytest.fixture(scope="module")
def averages(spark):
    rng = np.random.default_rng(2)
    names = [f"{m}_mva_{s}" for m in ("income", "cost") for s in ("1to6m", "7to12m", "13to24m")]
    data = [(i, float(rng.uniform(0, 1)), *[float(x) for x in rng.gamma(2, 100, 6)]) for i in range(300)]
    # A second row of member 0 counts in the distributions, but only the first is valued.
    data.append((0, 0.99, *[5000.0] * 6))
    return spark.createDataFrame(data, "m int, f double, " + ", ".join(f"{n} double" for n in names))


def test_values_against_numpy(spark, averages):
    got = lifetime.value_members(averages, "m", MODELS, ["m", "f"]).toPandas().sort_values("m").reset_index()
    pdf = averages.toPandas()
    first = pdf.sort_values(["m", "f"]).drop_duplicates("m").sort_values("m").reset_index()
    assert len(got) == 300

    def rank(x):
        grid = np.linspace(0, 1, 100)
        k = np.quantile(x, grid)
        return 0.5 * (np.interp(x, k, grid) - np.interp(-x, -k[::-1], -grid[::-1]))

    def money(measure, p, years):
        prev = pdf[f"{measure}_mva_13to24m"].to_numpy() * 12
        cur = pdf[f"{measure}_mva_1to6m"].to_numpy() * 6 + pdf[f"{measure}_mva_7to12m"].to_numpy() * 6
        a, b = np.rint(rank(prev) * 100), np.rint(rank(cur) * 100)
        delta = np.array([(cur - prev)[(abs(a - k) <= 2) & (abs(b - k) <= 2)].mean()
                          if ((abs(a - k) <= 2) & (abs(b - k) <= 2)).any() else 0.0 for k in range(101)])
        nearest = [np.abs(np.arange(101) / 100 - x).argmin() for x in p]
        return np.quantile(prev, p) + years * delta[nearest]

    ltv = np.zeros(300)
    for y in (1, 2, 3):
        income = money("income", np.clip(0.1 + first.f, 0, 1), y)
        cost = money("cost", np.clip(-0.1 + first.f, 0, 1), y)
        assert got[f"predicted_income_{y}"].tolist() == pytest.approx(income.tolist())
        assert got[f"predicted_margin_{y}"].tolist() == pytest.approx((income - cost).tolist())
        ltv += (income - cost) / 1.1**y * (1 - got[f"churn_{y}"])
    assert got["ltv_predicted"].tolist() == pytest.approx(ltv.tolist())
    assert got["ltv_predicted_perc"].tolist() == pytest.approx(rank(got["ltv_predicted"].to_numpy()).tolist())
    assert set(got["cluster"]) <= {1, 2, 3, 4, 5} and got["category"].notna().all()


def test_no_churn_means_equal_values(spark, averages):
    models = lifetime.ValueModels(MODELS.income, MODELS.cost, [(-1000.0, {})] * 3, MODELS.centroids)
    got = lifetime.member_values(lifetime.score_members(averages, models), "m", ["m", "f"])
    assert got.filter(F.abs(F.col("ltv_predicted") - F.col("ltv_no_churn_predicted")) > 1e-9).count() == 0


def test_segment_features_use_what_is_there(spark):
    cols = [f"predicted_{m}_{y}" for m in ("income", "cost") for y in (1, 2, 3)] + [f"churn_{y}" for y in (1, 2, 3)]
    df = spark.createDataFrame([(None, 2.0, 4.0, 1.0, 1.0, 1.0, 0.1, 0.2, None)], ", ".join(f"{c} double" for c in cols))
    row = lifetime.segment_features(df).first()
    assert (row["mean_income"], row["mean_cost"]) == (3.0, 1.0) and row["mean_churn"] == pytest.approx(0.15)
    assert assign_segment(df, ["churn_3"], [(0.0,)]).first()["cluster"] is None


def test_campaign_table_has_one_row_per_member(spark):
    scored = spark.createDataFrame([(1, 2, 0.5), (1, 1, 0.4), (2, 1, 0.3)], "id_titular int, i int, prob_fuga double")
    values = spark.createDataFrame([(1, 7.0), (1, 7.0)], "id_titular int, ltv double")
    got = campaign.campaign_table(scored, values, campaign.CampaignNames(), ["i"]).orderBy("id_titular").collect()
    assert [tuple(r) for r in got] == [(1, 1, 0.4, 7.0), (2, 1, 0.3, None)]


def test_preparation_stays_in_generated_code(spark):
    """No stage of the preparation query is too large to compile."""
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("sample tables are not there")
    before = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        from membervane.catalog.queries import all_queries

        assert all_queries()["prepare_members"](spark, "/root/testdata/sf0.001").count()
    finally:
        spark.conf.set("spark.sql.codegen.fallback", before)
        spark.conf.unset("spark.sql.codegen.factoryMode")


def test_region_columns_in_other_spellings(spark):
    rows = spark.createDataFrame([(13, "RM", "centro")], "COD_REGION int, gls_web_region string, `Unnamed: 3` string")
    assert preparation.shape_regions(rows).columns == ["cod_region", "gls_web_region", "norte_centro_sur"]
    with pytest.raises(ValueError, match="divisions lacks columns: norte_centro_sur"):
        preparation.shape_regions(rows.drop("Unnamed: 3"), "divisions")


def test_dates_of_value_inputs(spark):
    rows = spark.createDataFrame([(1, 202401, "2020-02-03"), (2, 202413, "no date")], "id int, PERIODO int, FechaIngreso string")
    shaped = lifetime.shape_inputs(rows)
    kept = [c for c in ("periodo", "fechaingreso") if c in shaped.columns]
    assert all(dict(shaped.dtypes)[c] == "date" for c in kept)
