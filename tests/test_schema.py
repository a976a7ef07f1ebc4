from __future__ import annotations

import decimal

import pytest
from pyspark.sql import functions as F

from membervane import fixed_values as fixed
from membervane.operators import schema


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "x  ", "7", "bad")], "Id int, Name string, num_cod string, sum_future string")


def test_names(df):
    assert schema.lower_columns(df).columns == ["id", "name", "num_cod", "sum_future"]
    assert schema.upper_columns(df).columns == ["ID", "NAME", "NUM_COD", "SUM_FUTURE"]
    assert schema.rename_map(df, {"Id": "key", "none": "x"}).columns[0] == "key"
    assert schema.rename_if(df, "none", "x").columns == df.columns
    assert schema.resolve_column(df, "missing", "NAME") == "Name"
    assert schema.resolve_column(df, "missing") is None


def test_required_and_dropped(df):
    assert schema.require_columns(df, ["Id"], "t") is df
    with pytest.raises(ValueError, match="t lacks columns: a, b"):
        schema.require_columns(df, ["a", "Id", "b"], "t")
    assert schema.drop_existing(df, ["Name", "none"]).columns == ["Id", "num_cod", "sum_future"]
    with pytest.raises(ValueError):
        schema.drop_existing(df, ["none"], strict=True)
    assert schema.drop_like(df, ["fut", "cod"]).columns == ["Id", "Name"]
    assert schema.keep_like(df, ["fut", "I"]).columns == ["Id", "sum_future"]


def test_presence_report_covers_all_model_inputs(spark):
    expected = [*fixed.CATEGORICAL_INPUTS, *fixed.NUMERIC_INPUTS]
    assert len(fixed.CATEGORICAL_INPUTS) == 19 and len(fixed.NUMERIC_INPUTS) == 25
    df = spark.createDataFrame([(30, None), (40, "m")], "edad int, sexo string")
    got = {r["column"]: (r["present"], r["filled"]) for r in schema.presence_report(df, expected).collect()}
    assert len(got) == 44
    assert got["edad"] == (True, 2) and got["sexo"] == (True, 1) and got["avg_income"] == (False, 0)
    assert schema.presence_report(df, ["nothing"]).collect()[0]["present"] is False


def test_casts(df, spark):
    cast = schema.try_cast_columns(df, {"num_cod": "double", "sum_future": "int", "Id": "string", "none": "int"})
    assert dict(cast.dtypes) == {"Id": "int", "Name": "string", "num_cod": "double", "sum_future": "int"}
    assert cast.first()["num_cod"] == 7.0 and cast.first()["sum_future"] is None
    dec = spark.createDataFrame([(decimal.Decimal("1.50"), 2)], "d decimal(10,2), i int")
    assert dict(schema.decimals_to_double(dec).dtypes) == {"d": "double", "i": "int"}
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert sorted(str(r[0]) for r in schema.nan_to_null(nan).collect()) == ["1.0", "None"]
    coerced = schema.coerce_inputs(df, numeric=["num_cod", "sum_future"], categorical=["Id"])
    assert coerced.first().asDict() == {"Id": "1", "Name": "x  ", "num_cod": 7.0, "sum_future": None}


def test_constants_and_trims(df):
    out = schema.with_constants(df, {"a": 0}, {"target": "double"})
    assert dict(out.dtypes)["target"] == "double" and out.first()["a"] == 0
    assert schema.rtrim_columns(df, ["Name", "none"]).first()["Name"] == "x"


def test_zero_negatives(spark):
    df = spark.createDataFrame([(-1.0, -2.0), (None, 3.0)], "costo_total double, other double")
    got = [tuple(r) for r in schema.zero_negatives(df, fixed.ZEROED_COLUMNS).collect()]
    assert got == [(0.0, -2.0), (None, 3.0)]


def test_used_columns(spark):
    lists = [spark.createDataFrame([(x,) for x in names], "n string") for names in ("ab", "bc", "cc")]
    assert sorted(r[0] for r in schema.used_columns(lists).collect()) == ["a", "b", "c"]
    assert schema.used_columns(lists).columns == ["variable"]
    assert F.col("variable") is not None
