"""Batch scoring in place: the member key never leaves the row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from membervane.functions.numeric import clamp01


def linear(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """Weighted sum of columns."""
    out = F.lit(float(intercept))
    for name, weight in weights.items():
        out = out + F.lit(float(weight)) * F.col(name).cast("double")
    return out


def logistic(z: Column) -> Column:
    """Probability for a log-odds value."""
    return 1 / (1 + F.exp(-z))


def score_churn(df: DataFrame, models: Mapping[str, tuple[float, Mapping[str, float]]]) -> DataFrame:
    """Add churn probabilities: ``{out: (intercept, {column: weight})}``."""
    return df.withColumns({out: logistic(linear(w, b)) for out, (b, w) in models.items()})


def score_percentiles(
    df: DataFrame, models: Mapping[str, tuple[float, Mapping[str, float]]]
) -> DataFrame:
    """Add predicted percentiles, cut to the range 0 to 1."""
    return df.withColumns({out: clamp01(linear(w, b)) for out, (b, w) in models.items()})


def score_model(df: DataFrame, model: Transformer, out: str, probability: str = "probability") -> DataFrame:
    """Score with a fitted pipeline; keep the class-1 probability only.

    ``probability`` names the model's output: a vector with one entry per class, or a number.
    """
    kept = list(df.columns)
    scored = model.transform(df)
    if isinstance(scored.schema[probability].dataType, VectorUDT):
        value = vector_to_array(F.col(probability))[1]
    else:
        value = F.col(probability).cast("double")
    return scored.select(*kept, value.alias(out))
