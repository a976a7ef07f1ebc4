"""Lifetime value: percentiles and churn to money, rank and segment per member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membervane import fixed_values as fixed
from membervane.fixed_values import DISCOUNT_RATE, SEGMENT_LABELS
from membervane.functions.dates import period_date
from membervane.functions.numeric import (
    lifetime_value,
    lifetime_value_no_churn,
    margin,
    row_mean,
)
from membervane.functions.text import text_prefix
from membervane.operators.quantiles import count_values, quantile_rank, rank_values
from membervane.operators.rows import dedup_first
from membervane.operators.schema import (
    coerce_inputs,
    drop_existing,
    drop_like,
    lower_columns,
    rename_if,
    rename_map,
)
from membervane.operators.scoring import score_churn, score_percentiles
from membervane.operators.segments import assign_segment
from membervane.operators.value import annualize, bucket_drifts, percentile_to_value
from membervane.session import stage

YEARS = (1, 2, 3)
Model = tuple[float, Mapping[str, float]]


@dataclass(frozen=True)
class ValueModels:
    """Nine score models, one per year ahead, and the segment centroids."""

    income: Sequence[Model]
    cost: Sequence[Model]
    churn: Sequence[Model]
    centroids: Sequence[Sequence[float]]
    scale: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    labels: Mapping[int, str] = field(default_factory=lambda: SEGMENT_LABELS)


def shape_inputs(
    df: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = fixed.VALUE_CATEGORICAL_INPUTS,
) -> DataFrame:
    """Simplified categories, no future or code columns, typed model inputs that exist.

    Window averages are numeric whether listed or not; the period and the date of entry become dates.
    """
    df = lower_columns(df)
    dates = {"periodo": period_date(F.col("periodo")), "fechaingreso": F.col("fechaingreso").try_cast("date")}
    types = dict(df.dtypes)
    df = df.withColumns({c: day for c, day in dates.items() if types.get(c, "date") not in ("date", "timestamp")})
    df = drop_existing(df, fixed.DROPPED_BEFORE_SCORING)
    df = rename_map(rename_if(df, "categoria_gls", "categor__a_gls"), fixed.RENAMED_BEFORE_SCORING)
    for source, out in (
        ("categor__a_gls", "categ_simplificada"),
        ("linea_plan", "linea_plan_simplificada"),
    ):
        if source in df.columns:
            df = df.withColumn(out, text_prefix(F.col(source)))
    df = drop_existing(
        df, ["categor__a_gls", "linea_plan", "contrato", "correlativo", "fecha_nacimiento", "sexo"]
    )
    df = drop_like(df, ["fut", "cod"])
    numbers = {c for c in df.columns if c in numeric or "mva_" in c}
    return coerce_inputs(df, sorted(numbers), [c for c in categorical if c in df.columns])


def score_members(df: DataFrame, models: ValueModels) -> DataFrame:
    """Add percentile and churn predictions for one to three years ahead."""
    percentiles = {f"p_income_{y}": m for y, m in zip(YEARS, models.income, strict=True)}
    percentiles |= {f"p_cost_{y}": m for y, m in zip(YEARS, models.cost, strict=True)}
    churns = {f"churn_{y}": m for y, m in zip(YEARS, models.churn, strict=True)}
    return score_churn(score_percentiles(df, percentiles), churns)


def member_values(
    scored: DataFrame, key: str, order: Sequence[str], rate: float = DISCOUNT_RATE
) -> DataFrame:
    """Money, margins, lifetime values and their ranks, one row per member.

    ``scored`` has ``p_{income,cost}_{1,2,3}``, ``churn_{1,2,3}`` and the window averages
    ``{income,cost}_mva_*``. The frame is written out twice on the way, because the
    distributions of several columns are each read several times.
    """
    yearly = annualize(scored, ["cost", "income"])
    money = {f"{m}_{t}": f"perc_{m}_{t}" for m in ("cost", "income") for t in ("prev", "cur")}
    predictions = [f"p_{m}_{y}" for m in ("income", "cost") for y in YEARS]
    predictions += [f"churn_{y}" for y in YEARS]
    narrow = yearly.select(key, *[c for c in order if c != key], *predictions, *money)
    ranked = stage(narrow, "yearly")
    sizes = count_values(ranked, list(money))
    placed = quantile_rank(ranked, money, sizes=sizes)

    # Distributions come from all rows, predictions are made for one row per member.
    series = {
        f"{m}_prev": (f"perc_{m}_prev", f"perc_{m}_cur", f"{m}_prev", f"{m}_cur") for m in ("cost", "income")
    }
    drifts = bucket_drifts(placed, series)
    requests = {
        f"predicted_{m}_{y}": (f"p_{m}_{y}", f"{m}_prev", y) for m in ("income", "cost") for y in YEARS
    }
    members = dedup_first(ranked.select(key, *[c for c in order if c != key], *predictions), [key], order)
    pools = rank_values(ranked, list(series), {s: sizes[s] for s in series})
    valued = members.join(percentile_to_value(members, key, requests, pools, drifts), key, "left")

    margins = {
        f"predicted_margin_{y}": margin(F.col(f"predicted_income_{y}"), F.col(f"predicted_cost_{y}"))
        for y in YEARS
    }
    valued = valued.withColumns(margins)
    columns = [F.col(c) for c in margins]
    valued = valued.withColumn(
        "ltv_predicted", lifetime_value(columns, [F.col(f"churn_{y}") for y in YEARS], rate)
    ).withColumn("ltv_no_churn_predicted", lifetime_value_no_churn(columns, rate))
    final = [*margins, "ltv_predicted", "ltv_no_churn_predicted"]
    return quantile_rank(stage(valued, "valued"), {c: f"{c}_perc" for c in final})


SEGMENT_FEATURES = ("mean_income", "mean_cost", "mean_churn", "ltv_predicted", "ltv_no_churn_predicted")


def segment_features(values: DataFrame) -> DataFrame:
    """Means over the three years ahead that the segments are built on."""

    def over_years(name: str):
        return row_mean([F.col(f"{name}_{y}") for y in reversed(YEARS)])

    return values.withColumns(
        {
            "mean_income": over_years("predicted_income"),
            "mean_cost": over_years("predicted_cost"),
            "mean_churn": over_years("churn"),
        }
    )


def value_members(
    averages: DataFrame, key: str, models: ValueModels, order: Sequence[str], rate: float = DISCOUNT_RATE
) -> DataFrame:
    """The whole job: score, price, discount, rank and segment."""
    values = member_values(score_members(averages, models), key, order, rate)
    return assign_segment(
        segment_features(values),
        SEGMENT_FEATURES,
        models.centroids,
        models.scale,
        models.labels,
    )
