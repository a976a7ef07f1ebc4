"""Churn campaign: eligible members in a value-by-churn grid, and the deliverables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from membervane import fixed_values as fixed
from membervane.fixed_values import CHURN_FRACTIONS, DRIFT_ALARM, TOP_CHURN_QUANTILE, VALUE_BOUNDS, VALUE_FRACTIONS
from membervane.functions.flags import all_flags, eligible, within
from membervane.functions.numeric import capped_ratio
from membervane.operators.joins import attach_values
from membervane.operators.quality import wasserstein
from membervane.operators.quantiles import exact_quantiles, quantile_cuts
from membervane.operators.rows import dedup_first
from membervane.operators.schema import coerce_inputs, drop_existing, lower_columns, presence_report, upper_columns
from membervane.operators.segments import GridCuts, deliverable, grid_segments
from membervane.sources.versions import Version, commit


@dataclass(frozen=True)
class CampaignNames:
    """Columns of the joined campaign table."""

    member: str = "id_titular"
    age: str = "edad"
    complex_6m: str = "cie_complejo_mva_6m"
    claims_2m: str = "n_ges_mva_2m"
    churn: str = "prob_fuga"
    value: str = "predicted_margin_1"
    lifetime: str = "ltv_no_churn_predicted"


def shape_inputs(df: DataFrame, names: CampaignNames, order: Sequence[str]) -> DataFrame:
    """One row per member, typed model inputs, and the capped income in currency units."""
    df = dedup_first(lower_columns(df), [names.member], order)
    income = capped_ratio(F.col("renta_imponible"), F.col("valor_uf"))
    df = df.withColumn("renta_imponible_uf", income)
    return coerce_inputs(
        df,
        [c for c in fixed.NUMERIC_INPUTS if c in df.columns],
        [c for c in fixed.CATEGORICAL_INPUTS if c in df.columns],
    )


def input_report(df: DataFrame) -> DataFrame:
    """Which of the churn model's 44 inputs are there, and how many of their values are filled."""
    return presence_report(df, [*fixed.CATEGORICAL_INPUTS, *fixed.NUMERIC_INPUTS])


def campaign_table(
    scored: DataFrame, values: DataFrame, names: CampaignNames, order: Sequence[str]
) -> DataFrame:
    """One row per member with score and lifetime value."""
    single = dedup_first(scored, [names.member], order)
    return attach_values(single, dedup_first(values, [names.member], [names.member]), names.member)


def eligibility(df: DataFrame, names: CampaignNames) -> DataFrame:
    """Add the three flags and ``meets_filters``, 1 where all of them hold."""
    (threshold,) = quantile_cuts(df, names.churn, [TOP_CHURN_QUANTILE])
    flags = {
        "value_in_bounds": within(F.col(names.lifetime), *VALUE_BOUNDS),
        "is_eligible": eligible(F.col(names.age), F.col(names.complex_6m), F.col(names.claims_2m)),
        "top_churn": F.coalesce(F.col(names.churn) >= F.lit(threshold).cast("double"), F.lit(False)),
    }
    flagged = df.withColumns(flags)
    return flagged.withColumn("meets_filters", all_flags([F.col(f) for f in flags]))


def campaign(
    flagged: DataFrame,
    names: CampaignNames,
    columns: Mapping[str, str] = fixed.CAMPAIGN_COLUMNS,
    order: Sequence[str] = ("id_titular",),
) -> dict[str, DataFrame]:
    """Two deliverables, eligible members with their segment and everyone with the flag; and ``clusters``, all
    columns of the eligible members with their segment.

    ``flagged`` is read several times; stage it first when it is expensive to compute. Both sets of cuts come
    from one pass over it.
    """
    chosen = F.col("meets_filters") == 1
    asked = flagged.select(F.when(chosen, F.col(names.value)).alias("value"), F.col(names.churn).alias("churn"))
    found = exact_quantiles(asked, ["value", "churn"], {"value": VALUE_FRACTIONS, "churn": CHURN_FRACTIONS})
    cuts = GridCuts(tuple(found["value"]), tuple(found["churn"]))
    segmented = grid_segments(flagged.filter(chosen), cuts, names.value, names.churn)
    with_segment = {**columns, "segment": "segment"}
    with_flag = {**columns, "meets_filters": "meets_filters"}
    return {
        "segments": deliverable(segmented, names.member, with_segment, names.value, order),
        "everyone": deliverable(flagged, names.member, with_flag, names.value, order),
        "clusters": segmented,
    }


def publish_campaign(
    results: Mapping[str, DataFrame], values: DataFrame, scores: DataFrame, folder: str, period: int
) -> Version:
    """Publish everyone's deliverable, the clustered members, the value table and the scores with the value
    columns, with upper-case names, as the next version of the folder.

    Readers see all four of one version. Of two runs at once one wins, the other raises ``LostRace``.
    """
    tables = {
        "predictions": results["everyone"],
        "clusters": results["clusters"],
        "values": values,
        "scores": scores,
    }
    return commit(folder, {name: upper_columns(drop_existing(df, ["index"])) for name, df in tables.items()}, period)


def score_drift(new: DataFrame, training: DataFrame, col: str, alarm: float = DRIFT_ALARM) -> DataFrame:
    """Distance of the new scores from the training scores, and whether it is too large."""
    distance = wasserstein(training, new, col, col)
    return distance.withColumn("alarm", F.col("distance") > alarm)
