"""Value-by-churn grid, nearest-centroid segments and the campaign deliverable."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from membervane.fixed_values import (
    CHURN_BAND_NAMES,
    CHURN_FRACTIONS,
    HAIRCUT,
    SEGMENT_LABELS,
    VALUE_FRACTIONS,
)
from membervane.functions.numeric import haircut
from membervane.functions.text import count_amount_text, label
from membervane.operators.quantiles import exact_quantiles, quantile_cuts
from membervane.operators.rows import dedup_first
from membervane.session import stage

#: Scaled features inside a fitted model.
SCALED = "_scaled_features"


@dataclass(frozen=True)
class GridCuts:
    """Four ascending cut values per axis; three bands between them."""

    value: tuple[float | None, ...]
    churn: tuple[float | None, ...]


def grid_cuts(
    rows: DataFrame,
    population: DataFrame,
    value: str,
    churn: str,
    value_fractions: Sequence[float] = VALUE_FRACTIONS,
    churn_fractions: Sequence[float] = CHURN_FRACTIONS,
) -> GridCuts:
    """Value cuts from the given rows, churn cuts from the full population; NULL is ignored.

    Where both are one frame, one run finds all cuts.
    """
    if rows is population and value != churn:
        found = exact_quantiles(rows, [value, churn], {value: value_fractions, churn: churn_fractions})
        return GridCuts(tuple(found[value]), tuple(found[churn]))
    return GridCuts(
        tuple(quantile_cuts(rows, value, value_fractions)),
        tuple(quantile_cuts(population, churn, churn_fractions)),
    )


def band(col: Column, cuts: Sequence[float | None]) -> Column:
    """Band number from zero; a value on a cut belongs to the higher band, outside is NULL."""
    edges = [F.lit(c).cast("double") for c in cuts]
    out = F.when((col < edges[0]) | (col > edges[-1]), F.lit(None).cast("int"))
    for i in range(len(edges) - 2, -1, -1):
        out = out.when(col >= edges[i], F.lit(i))
    return out


def grid_segments(df: DataFrame, cuts: GridCuts, value: str, churn: str, out: str = "segment") -> DataFrame:
    """Add the grid cell 1 to 9; NULL outside the grid or without a value."""
    cell = 1 + 3 * band(F.col(value), cuts.value) + band(F.col(churn), cuts.churn)
    return df.withColumn(out, cell)


def _bands_hit(col: Column, cuts: Sequence[float | None]) -> Column:
    hits = [
        F.when((col >= F.lit(lo).cast("double")) & (col <= F.lit(hi).cast("double")), F.lit(i))
        for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
    ]
    return F.array_compact(F.array(*hits))


def grid_stats(
    df: DataFrame, cuts: GridCuts, key: str, value: str, churn: str, share: float = HAIRCUT
) -> DataFrame:
    """Members, mean and sum of the promised value per cell: nine rows.

    Both ends of a band are inside here, so a row on an inner cut counts in both bands.
    """
    cells = (
        df.select(
            key,
            value,
            F.explode(_bands_hit(F.col(value), cuts.value)).alias("value_band"),
            churn,
        )
        .select(
            key,
            value,
            "value_band",
            F.explode(_bands_hit(F.col(churn), cuts.churn)).alias("churn_band"),
        )
        .groupBy("value_band", "churn_band")
        .agg(
            F.count_distinct(key).alias("members"),
            haircut(F.avg(value), share).alias("mean_value"),
            haircut(F.sum(value), share).alias("sum_value"),
        )
    )
    grid = df.sparkSession.range(9).select(
        (F.col("id") / 3).cast("int").alias("value_band"),
        (F.col("id") % 3).cast("int").alias("churn_band"),
    )
    # Nine rows on either side.
    return grid.join(F.broadcast(cells), ["value_band", "churn_band"], "left").select(
        (1 + 3 * F.col("value_band") + F.col("churn_band")).alias("segment"),
        "value_band",
        "churn_band",
        F.coalesce("members", F.lit(0)).alias("members"),
        "mean_value",
        F.coalesce("sum_value", F.lit(0.0)).alias("sum_value"),
    )


def grid_pivot(stats: DataFrame, names: Sequence[str] = CHURN_BAND_NAMES) -> DataFrame:
    """One row per value band; count, amount and text of every churn band side by side."""

    def at(band_number: int, col: str) -> Column:
        return F.max(F.when(F.col("churn_band") == band_number, F.col(col)))

    cells = []
    for i, name in enumerate(names):
        members, amount = at(i, "members"), at(i, "sum_value")
        cells += [
            members.alias(f"members_{name}"),
            amount.alias(f"amount_{name}"),
            count_amount_text(members, amount).alias(f"text_{name}"),
        ]
    return stats.groupBy("value_band").agg(*cells)


def squared_distance(features: Sequence[Column], centroid: Sequence[float]) -> Column:
    """Squared Euclidean distance to a fixed point."""
    parts = [(f - F.lit(float(c))) * (f - F.lit(float(c))) for f, c in zip(features, centroid, strict=True)]
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out


def standardize(col: Column, mean: float, std: float) -> Column:
    """Distance from the mean in standard deviations."""
    return (col - F.lit(float(mean))) / F.lit(float(std))


def assign_segment(
    df: DataFrame,
    features: Sequence[str],
    centroids: Sequence[Sequence[float]],
    scale: Mapping[str, tuple[float, float]] | None = None,
    labels: Mapping[int, str] = SEGMENT_LABELS,
    out: str = "cluster",
    out_label: str = "category",
) -> DataFrame:
    """Number (from one) and label of the nearest centroid; NULL if a feature is missing.

    ``scale`` gives mean and standard deviation of features that the centroids expect scaled.
    """
    scale = scale or {}
    cols = [standardize(F.col(f), *scale[f]) if f in scale else F.col(f) for f in features]
    present = F.lit(True)
    for f in features:
        present = present & F.col(f).isNotNull()
    distances = [
        F.struct(squared_distance(cols, c).alias("distance"), F.lit(i).alias("number"))
        for i, c in enumerate(centroids, start=1)
    ]
    nearest = F.array_min(F.array(*distances))["number"]
    numbered = df.withColumn(out, F.when(present, nearest))
    return numbered.withColumn(out_label, label(F.col(out), labels))


def fit_segments(df: DataFrame, features: Sequence[str], k: int = 5, seed: int = 0) -> PipelineModel:
    """Cluster members on scaled features; the result is stored and applied by ``assign_segment_model``.

    Rows with a missing feature take no part.
    """
    names = [f"_feature_{i}" for i in range(len(features))]
    complete = df.select(*[F.col(f).cast("double").alias(n) for f, n in zip(features, names, strict=True)]).dropna()
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(complete)
    scaler = StandardScaler(inputCol="features", outputCol=SCALED, withMean=True, withStd=True)
    return Pipeline(stages=[scaler, KMeans(k=k, seed=seed, featuresCol=SCALED)]).fit(stage(vectors, "segment-inputs"))


def segment_centres(model: PipelineModel, features: Sequence[str]) -> tuple[list[list[float]], dict[str, tuple[float, float]]]:
    """Centres of a fitted model in scaled features, and mean and deviation of each feature: what ``assign_segment`` takes."""
    scaler, clusters = model.stages
    # A feature that does not vary is scaled to zero.
    scale = {f: (float(m), float(d) if d else math.inf) for f, m, d in zip(features, scaler.mean, scaler.std, strict=True)}
    return [[float(x) for x in c] for c in clusters.clusterCenters()], scale


def assign_segment_model(
    df: DataFrame,
    features: Sequence[str],
    model: Transformer,
    labels: Mapping[int, str] = SEGMENT_LABELS,
    out: str = "cluster",
    out_label: str = "category",
) -> DataFrame:
    """The same with a fitted clustering model that reads a ``features`` vector.

    Rows with a missing feature are scored at zero, as a model takes no gap, and get NULL.
    """
    present = F.lit(True)
    for f in features:
        value = F.col(f).cast("double")
        present = present & value.isNotNull() & ~F.isnan(value)
    filled = {f: f"_feature_{i}" for i, f in enumerate(features)}
    complete = df.withColumn("_present", present).withColumns(
        {g: F.when(F.col("_present"), F.col(f).cast("double")).otherwise(0.0) for f, g in filled.items()}
    )
    vectors = VectorAssembler(inputCols=list(filled.values()), outputCol="features", handleInvalid="keep")
    scored = model.transform(vectors.transform(complete)).drop("features", SCALED, *filled.values())
    numbered = scored.withColumn(out, F.when(F.col("_present"), F.col("prediction") + 1)).drop("prediction", "_present")
    return numbered.withColumn(out_label, label(F.col(out), labels))


def deliverable(
    df: DataFrame,
    key: str,
    columns: Mapping[str, str],
    amount: str,
    order: Sequence[str],
    share: float = HAIRCUT,
) -> DataFrame:
    """One row per member with chosen, renamed columns: ``{source: out}``; the amount reduced."""
    single = dedup_first(df, [key], order)
    return single.select(
        *[
            (haircut(F.col(src), share) if src == amount else F.col(src)).alias(out)
            for src, out in columns.items()
        ]
    )
