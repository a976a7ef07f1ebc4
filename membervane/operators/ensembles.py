"""Several tree ensembles over the same inputs: trained, stored, and scored in one pass.

All models of a set share one feature vector, made of numeric inputs and of positions in a level dictionary. A set is stored as a folder of
pipeline models with a table that names its outputs, and scores rows in place: the keys of a row never leave it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from membervane.functions.numeric import clamp01
from membervane.operators.levels import level_indexers
from membervane.operators.schema import require_columns
from membervane.session import stage

#: What an output is: the probability of class 1, a percentile cut to 0 and 1, or the prediction as it is.
KINDS = ("probability", "percentile", "value")
#: What a missing number counts as: more than every other. Vectors of models hold no missing and no infinite values.
LARGEST = 1e300
INPUT, INDEX, VECTOR, FOUND = "_input_", "_index_", "_ensemble_inputs", "_found_"


@dataclass(frozen=True)
class Target:
    """What a model learns: a label column of the training rows (0 or 1 for a probability) and the size of its ensemble."""

    label: str
    kind: str = "probability"
    trees: int = 20
    depth: int = 5
    min_gain: float = 0.0


@dataclass(frozen=True)
class EnsembleSet:
    """Fitted models by output name, and the transformer of their common inputs."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    inputs: PipelineModel
    models: Mapping[str, tuple[str, PipelineModel]]

    def save(self, folder: str) -> None:
        """Write the set below a folder that isn't there yet; the table of its parts comes last, so a half-written set can't be loaded."""
        folder = folder.rstrip("/")
        self.inputs.save(f"{folder}/inputs")
        parts = [("numeric", c, None) for c in self.numeric] + [("categorical", c, None) for c in self.categorical]
        for out, (kind, model) in self.models.items():
            model.save(f"{folder}/models/{out}")
            parts.append(("output", out, kind))
        spark = SparkSession.getActiveSession()
        rows = [(place, *part) for place, part in enumerate(parts)]
        spark.createDataFrame(rows, "place int, part string, name string, kind string").coalesce(1).write.parquet(f"{folder}/parts")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> EnsembleSet:
        """A stored set."""
        folder = folder.rstrip("/")
        parts = spark.read.parquet(f"{folder}/parts").orderBy("place").collect()
        named = {p: tuple(r["name"] for r in parts if r["part"] == p) for p in ("numeric", "categorical")}
        models = {
            r["name"]: (r["kind"], PipelineModel.load(f"{folder}/models/{r['name']}")) for r in parts if r["part"] == "output"
        }
        return EnsembleSet(**named, inputs=PipelineModel.load(f"{folder}/inputs"), models=models)


def _with_inputs(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    require_columns(df, [*numeric, *categorical], "rows to score")
    numbers = {c: F.col(c).try_cast("double") for c in numeric}
    casts = {
        INPUT + c: F.when(x.isNull() | F.isnan(x), LARGEST).otherwise(F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST)))
        for c, x in numbers.items()
    }
    casts.update({INPUT + c: F.col(c).cast("string") for c in categorical})
    return df.withColumns(casts)


def fit_ensembles(
    training: DataFrame,
    levels: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    targets: Mapping[str, Target],
    seed: int = 0,
    at_once: int = 4,
) -> EnsembleSet:
    """Train one boosted ensemble per target on the rows whose label is there.

    ``levels`` is the dictionary of the categorical inputs (``operators.levels``); values it doesn't have and missing ones share one more
    category. A missing number follows the branch of the large ones. The assembled rows are staged once for all models,
    of which ``at_once`` train side by side.
    """
    unknown = {t.kind for t in targets.values()} - set(KINDS)
    if unknown:
        raise ValueError(f"unknown kinds of output: {sorted(unknown)}")
    indexers = level_indexers(levels, categorical, INPUT, INDEX) if categorical else []
    columns = [INPUT + c for c in numeric] + [INDEX + c for c in categorical]
    assembler = VectorAssembler(inputCols=columns, outputCol=VECTOR)
    inputs = PipelineModel([*indexers, assembler])
    labels = sorted({t.label for t in targets.values()})
    kept = [F.col(c).cast("double").alias(c) for c in labels]
    rows = stage(inputs.transform(_with_inputs(training, numeric, categorical)).select(VECTOR, *kept), "ensemble-training")
    bins = max([32, *[len(indexer.labels) + 1 for indexer in indexers]])

    def fit(out: str, target: Target) -> tuple[str, PipelineModel]:
        kind = GBTClassifier if target.kind == "probability" else GBTRegressor
        learner = kind(
            featuresCol=VECTOR, labelCol=target.label, maxIter=target.trees, maxDepth=target.depth,
            minInfoGain=target.min_gain, maxBins=bins, seed=seed,
        )
        fitted = learner.fit(rows.where(F.col(target.label).isNotNull()))
        if target.kind == "probability":
            # Only the probability is asked for, and it is computed from the inputs at once.
            fitted = fitted.setPredictionCol("").setRawPredictionCol("").setProbabilityCol(FOUND + out)
        else:
            fitted = fitted.setPredictionCol(FOUND + out)
        return target.kind, PipelineModel([fitted])

    with ThreadPoolExecutor(at_once) as pool:
        models = dict(zip(targets, pool.map(fit, targets.keys(), targets.values()), strict=True))
    return EnsembleSet(tuple(numeric), tuple(categorical), inputs, models)


def _output(out: str, kind: str) -> Column:
    found = F.col(FOUND + out)
    if kind == "probability":
        return vector_to_array(found)[1].alias(out)
    return (clamp01(found) if kind == "percentile" else found).alias(out)


def score_ensembles(df: DataFrame, ensembles: EnsembleSet, outputs: Sequence[str] | None = None) -> DataFrame:
    """``df`` with one column per output (or those listed), in one pass without a shuffle; a column of that name is replaced."""
    wanted = list(ensembles.models) if outputs is None else list(outputs)
    ready = ensembles.inputs.transform(_with_inputs(df, ensembles.numeric, ensembles.categorical))
    for out in wanted:
        ready = ensembles.models[out][1].transform(ready)
    return ready.select(*[c for c in df.columns if c not in wanted], *[_output(o, ensembles.models[o][0]) for o in wanted])
