"""Fitting, scoring and explaining boosted-tree classifiers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.prep import check_levels, helper_columns, never_present, preprocessing_stages
from tabwright.plans.boosting import BoostedTrees
from tabwright.sources.tables import ROWS_PER_FILE, spread, stage
from tabwright.spec import FeatureSpec

Learner = Callable[[Mapping[str, float], FeatureSpec], Estimator]

SEED = 42

# Parameters the search starts from, and those of the challenger.
SEED_PARAMETERS = {
    "eta": 0.05759496965676729,
    "colsample_bytree": 0.6263993741226758,
    "max_depth": 9,
    "min_child_weight": 5.0,
    "subsample": 0.6616262667209235,
}
CHALLENGER_PARAMETERS = {
    "eta": 0.10129977249722856,
    "colsample_bytree": 0.860735030238694,
    "max_depth": 5,
    "min_child_weight": 7.191514678120411,
    "subsample": 0.8224911199963841,
}


def boosted_trees(trees: int = 20, bins: int = 32, seed: int = SEED) -> Learner:
    """A learner that gives the search's parameters to Spark's gradient-boosted trees.

    Two of them are near, not equal: ``min_child_weight`` becomes a row count per leaf,
    and ``colsample_bytree`` a share of the features per node instead of per tree.
    """

    def learner(params: Mapping[str, float], spec: FeatureSpec) -> GBTClassifier:
        trees_of = BoostedTrees(
            labelCol=spec.label,
            featuresCol="features",
            lossType="logistic",
            seed=seed,
            maxIter=trees,
            maxBins=bins,
            stepSize=float(params.get("eta", 0.1)),
            maxDepth=int(params.get("max_depth", 5)),
            minInstancesPerNode=max(1, round(params.get("min_child_weight", 1))),
            subsamplingRate=float(params.get("subsample", 1.0)),
            featureSubsetStrategy=str(float(params.get("colsample_bytree", 1.0))),
        )
        trees_of.one_hot = tuple(f"{c}_ohe_" for c in spec.categorical)
        return trees_of

    return learner


def fit_classifier(
    train: DataFrame,
    spec: FeatureSpec,
    params: Mapping[str, float],
    learner: Learner | None = None,
    impute: str | None = "mean",
    stage_input: bool = False,
    max_levels: int | None = None,
) -> PipelineModel:
    """Preprocessing and learner fitted on ``train`` as one pipeline.

    Fitting passes over its input several times. ``stage_input`` writes the columns it
    needs to the shared folder first: worth it where ``train`` is a join, such as a
    training set with lookups, and not where it is a plain table. The rows are dealt over all
    cores once, however few files they come from, and kept on the executors' disks, as are the
    label and vector made of them: preprocessing and learner pass over these, not over ``train``.
    ``max_levels`` refuses category columns of more values, whose index would be too large for
    one model.
    """
    learner = learner or boosted_trees()
    needed = train.select(*spec.features, spec.label).filter(F.col(spec.label).isNotNull())
    if stage_input:
        needed = stage(needed, "training-set", ROWS_PER_FILE)
    dealt = spread(needed).persist(StorageLevel.DISK_ONLY)
    try:
        check_levels(dealt, spec, max_levels)
        empty = never_present(dealt, spec.numeric) if impute else []
        prep = Pipeline(stages=preprocessing_stages(spec, impute, empty=empty)).fit(dealt)
        ready = prep.transform(dealt).select(spec.label, "features").persist(StorageLevel.DISK_ONLY)
        try:
            return PipelineModel([*prep.stages, learner(params, spec).fit(ready)])
        finally:
            ready.unpersist()
    finally:
        dealt.unpersist()


def score(model: PipelineModel, df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Every input column plus index, one-hot, ``features`` and the learner's three columns."""
    return model.transform(df).drop(*helper_columns(spec))


def added_columns(scored: DataFrame, inputs: DataFrame) -> DataFrame:
    """The columns scoring added, each with its number of non-null rows."""
    names = [c for c in scored.columns if c not in set(inputs.columns)]
    entries = [F.struct(F.lit(c).alias("column"), F.count(c).alias("rows")) for c in names]
    return scored.agg(F.array(*entries).alias("_all")).select(F.inline("_all"))


def feature_slots(scored: DataFrame) -> list[str]:
    """The names of the elements of ``features``, in order, from the column's metadata."""
    groups = scored.schema["features"].metadata["ml_attr"]["attrs"]
    attributes = [a for group in groups.values() for a in group]
    return [a["name"] for a in sorted(attributes, key=lambda a: a["idx"])]


def feature_importances(model: PipelineModel, scored: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Importance of each feature column; one-hot slots and flags count for their column."""
    weights = model.stages[-1].featureImportances
    total = dict.fromkeys(spec.features, 0.0)
    sources = {f"{c}{end}": c for c in spec.numeric for end in ("", "_imp", "_missing")}
    prefixes = {f"{c}_ohe_": c for c in spec.categorical}
    for place, name in enumerate(feature_slots(scored)):
        source = sources.get(name)
        if source is None:
            source = prefixes[max((p for p in prefixes if name.startswith(p)), key=len)]
        total[source] += float(weights[place])
    return scored.sparkSession.createDataFrame(
        list(total.items()), "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")
