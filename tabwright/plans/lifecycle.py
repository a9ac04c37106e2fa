"""The two plans a model goes through: trained and registered, then scoring and judged."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.lookup import join_late_labels, training_set
from tabwright.operators.metrics import class_metrics, classifier_evaluation, confusion_matrix
from tabwright.operators.split import hash_split
from tabwright.plans.search import Trial, best_of, refit, search
from tabwright.plans.training import SEED, SEED_PARAMETERS, Learner, score
from tabwright.sources.registry import ModelRegistry, signature_of
from tabwright.sources.runlog import RunLog
from tabwright.sources.tables import ROWS_PER_FILE, stage, write_predictions
from tabwright.spec import FeatureLookup, FeatureSpec


@dataclass(frozen=True)
class Trained:
    run_id: str
    version: int
    best: Trial
    precision: float
    recall: float
    f1: float


def log_search(log: RunLog, trials: Sequence[Trial], name: str) -> str:
    """One parent run with the best parameters, one child run per trial; the parent's id."""
    parent, best = uuid.uuid4().hex, best_of(trials)
    log.append_run(parent, name, params=best.params, metrics={"best_validation_f1": best.f1})
    for trial in trials:
        log.append_run(
            uuid.uuid4().hex,
            trial.name,
            parent,
            trial.params,
            {
                "validation_precision0": trial.precision,
                "validation_recall0": trial.recall,
                "validation_f10": trial.f1,
            },
        )
    return parent


def train_and_register(
    facts: DataFrame,
    lookups: Sequence[FeatureLookup],
    spec: FeatureSpec,
    registry: ModelRegistry,
    log: RunLog,
    weights: Sequence[float] = (0.6, 0.2, 0.2),
    n_trials: int = 5,
    seed_params: Mapping[str, float] | None = SEED_PARAMETERS,
    learner: Learner | None = None,
    parallel: int = 4,
    seed: int = SEED,
) -> Trained:
    """Training set, split, search, refit on train and validation, test, champion.

    The training set is written once to the shared folder; all later steps read it.
    """
    table = stage(training_set(facts, lookups, spec.label), "training-set", ROWS_PER_FILE)
    train, valid, test = hash_split(table, weights, seed, spec.keys)
    trials = search(train, valid, spec, n_trials, seed_params, learner, parallel, seed)
    log_search(log, trials, "parameter_search")
    best = best_of(trials)

    model, scored = refit(train, valid, test, spec, best.params, learner)
    result = stage(scored.select(spec.label, "prediction"), "test-predictions")
    found = class_metrics(result, spec.label, "prediction", spec.pos_label).first()
    run_id = uuid.uuid4().hex
    version = registry.register(
        model, signature_of(table.drop(spec.label), scored.select("prediction")), run_id
    )
    registry.set_alias("champion", version)
    log.append_run(
        run_id,
        "best_model",
        params=best.params,
        metrics={
            "test_precision0": found["precision"],
            "test_recall0": found["recall"],
            "test_f10": found["f1"],
        },
    )
    log.append_artifact(
        run_id, "test_confusion_matrix", confusion_matrix(result, spec.label, "prediction")
    )
    return Trained(run_id, version, best, *found)


def predict_and_store(
    holdout: DataFrame,
    spec: FeatureSpec,
    registry: ModelRegistry,
    table: str,
    path: str | None = None,
    alias: str = "champion",
    bucket_by: tuple[int, str] | None = None,
) -> DataFrame:
    """Scores ``holdout`` with the model of an alias and overwrites the predictions table.

    ``model_version`` tells which version scored, whatever the alias means later.
    """
    version = registry.version_of(alias)
    scored = score(registry.load_version(version), holdout, spec)
    return write_predictions(
        scored.withColumn("model_version", F.lit(version)), table, path=path, bucket_by=bucket_by
    )


def evaluate_stored(
    predictions: DataFrame,
    spec: FeatureSpec,
    registry: ModelRegistry,
    log: RunLog,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Evaluates stored predictions once their labels exist, and logs the figures under the
    version that made them.

    ``labels`` holds keys and label where they arrived apart from the predictions.
    """
    if labels is not None:
        predictions = join_late_labels(
            predictions.drop(spec.label), labels.select(*spec.keys, spec.label), spec.keys
        )
    found = classifier_evaluation(predictions, spec.label, "prediction", spec.pos_label)
    figures = found.first().asDict()
    version = predictions.agg(F.max("model_version")).first()[0]
    name = f"{registry.model}_v{version}_evaluation"
    log.append_run(uuid.uuid4().hex, name, metrics=figures)
    return found
