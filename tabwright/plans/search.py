"""Parameter search and the baseline leaderboard: many fits on one prepared table."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import hash_uniform
from tabwright.operators.metrics import class_metrics
from tabwright.operators.prep import never_present, preprocessing_stages
from tabwright.operators.split import union_by_name
from tabwright.plans.training import SEED, Learner, boosted_trees, fit_classifier, score
from tabwright.sources.commits import CommitLog
from tabwright.sources import tables
from tabwright.sources.tables import ROWS_PER_FILE, spread, stage
from tabwright.spec import FeatureSpec


@dataclass(frozen=True)
class Range:
    """A parameter's range; ``scale`` is ``linear``, ``log`` or ``int`` (ends included)."""

    name: str
    low: float
    high: float
    scale: str = "linear"

    def at(self, u: Column) -> Column:
        """The value at the share ``u`` of the range."""
        if self.scale == "log":
            return F.lit(float(self.low)) * F.pow(F.lit(self.high / self.low), u)
        if self.scale == "int":
            return (F.floor(u * (int(self.high) - int(self.low) + 1)) + int(self.low)).cast("int")
        return F.lit(float(self.low)) + F.lit(float(self.high - self.low)) * u


# The ranges searched.
SEARCH_SPACE = (
    Range("eta", 0.01, 0.3, "log"),
    Range("max_depth", 3, 12, "int"),
    Range("min_child_weight", 1.0, 10.0),
    Range("subsample", 0.5, 1.0),
    Range("colsample_bytree", 0.5, 1.0),
)


def sample_parameters(
    trials: DataFrame, trial: str, seed: int = SEED, space: Sequence[Range] = SEARCH_SPACE
) -> DataFrame:
    """Adds one column per parameter, drawn from the seed, its name and the trial number."""
    return trials.select(
        "*",
        *[
            r.at(hash_uniform(F.lit(str(seed)), F.lit(r.name), F.col(trial))).alias(r.name)
            for r in space
        ],
    )


# The names of the runs in the log.
SEED_RUN_NAME = "seed_parameters_trial"
TRIAL_RUN_NAME = "optuna_trial_%03d"


def run_name(number: int) -> str:
    return TRIAL_RUN_NAME % number if number else SEED_RUN_NAME


@dataclass(frozen=True)
class Trial:
    number: int
    params: dict[str, float]
    precision: float
    recall: float
    f1: float

    @property
    def name(self) -> str:
        return run_name(self.number)


def trials_table(df: DataFrame, trials: Sequence[Trial]) -> DataFrame:
    rows = [(t.number, t.name, t.params, t.precision, t.recall, t.f1) for t in trials]
    return df.sparkSession.createDataFrame(
        [(n, name, {k: float(v) for k, v in p.items()}, *m) for n, name, p, *m in rows],
        "trial int, run_name string, params map<string,double>, "
        "validation_precision0 double, validation_recall0 double, validation_f10 double",
    )


def best_trial(log: DataFrame, trial: str, metric: str, columns: Sequence[str]) -> DataFrame:
    """The row with the highest metric; the lowest trial number among equals."""
    return log.agg(
        F.max_by(
            F.struct(trial, *columns, metric), F.struct(F.col(metric), -F.col(trial))
        ).alias("best")
    ).select("best.*")


def _prepare(train: DataFrame, valid: DataFrame, spec: FeatureSpec) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Preprocessing fitted once on ``train``, and both tables as label and vector.

    The prepared tables are written to the shared work folder, so a lost executor costs no more
    than a re-read. Rows to learn from are dealt over all cores once and kept on the executors'
    disks, where every fit reads them; the caller unpersists them.
    """
    known = F.col(spec.label).isNotNull()
    stages = preprocessing_stages(spec, empty=never_present(train, spec.numeric))
    prep = Pipeline(stages=stages).fit(train.select(*spec.features))
    ready = [
        stage(prep.transform(df.filter(known)).select(spec.label, "features"), name, ROWS_PER_FILE)
        for df, name in ((train, "search-train"), (valid, "search-valid"))
    ]
    return prep, spread(ready[0]).persist(StorageLevel.DISK_ONLY), ready[1]


def _fits_at_once(train: DataFrame, parallel: int) -> int:
    """How many fits may run side by side, each with a copy of ``train`` in the executors' caches.

    Small fits leave cores idle between their stages and share them. One that has ``ROWS_PER_TASK``
    rows for every core keeps them busy by itself, and copies for more would only push each other to disk.
    """
    room = tables.ROWS_PER_TASK * max(1, train.sparkSession.sparkContext.defaultParallelism)
    return max(1, min(parallel, room // max(1, train.count())))


def _validate(model, valid: DataFrame, spec: FeatureSpec) -> tuple[float, float, float]:
    row = class_metrics(model.transform(valid), spec.label, "prediction", spec.pos_label).first()
    return row["precision"], row["recall"], row["f1"]


#: a trial's result, under the fingerprint of its data and its parameters
JOURNAL = "data string, params string, precision double, recall double, f1 double"


def trial_key(params: Mapping[str, float]) -> str:
    return json.dumps({k: float(v) for k, v in sorted(params.items())})


def _fingerprint(train: DataFrame, valid: DataFrame, spec: FeatureSpec) -> str:
    """Rows and columns of both tables, whatever the order of their rows."""
    parts = []
    for df in (train, valid):
        row = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in (*spec.features, spec.label)])
        n, folded, total = df.select(row.alias("h")).agg(
            F.count("*"), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(38, 0)"))
        ).first()
        parts.append(f"{n}:{folded}:{total}")
    return hashlib.md5(json.dumps([parts, spec.features, spec.label, spec.pos_label]).encode()).hexdigest()


def search(
    train: DataFrame,
    valid: DataFrame,
    spec: FeatureSpec,
    n_trials: int = 5,
    seed_params: Mapping[str, float] | None = None,
    learner: Learner | None = None,
    parallel: int = 4,
    seed: int = SEED,
    journal: str | None = None,
) -> list[Trial]:
    """Fits ``n_trials`` parameter sets and measures each on ``valid``.

    Trial 0 takes ``seed_params`` if given. The fits are Spark jobs started from up to
    ``parallel`` driver threads, so the cluster is kept busy between their stages; where one fit
    does that by itself, they run one after the other.

    ``journal`` is a folder that outlives the driver. Each trial is committed there as it ends, under
    its parameters and a fingerprint of both tables, and a search that is started again fits only what is
    missing. A journal is for one learner; other data, other columns or other parameters are other trials.
    """
    spark = train.sparkSession
    drawn = sample_parameters(spark.range(n_trials), "id", seed).collect()
    params = [{r.name: row[r.name] for r in SEARCH_SPACE} for row in drawn]
    if seed_params and params:
        params[0] = dict(seed_params)
    learner = learner or boosted_trees(seed=seed)
    names = [trial_key(p) for p in params]
    done: dict[str, tuple[float, float, float]] = {}
    if journal:
        log, data = CommitLog(spark, journal, JOURNAL), _fingerprint(train, valid, spec)
        known = log.rows().filter(F.col("data") == data).collect()
        done = {r["params"]: (r["precision"], r["recall"], r["f1"]) for r in known}
    at_once, ready_train = 1, None
    # nothing is prepared where nothing is left to fit
    if not set(names) <= set(done):
        _, ready_train, ready_valid = _prepare(train, valid, spec)
        at_once = _fits_at_once(ready_train, min(parallel, n_trials))

    def run(number: int) -> Trial:
        if names[number] not in done:
            model = learner(params[number], spec).fit(ready_train)
            found = _validate(model, ready_valid, spec)
            if journal:
                record = dict(zip(("precision", "recall", "f1"), found))
                log.append(lambda _: {"data": data, "params": names[number], **record})
            return Trial(number, params[number], *found)
        return Trial(number, params[number], *done[names[number]])

    try:
        with ThreadPool(at_once) as pool:
            return pool.map(inheritable_thread_target(spark)(run), range(n_trials))
    finally:
        if ready_train is not None:
            ready_train.unpersist()


def best_of(trials: Sequence[Trial]) -> Trial:
    return max(trials, key=lambda t: (t.f1, -t.number))


def refit(
    train: DataFrame,
    valid: DataFrame,
    test: DataFrame,
    spec: FeatureSpec,
    params: Mapping[str, float],
    learner: Learner | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """The best parameters fitted on train and validation rows, and the scored test rows."""
    model = fit_classifier(union_by_name(train, valid), spec, params, learner)
    return model, score(model, test, spec)


def baseline_learners(spec: FeatureSpec, trees: int = 20, seed: int = SEED) -> dict[str, object]:
    names = {"labelCol": spec.label, "featuresCol": "features"}
    return {
        "logistic_regression": LogisticRegression(**names, maxIter=50),
        "decision_tree": DecisionTreeClassifier(**names, seed=seed),
        "random_forest": RandomForestClassifier(**names, numTrees=trees, seed=seed),
        "boosted_trees": GBTClassifier(**names, maxIter=trees, seed=seed),
    }


def baseline_leaderboard(
    train: DataFrame,
    valid: DataFrame,
    spec: FeatureSpec,
    excluded: Sequence[str] = (),
    budget_seconds: float | None = None,
    trees: int = 20,
) -> DataFrame:
    """Model kinds ranked by the class F1 they reach on ``valid`` with default settings.

    ``excluded`` columns take no part. Every kind is fitted, however long that takes. Only where a
    caller gives a budget, no fit starts once it is spent; kinds left out for that have a null score, at the end.
    """
    spec = FeatureSpec(
        tuple(c for c in spec.numeric if c not in set(excluded)),
        tuple(c for c in spec.categorical if c not in set(excluded)),
        spec.label,
        spec.keys,
        spec.ts,
        spec.pos_label,
    )
    end = float("inf") if budget_seconds is None else time.monotonic() + budget_seconds
    _, ready_train, ready_valid = _prepare(train, valid, spec)
    rows = []
    try:
        for name, estimator in baseline_learners(spec, trees).items():
            if time.monotonic() >= end:
                rows.append((name, None, None, None))
                continue
            rows.append((name, *_validate(estimator.fit(ready_train), ready_valid, spec)))
    finally:
        ready_train.unpersist()
    return train.sparkSession.createDataFrame(
        rows, "model string, precision double, recall double, f1 double"
    ).orderBy(F.desc_nulls_last("f1"), "model")
