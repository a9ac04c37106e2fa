"""Champion against challenger on the same rows, and what follows for the aliases."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.metrics import compare_predictions
from tabwright.operators.split import hash_split, union_by_name
from tabwright.plans.training import CHALLENGER_PARAMETERS, SEED, Learner, fit_classifier, score
from tabwright.sources.registry import ModelRegistry, signature_of
from tabwright.sources.runlog import RunLog
from tabwright.spec import FeatureSpec


def decide(
    scored: DataFrame, label: str, champion: str, challenger: str, pos_label: int = 0
) -> DataFrame:
    """``champion_f1, challenger_f1, challenger_wins``: only a strictly higher F1 wins."""
    by_name = compare_predictions(
        scored, label, {"champion": champion, "challenger": challenger}, pos_label
    )
    f1 = by_name.agg(
        F.max(F.when(F.col("name") == "champion", F.col("f1"))).alias("champion_f1"),
        F.max(F.when(F.col("name") == "challenger", F.col("f1"))).alias("challenger_f1"),
    )
    return f1.withColumn("challenger_wins", F.col("challenger_f1") > F.col("champion_f1"))


def alias_outcome(decision: DataFrame, champion_version: int, challenger_version: int) -> DataFrame:
    """``alias, version`` after the duel: a winning challenger swaps places."""
    old, new = F.lit(champion_version), F.lit(challenger_version)
    wins = F.col("challenger_wins")
    return decision.select(
        F.inline(
            F.array(
                F.struct(F.lit("champion").alias("alias"), F.when(wins, new).otherwise(old).alias("version")),
                F.struct(F.lit("challenger").alias("alias"), F.when(wins, old).otherwise(new).alias("version")),
            )
        )
    )


def duel(
    labelled: DataFrame,
    holdout: DataFrame,
    spec: FeatureSpec,
    registry: ModelRegistry,
    params: Mapping[str, float] = CHALLENGER_PARAMETERS,
    weights: Sequence[float] = (0.8, 0.2),
    seed: int = SEED,
    learner: Learner | None = None,
    unseen_only: DataFrame | None = None,
    log: RunLog | None = None,
) -> DataFrame:
    """Trains a challenger on part of all labelled rows and lets both score the rest.

    The challenger is registered and gets its alias; if it wins, the aliases swap.
    ``unseen_only`` may hold the keys the champion was trained on: test rows with such
    a key are left out, which makes the comparison fair. With ``log`` the duel is a run of
    its own, with the challenger's parameters and both figures.
    """
    train, test = hash_split(union_by_name(labelled, holdout), weights, seed, spec.keys)
    if unseen_only is not None:
        test = test.join(unseen_only.select(*spec.keys), list(spec.keys), "left_anti")
    model = fit_classifier(train, spec, params, learner)
    champion_version, champion = registry.version_of("champion"), registry.load("champion")

    # One pass: the champion's prediction rides along while the challenger scores.
    by_champion = score(champion, test, spec).select(
        *test.columns, F.col("prediction").alias("_champion")
    )
    by_both = score(model, by_champion, spec).select(spec.label, "_champion", "prediction")
    found = decide(by_both, spec.label, "_champion", "prediction", spec.pos_label).first()

    outputs = score(model, train, spec).select("prediction")
    run_id = uuid.uuid4().hex
    challenger_version = registry.register(
        model, signature_of(train.drop(spec.label), outputs), run_id
    )
    if log is not None:
        log.append_run(
            run_id,
            f"challenger_v{challenger_version}",
            params=dict(params),
            metrics={"champion_f1": found["champion_f1"], "challenger_f1": found["challenger_f1"]},
        )
    registry.set_alias("challenger", challenger_version)
    if found["challenger_wins"]:
        registry.set_alias("challenger", champion_version)
        registry.set_alias("champion", challenger_version)
    return train.sparkSession.createDataFrame(
        [(champion_version, challenger_version, *found)],
        "champion_version int, challenger_version int, champion_f1 double, "
        "challenger_f1 double, challenger_wins boolean",
    )
