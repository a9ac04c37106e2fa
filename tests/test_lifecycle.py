import time

import pytest
from pyspark.sql import functions as F

from tabwright import FeatureLookup, FeatureSpec
from tabwright.operators import metrics, prep, split
from tabwright.plans import boosting, duel, lifecycle, search, training
from tabwright.session import work_path
from tabwright.sources import registry, runlog, tables
from tabwright.sources.fixtures import ORDERS_SPEC, orders_features, rule_scored, table
from tabwright.streaming import scoring

PARAMS = {"eta": 0.3, "max_depth": 5, "min_child_weight": 1.0, "subsample": 0.8, "colsample_bytree": 0.9}


@pytest.fixture(scope="module")
def orders(spark, small):
    return tables.stage(orders_features(spark, small), "orders")


@pytest.fixture(scope="module")
def parts(orders):
    return split.hash_split(orders, (0.8, 0.2), 42, ["o_orderkey"])


@pytest.fixture(scope="module")
def model(parts):
    return training.fit_classifier(parts[0], ORDERS_SPEC, PARAMS, training.boosted_trees(trees=8))


def predictions(model, df):
    rows = training.score(model, df, ORDERS_SPEC).select("o_orderkey", "prediction").collect()
    return {r["o_orderkey"]: r["prediction"] for r in rows}


def test_the_model_learns(model, parts):
    scored = training.score(model, parts[1], ORDERS_SPEC)
    assert metrics.class_metrics(scored, "label", "prediction").first()["f1"] >= 0.8
    assert scored.count() == parts[1].count()


def test_saved_model_predicts_the_same(spark, model, parts):
    again = tables.load_model(tables.save_model(model, work_path(spark, "model")))
    assert predictions(again, parts[1]) == predictions(model, parts[1])


def test_same_seed_same_model(model, parts):
    again = training.fit_classifier(parts[0], ORDERS_SPEC, PARAMS, training.boosted_trees(trees=8))
    assert predictions(again, parts[1]) == predictions(model, parts[1])


def test_added_columns_are_those_of_the_stages(model, parts):
    scored = training.score(model, parts[1], ORDERS_SPEC)
    names = [r["column"] for r in training.added_columns(scored, parts[1]).collect()]
    expected = [f"{c}_idx" for c in ORDERS_SPEC.categorical] + [f"{c}_ohe" for c in ORDERS_SPEC.categorical]
    assert names == [*expected, "features", "rawPrediction", "probability", "prediction"]


def test_importances_cover_every_feature_and_sum_to_one(model, parts):
    scored = training.score(model, parts[1], ORDERS_SPEC)
    rows = training.feature_importances(model, scored, ORDERS_SPEC).collect()
    assert {r["feature"] for r in rows} == set(ORDERS_SPEC.features)
    assert sum(r["importance"] for r in rows) == pytest.approx(1)
    assert rows[0]["feature"] == "sum_qty"


def test_unseen_and_null_categories_share_the_last_slot(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    test = spark.createDataFrame([(1, "b"), (2, "new"), (3, None), (4, "a")], "id int, c string")
    from pyspark.ml import Pipeline

    stages = [prep.category_indexer(["c"]), prep.one_hot_encoder(["c"])]
    rows = prep.one_hot_slots(Pipeline(stages=stages).fit(train).transform(test), ["id"], ["c"]).collect()
    assert {r["id"]: r["slot"] for r in rows} == {1: 1, 2: 2, 3: 2, 4: 0}


def test_too_many_levels_are_refused(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("c"), F.lit(1).alias("label"))
    with pytest.raises(ValueError, match="levels"):
        prep.check_levels(df, FeatureSpec((), ("c",), "label"), max_levels=100)


def test_boolean_categories_and_columns_without_values(spark):
    rows = [(i % 2 == 0, None, float(i), int(i % 2 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "flag boolean, nothing double, x double, label int")
    spec = FeatureSpec(("nothing", "x"), ("flag",), "label", ("x",))
    model = training.fit_classifier(df, spec, PARAMS, training.boosted_trees(trees=2))
    scored = training.score(model, df, spec)
    assert scored.filter("prediction != label").count() == 0
    assert scored.schema["flag"].dataType.simpleString() == "boolean"
    rows = training.feature_importances(model, scored, spec).collect()
    assert rows[0]["feature"] == "flag"


def test_search_seeds_trial_zero_and_keeps_the_best(parts):
    trials = search.search(parts[0], parts[1], ORDERS_SPEC, 2, PARAMS, training.boosted_trees(trees=1))
    assert [t.name for t in trials] == ["seed_parameters_trial", "optuna_trial_001"]
    assert trials[0].params == PARAMS
    assert search.best_of(trials).f1 == max(t.f1 for t in trials)
    log = search.trials_table(parts[0], trials)
    best = search.best_trial(log, "trial", "validation_f10", ["run_name"]).first()
    assert best["run_name"] == search.best_of(trials).name


def test_equal_trials_go_to_the_lowest_number(spark):
    log = spark.createDataFrame([(2, 0.5), (1, 0.5), (3, 0.1)], "trial int, f1 double")
    assert search.best_trial(log, "trial", "f1", []).first()["trial"] == 1


def test_parameters_stay_in_range(spark):
    rows = search.sample_parameters(spark.range(500), "id").collect()
    for r in search.SEARCH_SPACE:
        values = [row[r.name] for row in rows]
        assert r.low <= min(values) and max(values) <= r.high
    assert {row["max_depth"] for row in rows} == set(range(3, 13))


def test_leaderboard_stops_at_its_budget(parts):
    rows = search.baseline_leaderboard(parts[0], parts[1], ORDERS_SPEC, budget_seconds=0).collect()
    assert len(rows) == 4 and all(r["f1"] is None for r in rows)


def test_leaderboard_fits_every_kind_unless_a_budget_is_given(spark, monkeypatch):
    """However long the fits take: here the clock goes on by an hour whenever it is read."""
    hours = iter(range(10**6))
    monkeypatch.setattr(search.time, "monotonic", lambda: 3600.0 * next(hours))
    rows = spark.range(200).selectExpr("id", "id % 7 as x", "int(id % 7 > 3) as label")
    spec = FeatureSpec(("x",), (), "label", ("id",))
    found = search.baseline_leaderboard(rows, rows, spec, trees=1).collect()
    assert len(found) == 4 and all(r["f1"] is not None for r in found)


def test_a_duel_swaps_aliases_only_for_a_better_challenger(spark, model, parts, orders):
    models = registry.ModelRegistry(spark, work_path(spark, "registry"), "orders")
    with pytest.raises(KeyError):
        models.version_of("champion")
    models.set_alias("champion", models.register(model, registry.signature_of(orders)))
    empty = orders.limit(0)
    learner = training.boosted_trees(trees=8)
    # The challenger is the champion again: same rows, same seed, so nobody is better.
    tie = duel.duel(orders, empty, ORDERS_SPEC, models, PARAMS, learner=learner).first()
    assert not tie["challenger_wins"] and tie["champion_f1"] == tie["challenger_f1"]
    assert (models.version_of("champion"), models.version_of("challenger")) == (1, 2)
    weak = training.fit_classifier(
        parts[0].limit(60), ORDERS_SPEC, {**PARAMS, "max_depth": 1}, training.boosted_trees(trees=1)
    )
    models.set_alias("champion", models.register(weak, registry.signature_of(orders)))
    won = duel.duel(orders, empty, ORDERS_SPEC, models, PARAMS, learner=learner).first()
    assert won["challenger_wins"]
    assert (models.version_of("champion"), models.version_of("challenger")) == (4, 3)
    assert predictions(models.load("champion"), parts[1]) == predictions(model, parts[1])


def test_duel_can_leave_out_rows_the_champion_saw(spark, model, parts, orders):
    models = registry.ModelRegistry(spark, work_path(spark, "registry"), "fair")
    models.set_alias("champion", models.register(model, registry.signature_of(orders)))
    seen = orders.select("o_orderkey")
    found = duel.duel(
        orders, orders.limit(0), ORDERS_SPEC, models, PARAMS,
        learner=training.boosted_trees(trees=1), unseen_only=seen,
    ).first()
    assert found["champion_f1"] == 0.0 and not found["challenger_wins"]


def test_signature_differences(spark):
    wanted = registry.signature_of(spark.createDataFrame([(1, "a", 2.0)], "i int, s string, d double"))
    other = spark.createDataFrame([(1, 2.0, True)], "i bigint, d double, extra boolean")
    found = {r["column"]: (r["problem"], r["rows"]) for r in registry.schema_differences(other, wanted).collect()}
    assert found == {"i": ("type", 1), "s": ("missing", 0), "extra": ("extra", 1)}
    same = spark.createDataFrame([(1, "a", 2.0)], "i int, s string, d double")
    assert registry.schema_differences(same, wanted).count() == 0


def test_run_log_reads_back_what_was_appended(spark):
    log = runlog.RunLog(spark, work_path(spark, "log"))
    log.append_run("p", "parent", metrics={"best": 0.5})
    log.append_run("r1", "trial", "p", {"eta": 0.1}, {"f1": 0.5, "recall": 0.4})
    log.append_artifact("r1", "matrix", spark.createDataFrame([(0, 1)], "prediction int, rows int"))
    wide = {r["run_id"]: (r["f1"], r["recall"]) for r in runlog.wide_metrics(log.metrics(), ["f1", "recall"]).collect()}
    assert wide["r1"] == (0.5, 0.4)
    assert [tuple(r) for r in log.params().collect()] == [("r1", "eta", "0.1")]
    assert log.runs().filter("parent_run_id = 'p'").count() == 1
    assert log.artifact("r1", "matrix").first()["rows"] == 1


def test_predictions_table_is_overwritten(spark, model, parts):
    path = work_path(spark, "predictions")
    scored = training.score(model, parts[1], ORDERS_SPEC)
    first = tables.write_predictions(scored, "predictions_test", path, bucket_by=(4, "o_orderkey"))
    again = tables.write_predictions(scored, "predictions_test", path, bucket_by=(4, "o_orderkey"))
    assert again.count() == parts[1].count()
    assert dict(again.dtypes)["probability"] == "array<double>"
    plan = again.groupBy("o_orderkey").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert first.columns == scored.columns


def test_a_stream_scores_each_file_once(spark, tiny):
    source, out, checkpoint = (work_path(spark, n) for n in ("source", "scored", "checkpoint"))
    events = table(spark, tiny, "events")
    early, late = split.hash_split(events, (0.5, 0.5), 1, ["event_id"])
    for batch in (early, late):
        batch.write.mode("append").parquet(source)
        stream = scoring.parquet_stream(spark, source, events.schema)
        scoring.score_stream(stream, rule_scored, out, checkpoint).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == events.count()
    assert got.exceptAll(rule_scored(events)).count() == 0


def test_work_path_follows_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x").startswith(root) and work_path(spark, "x") != work_path(spark, "x")


def test_the_whole_life_of_a_model(spark, orders):
    labelled, holdout = split.hash_split(orders, (0.7, 0.3), 7, ["o_orderkey"])
    facts = labelled.select("o_orderkey", "ts", "label")
    features = FeatureLookup(
        labelled.drop("label"), tuple(ORDERS_SPEC.features), "o_orderkey", timestamp_lookup_key="ts"
    )
    models = registry.ModelRegistry(spark, work_path(spark, "registry"), "orders")
    log = runlog.RunLog(spark, work_path(spark, "log"))
    done = lifecycle.train_and_register(
        facts, [features], ORDERS_SPEC, models, log,
        n_trials=2, seed_params=PARAMS, learner=training.boosted_trees(trees=5),
    )
    assert done.f1 >= 0.8 and models.version_of("champion") == done.version == 1
    matrix = log.artifact(done.run_id, "test_confusion_matrix")
    assert matrix.agg(F.sum("rows")).first()[0] == split.hash_split(
        labelled, (0.6, 0.2, 0.2), 42, ["o_orderkey"]
    )[2].count()
    names = {r["run_name"] for r in log.runs().collect()}
    assert names == {"parameter_search", "seed_parameters_trial", "optuna_trial_001", "best_model"}

    stored = lifecycle.predict_and_store(
        holdout.drop("label"), ORDERS_SPEC, models, "whole_life", work_path(spark, "stored")
    )
    labels = holdout.select("o_orderkey", "label")
    figures = lifecycle.evaluate_stored(stored, ORDERS_SPEC, models, log, labels).first()
    assert figures["example_count"] == holdout.count() and figures["f1_score"] >= 0.8
    assert log.runs().filter("run_name = 'orders_v1_evaluation'").count() == 1
    apart = registry.schema_differences(holdout.drop("label"), models.signature("champion"))
    assert [(r["column"], r["problem"]) for r in apart.collect()] == [("entity_id", "extra")]


def test_probabilities_of_a_fitted_model_give_a_log_loss(model, parts):
    scored = training.score(model, parts[1], ORDERS_SPEC)
    loss = metrics.log_loss(scored, "label", metrics.probability_of_one()).first()["log_loss"]
    assert 0 < loss < 0.69


def test_fitting_on_a_staged_input_gives_the_same_model(model, parts):
    again = training.fit_classifier(
        parts[0], ORDERS_SPEC, PARAMS, training.boosted_trees(trees=8), stage_input=True
    )
    here, there = predictions(model, parts[1]), predictions(again, parts[1])
    assert sum(here[k] == there[k] for k in here) >= 0.95 * len(here)


def test_a_search_goes_on_where_it_ended(spark, parts):
    train, valid = parts[0].limit(2000), parts[1].limit(500)
    train, valid = tables.stage(train, "train"), tables.stage(valid, "valid")
    fits = []

    def learner(fail_after):
        inner = training.boosted_trees(trees=1)

        def make(params, spec):
            if len(fits) >= fail_after:
                raise RuntimeError("the driver is gone")
            fits.append(params)
            return inner(params, spec)

        return make

    journal = work_path(spark, "journal")
    settings = {"n_trials": 4, "seed_params": PARAMS, "parallel": 1, "journal": journal}
    with pytest.raises(RuntimeError):
        search.search(train, valid, ORDERS_SPEC, learner=learner(2), **settings)
    assert len(fits) == 2
    again = search.search(train, valid, ORDERS_SPEC, learner=learner(99), **settings)
    assert len(fits) == 4
    settings.pop("journal")
    assert again == search.search(train, valid, ORDERS_SPEC, learner=training.boosted_trees(trees=1), **settings)
    # other data are other trials
    fits.clear()
    search.search(train.limit(1000), valid, ORDERS_SPEC, learner=learner(99), **settings, journal=journal)
    assert len(fits) == 4


def test_medians_are_exact_and_survive_storage(spark):
    rows = [(float(i % 7) if i % 5 else None, float("nan") if i % 3 == 0 else float(i), None, i) for i in range(101)]
    df = spark.createDataFrame(rows, "`a.b` double, b double, empty double, id int")
    names = ["a.b", "b", "empty"]
    from pyspark.ml import Pipeline

    imputer = prep.MedianImputer(inputCols=names, outputCols=["x", "y", "z"])
    model = Pipeline(stages=[imputer]).fit(df)
    again = tables.load_model(tables.save_model(model, work_path(spark, "imputer")))
    got = [tuple(r) for r in again.transform(df).orderBy("id").select("x", "y", "z").collect()]
    import statistics

    a = statistics.median(r[0] for r in rows if r[0] is not None)
    b = statistics.median(r[1] for r in rows if r[1] == r[1])
    assert got == [(r[0] if r[0] is not None else a, r[1] if r[1] == r[1] else b, 0.0) for r in rows]


def test_learners_get_rows_dealt_over_all_cores(spark, monkeypatch):
    """Whatever the files: a table of one partition is fitted by many tasks of a bounded number of rows."""
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 1_000)
    spec = FeatureSpec(("x",), (), "label", ("id",))
    rows = spark.range(0, 40_000, 1, 1).selectExpr("id", "id % 7 as x", "int(id % 2) as label")
    seen = []

    class Learner:
        def fit(self, df):
            seen.append(df.rdd.glom().map(len).collect())
            raise RuntimeError("seen")

    for run in (
        lambda: training.fit_classifier(rows, spec, {}, lambda params, spec: Learner()),
        lambda: search.search(rows, rows, spec, 1, None, lambda params, spec: Learner()),
    ):
        with pytest.raises(RuntimeError, match="seen"):
            run()
    assert len(seen) == 2
    for sizes in seen:
        assert sum(sizes) == 40_000 and len(sizes) >= 8 and max(sizes) <= 6_000


def test_large_fits_run_one_after_the_other_on_rows_dealt_once(spark, monkeypatch):
    """Small fits share the cores; of large ones only one copy of the rows is in the caches at a time."""
    spec = FeatureSpec(("x",), (), "label", ("id",))
    rows = spark.range(0, 40_000, 1, 1).selectExpr("id", "id % 7 as x", "int(id % 2) as label")
    running, most, dealt = [], [], []

    class Learner:
        def fit(self, df):
            running.append(1)
            most.append(len(running))
            dealt.append((df.storageLevel.useDisk, df))
            time.sleep(0.5)
            running.pop()
            return self

        def transform(self, df):
            return df.withColumn("prediction", F.col("label").cast("double"))

    def widest(rows_per_task):
        monkeypatch.setattr(tables, "ROWS_PER_TASK", rows_per_task)
        most.clear()
        search.search(rows, rows, spec, 4, None, lambda params, spec: Learner())
        return max(most)

    assert widest(1_000) == 1
    assert widest(250_000) > 1
    assert len(dealt) == 8 and all(kept for kept, _ in dealt)
    assert not any(df.storageLevel.useDisk for _, df in dealt)


def test_a_fit_reads_its_rows_once(spark):
    """Preprocessing and learner pass over kept rows; what ``train`` is made of is not worked out again."""
    worked_out, kept = spark.sparkContext.accumulator(0), []

    @F.udf("double")
    def costly(value):
        worked_out.add(1)
        return float(value % 7)

    rows = spark.range(0, 20_000, 1, 4).select(
        "id", costly.asNondeterministic()("id").alias("x"), (F.col("id") % 5).cast("string").alias("c"), F.expr("int(id % 2) as label")
    )
    inner = training.boosted_trees(trees=2)

    class Learner:
        def __init__(self, params, spec):
            self.trees = inner(params, spec)

        def fit(self, df):
            kept.append((df.storageLevel.useDisk, df))
            return self.trees.fit(df)

    model = training.fit_classifier(rows, FeatureSpec(("x",), ("c",), "label", ("id",)), {"max_depth": 3}, Learner)
    assert len(model.stages[-1].trees) == 2
    # at most once to be counted and once to be dealt
    assert worked_out.value <= 40_000
    assert kept[0][0] and not kept[0][1].storageLevel.useDisk


def test_an_orders_lines_meet_before_they_are_summed(spark, small):
    """No sort and sum of lines ahead of the shuffle by order, which a text among the sums would ask for twice."""
    lines = orders_features(spark, small)._jdf.queryExecution().executedPlan().toString().splitlines()
    sums = [i for i, line in enumerate(lines) if "Aggregate(key=[l_orderkey" in line]
    shuffle = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(l_orderkey" in line]
    assert len(shuffle) == 1 and sums and max(sums) < shuffle[0]


def ready_rows(spark, n=6_000, parts=3):
    """Numbers with zeros and equal values, two one-hot columns, one of them nearly the other, and noise in the label."""
    rows = spark.range(0, n, 1, parts).selectExpr(
        "id", "(id * 7919) % 1000 / 10.0 as x", "if(id % 3 = 0, 0.0, (id * 31) % 17) as y", "if(id % 11 = 0, null, id % 5) as z",
        "concat('k', (id * 13) % 6) as c", "concat('k', if(id % 50 = 0, 9, (id * 13) % 6)) as d",
    )
    rows = rows.selectExpr("*", "int(x + 3 * y + if(c = 'k2', 25, 0) + (id * 104729) % 40 > 75) as label")
    spec = FeatureSpec(("x", "y", "z"), ("c", "d"), "label", ("id",))
    from pyspark.ml import Pipeline

    prepared = Pipeline(stages=prep.preprocessing_stages(spec)).fit(rows).transform(rows).select("label", "features")
    return tables.stage(prepared, "ready").repartition(parts).persist(), spec


def spark_fit(learner, ready):
    """The same parameters given to Spark's own classifier."""
    from pyspark.ml.classification import GBTClassifier

    own = GBTClassifier()
    for p, value in learner._paramMap.items():
        own._set(**{p.name: value})
    return own.fit(ready)


def tree_lines(model):
    """The trees as text, without the last digits, which depend on the order of sums."""
    import re

    text = model.toDebugString.split("\n", 1)[1]
    return [re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m[0]):.9g}", line) for line in text.split("\n")]


def test_trees_from_codes_are_those_of_spark(spark):
    """Thresholds, draws, splits, leaves and importances of Spark's own classifier, whatever is drawn."""
    ready, spec = ready_rows(spark)
    for depth, subsample, columns in ((4, 0.7, 0.6), (7, 1.0, 0.8), (3, 0.5, 1.0)):
        params = {"eta": 0.2, "max_depth": depth, "min_child_weight": 3.0, "subsample": subsample, "colsample_bytree": columns}
        learner = training.boosted_trees(trees=4)(params, spec)
        assert isinstance(learner, boosting.BoostedTrees)
        ours, theirs = learner.fit(ready), spark_fit(learner, ready)
        assert tree_lines(ours) == tree_lines(theirs)
        assert ours.treeWeights == theirs.treeWeights and ours.numFeatures == theirs.numFeatures
        assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())
        assert ours.getOrDefault("maxDepth") == depth and ours.uid == learner.uid
    ready.unpersist()


def test_large_fits_grow_the_same_trees_over_all_cores(spark, monkeypatch):
    """Blocks within partitions, sums that meet node by node, and fewer nodes at once than a level has."""
    ready, spec = ready_rows(spark)
    learner = training.boosted_trees(trees=3)({"eta": 0.2, "max_depth": 6, "subsample": 0.7, "colsample_bytree": 0.7}, spec)
    here = learner.fit(ready)
    kept = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 700)
    monkeypatch.setattr(boosting, "NODES_PER_TASK", 5)
    spread = learner.fit(ready)
    before, after = (m.transform(ready).select("prediction").collect() for m in (here, spread))
    assert sum(a == b for a, b in zip(before, after)) >= 0.99 * len(before)
    assert spread.featureImportances.toArray() == pytest.approx(here.featureImportances.toArray(), abs=0.01)
    assert tree_lines(spread)[: len(tree_lines(here)) // 3] == tree_lines(here)[: len(tree_lines(here)) // 3]
    # nothing of the fit stays in the caches: only the rows it was given
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == kept
    ready.unpersist()


def test_a_row_of_a_large_fit_is_kept_in_a_byte_for_each_column(spark):
    """Spark keeps four for each slot of the vector, which is what made large fits read from disk."""
    ready, spec = ready_rows(spark)
    learner = training.boosted_trees(trees=1)({}, spec)
    settings, rows = learner._settings(ready)
    assert rows == 6_000
    held = boosting.blocks(ready, "label", "features", settings.layout).collect()
    slots = len(settings.layout.code)
    columns = len(settings.layout.sizes)
    assert sum(block[2].nbytes for block in held) == rows * columns and columns < slots
