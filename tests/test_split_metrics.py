import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabwright.operators import metrics, project, split

QUIET = dict(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(max_examples=6, **QUIET)
@given(
    weights=st.lists(st.floats(0.05, 5), min_size=1, max_size=4),
    seed=st.integers(0, 10**6),
    parts=st.integers(1, 9),
)
def test_a_hash_split_is_a_partition_and_ignores_partitioning(spark, weights, seed, parts):
    rows = spark.range(400).withColumnRenamed("id", "key")
    found = [
        {r["key"] for r in part.collect()}
        for part in split.hash_split(rows.repartition(parts), weights, seed, ["key"])
    ]
    again = [
        {r["key"] for r in part.collect()} for part in split.hash_split(rows, weights, seed, ["key"])
    ]
    assert found == again
    assert sum(map(len, found)) == 400 and len(set().union(*found)) == 400


def test_split_shares_come_near_the_weights(spark):
    rows = split.with_split(spark.range(20_000), [6, 2, 2], 42, ["id"], ["a", "b", "c"])
    counts = {r["split"]: r["rows"] for r in metrics.split_counts(rows).collect()}
    assert abs(counts["a"] - 12_000) < 400 and abs(counts["b"] - 4_000) < 300


def test_split_refuses_bad_arguments(spark):
    rows = spark.range(3)
    for weights, keys, names in (([], ["id"], []), ([1], [], ["a"]), ([-1, 2], ["id"], ["a", "b"])):
        with pytest.raises(ValueError):
            split.with_split(rows, weights, 1, keys, names)


def test_union_adds_rows_and_needs_the_same_names(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    both = split.union_by_name(a, a.select("s", "i"), a)
    assert both.count() == 3 and both.columns == ["i", "s"]
    with pytest.raises(Exception):
        split.union_by_name(a, a.withColumnRenamed("s", "t")).count()


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "label int, prediction double")


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([], (0.0, 0.0, 0.0)),
        ([(1, 1.0), (1, 1.0)], (0.0, 0.0, 0.0)),
        ([(0, 0.0)], (1.0, 1.0, 1.0)),
        ([(0, 0.0), (1, 0.0), (0, 1.0), (0, 0.0)], (2 / 3, 2 / 3, 2 / 3)),
        ([(0, 0.0), (None, 0.0), (0, None), (None, None)], (1.0, 1.0, 1.0)),
    ],
)
def test_class_metrics_of_small_frames(spark, pairs, expected):
    row = metrics.class_metrics(scored(spark, pairs), "label", "prediction").first()
    assert tuple(row) == pytest.approx(expected)


@settings(max_examples=6, **QUIET)
@given(st.lists(st.tuples(st.sampled_from([0, 1, None]), st.sampled_from([0.0, 1.0, None])), max_size=30))
def test_both_forms_of_evaluation_agree(spark, pairs):
    df = scored(spark, pairs)
    one = metrics.class_metrics(df, "label", "prediction").first()
    full = metrics.classifier_evaluation(df, "label", "prediction").first()
    assert (one["precision"], one["recall"], one["f1"]) == (
        full["precision_score"],
        full["recall_score"],
        full["f1_score"],
    )
    other = metrics.classifier_evaluation(df, "label", "prediction", pos_label=1).first()
    assert other["true_positives"] == full["true_negatives"]
    assert other["accuracy_score"] == full["accuracy_score"]


def test_confusion_matrix_has_only_cells_that_occur(spark):
    rows = metrics.confusion_matrix(scored(spark, [(0, 0.0), (1, 0.0), (0, 0.0)]), "label", "prediction")
    assert [tuple(r) for r in rows.collect()] == [(0.0, 0, 2), (0.0, 1, 1)]


def test_log_loss_floors_and_skips_missing(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.5), (None, 0.1), (1, None)], "label int, p double")
    import math

    expected = (-math.log(1e-15) - math.log(0.5)) / 2
    assert metrics.log_loss(df, "label", F.col("p")).first()[0] == pytest.approx(expected)


def test_versions_compare_as_numbers(spark):
    df = spark.createDataFrame([("9",), ("10",)], "version string")
    assert metrics.max_version(df, "version").first()[0] == 10


def test_excluding_an_unknown_column_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert project.exclude_columns(df, ["a"]).columns == ["b"]
    with pytest.raises(ValueError):
        project.exclude_columns(df, ["c"])
    assert project.where_equal(df, a=1, b=3).count() == 0
