from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabwright import FeatureLookup
from tabwright.operators.lookup import (
    exact_lookup,
    join_late_labels,
    point_in_time_lookup,
    training_set,
)

START = datetime(2024, 3, 10)
FACT = "id bigint, k string, ts timestamp_ntz"
FEATURE = "k string, ts timestamp_ntz, a double, b string, rank int"


def at(hours):
    return None if hours is None else START + timedelta(hours=hours)


def brute_force(facts, features):
    out = {}
    for i, k, hour in facts:
        best = None
        for fk, fh, a, b, rank in features:
            if fk is None or fk != k or hour is None or fh is None or fh > hour:
                continue
            if best is None or (fh, rank) > (best[0], best[3]):
                best = (fh, a, b, rank)
        out[i] = (best[1], best[2]) if best else (None, None)
    return out


def run(spark, facts, features, tie="rank", **options):
    left = spark.createDataFrame([(i, k, at(h)) for i, k, h in facts], FACT)
    right = spark.createDataFrame([(k, at(h), a, b, r) for k, h, a, b, r in features], FEATURE)
    lookup = FeatureLookup(right, ("a", "b"), "k", "ts", tie)
    rows = point_in_time_lookup(left, lookup, **options).collect()
    return rows, {r["id"]: (r["a"], r["b"]) for r in rows}


def test_newest_row_is_taken_whole_even_if_it_is_null(spark):
    facts = [(1, "x", 5)]
    features = [("x", 1, 1.0, "old", 0), ("x", 4, None, None, 0)]
    _, found = run(spark, facts, features)
    assert found == {1: (None, None)}


def test_equal_time_counts_and_the_future_does_not(spark):
    features = [("x", 5, 5.0, "now", 0), ("x", 6, 6.0, "later", 0)]
    _, found = run(spark, [(1, "x", 5), (2, "x", 4)], features, tie=None)
    assert found == {1: (5.0, "now"), 2: (None, None)}


def test_ties_need_a_tie_break(spark):
    features = [("x", 1, 1.0, "a", 1), ("x", 1, 2.0, "b", 2)]
    with pytest.raises(Exception, match="tie_break"):
        run(spark, [(1, "x", 5)], features, tie=None)
    _, found = run(spark, [(1, "x", 5)], features)
    assert found == {1: (2.0, "b")}


def test_a_tie_that_the_tie_break_cannot_settle_is_an_error(spark):
    features = [("x", 1, 1.0, "a", 2), ("x", 1, 2.0, "b", 2)]
    with pytest.raises(Exception, match="tie_break"):
        run(spark, [(1, "x", 5)], features)


def test_null_keys_and_times_match_nothing(spark):
    features = [(None, 1, 1.0, "a", 0), ("x", None, 2.0, "b", 0)]
    _, found = run(spark, [(1, None, 5), (2, "x", None), (3, "x", 5)], features, tie=None)
    assert found == {1: (None, None), 2: (None, None), 3: (None, None)}


hours = st.one_of(st.none(), st.integers(0, 30))
keys = st.sampled_from(["hot", "hot", "hot", "cold", None])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    facts=st.lists(st.tuples(keys, hours), max_size=25),
    features=st.lists(st.tuples(keys, hours), max_size=25),
    rows_per_slice=st.sampled_from([3, 10_000]),
)
def test_like_brute_force_with_and_without_hot_keys(spark, facts, features, rows_per_slice):
    facts = [(i, k, h) for i, (k, h) in enumerate(facts)]
    features = [(k, h, float(i), f"row{i}", i) for i, (k, h) in enumerate(features)]
    rows, found = run(spark, facts, features, rows_per_slice=rows_per_slice)
    assert len(rows) == len(facts)
    assert found == brute_force(facts, features)


def test_hot_key_of_many_rows_is_cut_in_slices(spark):
    facts = [(i, "hot" if i % 3 else f"k{i}", i % 40) for i in range(300)]
    features = [("hot", i % 17, float(i), f"r{i}", i) for i in range(100)]
    rows, found = run(spark, facts, features, rows_per_slice=5, matched_ts="seen")
    assert found == brute_force(facts, features)
    assert all(r["seen"] is None or r["seen"] <= r["ts"] for r in rows)


def test_exact_lookup_wants_unique_keys(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, k string")
    features = spark.createDataFrame([("x", 1.0), ("z", 2.0)], "k string, a double")
    found = exact_lookup(facts, FeatureLookup(features, ("a",), "k"))
    assert {r["id"]: r["a"] for r in found.collect()} == {1: 1.0, 2: None, 3: None}
    with pytest.raises(ValueError, match="share"):
        exact_lookup(facts, FeatureLookup(features.union(features), ("a",), "k"))


def test_training_set_checks_its_names(spark):
    facts = spark.createDataFrame([(1, "x", 1)], "id int, k string, label int")
    features = spark.createDataFrame([("x", 1)], "k string, label int")
    with pytest.raises(ValueError, match="label"):
        training_set(facts, [], "target")
    with pytest.raises(ValueError, match="rename"):
        training_set(facts, [FeatureLookup(features, ("label",), "k")], "label")
    renamed = FeatureLookup(features, ("label",), "k", rename={"label": "last_label"})
    assert training_set(facts, [renamed], "label").columns == ["id", "k", "label", "last_label"]


def test_late_labels_keep_only_labelled_rows(spark):
    predictions = spark.createDataFrame([(1, 0.0), (2, 1.0)], "id int, prediction double")
    labels = spark.createDataFrame([(2, 1), (3, 0)], "id int, label int")
    rows = join_late_labels(predictions, labels, ["id"]).collect()
    assert [tuple(r) for r in rows] == [(2, 1.0, 1)]


def test_a_key_column_may_be_called_count(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b")], "count int, x string")
    features = spark.createDataFrame([(1, 10.0), (3, 30.0)], "count int, v double")
    got = exact_lookup(facts, FeatureLookup(features, ("v",), "count")).orderBy("count").collect()
    assert [tuple(r) for r in got] == [(1, "a", 10.0), (2, "b", None)]
