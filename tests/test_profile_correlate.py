import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.functions.bivariate import block_sums, expected_sums, level_sums, normal_cdf
from tabwright.operators import correlate, profile


def tau_b(x, y):
    """All pairs of rows compared."""
    keep = ~(np.isnan(x) | np.isnan(y))
    x, y = x[keep], y[keep]
    s = ties_x = ties_y = 0
    for i in range(len(x)):
        for j in range(i):
            a, b = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
            s += a * b
            ties_x += a == 0
            ties_y += b == 0
    n0 = len(x) * (len(x) - 1) / 2
    return s / math.sqrt((n0 - ties_x) * (n0 - ties_y))


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(7)
    frame = pd.DataFrame({"a": rng.normal(size=160).round(1), "b": rng.integers(0, 40, 160).astype(float)})
    frame["c"] = (frame["a"] * 2 + rng.normal(size=160)).round(2)
    frame.loc[::7, "a"] = np.nan
    frame.loc[::11, "c"] = np.nan
    frame["d"] = np.where(np.arange(160) < 60, 0.0, frame["b"] * 1000 + np.arange(160))
    return frame


def by_pair(df, name):
    return {(r["left_col"], r["right_col"]): r[name] for r in df.collect()}


@pytest.mark.parametrize("slices", [1, 5])
def test_rank_correlations_over_complete_pairs(spark, numbers, slices):
    df = spark.createDataFrame(numbers)
    columns = list(numbers)
    rho = by_pair(correlate.spearman(df, columns, slices), "spearman")
    tau = by_pair(correlate.kendall(df, columns, slices), "kendall")
    r = by_pair(correlate.pearson(df, columns), "pearson")
    for (a, b), value in tau.items():
        both = numbers[[a, b]].dropna()
        assert value == pytest.approx(tau_b(numbers[a].to_numpy(), numbers[b].to_numpy()))
        assert rho[a, b] == pytest.approx(both.rank().corr().iloc[0, 1])
        assert r[a, b] == pytest.approx(both.corr().iloc[0, 1])
    assert len(tau) == len(rho) == len(r) == 6


@pytest.mark.parametrize("slices", [None, 2, 9, 60])
def test_kendall_sends_every_row_once_per_column(spark, slices, monkeypatch):
    """Few values, one that fills most of a column, gaps and infinite numbers, in many slices; no row is
    laid out more often than there are pairs."""
    asked = []
    constants = correlate.constants
    monkeypatch.setattr(correlate, "constants", lambda v: asked.append(v) or constants(v))
    rng = np.random.default_rng(5)
    n = 300
    values = np.stack(
        [rng.normal(size=n), rng.integers(0, 4, n), np.where(rng.random(n) < 0.7, 0, rng.normal(size=n)), rng.integers(0, 40, n)]
    ).T
    values[rng.random(values.shape) < 0.1] = np.nan
    values[:3, 0], values[3:6, 0] = np.inf, -np.inf
    df = spark.createDataFrame(pd.DataFrame(values, columns=list("abcd")))
    got = by_pair(correlate.kendall(df, list("abcd"), slices), "kendall")
    assert len(got) == 6 and all(len(v) <= 6 for v in asked if isinstance(v, range))
    for (a, b), value in got.items():
        # ranks, as infinite numbers have no difference
        x, y = (pd.Series(values[:, "abcd".index(c)]).rank().to_numpy() for c in (a, b))
        assert value == pytest.approx(tau_b(x, y))


def test_a_column_agrees_with_itself_and_its_reverse(spark):
    df = spark.createDataFrame([(float(i % 50), -float(i % 50)) for i in range(400)], "x double, y double")
    df = df.selectExpr("x", "x as same", "y")
    tau = by_pair(correlate.kendall(df, ["x", "same", "y"]), "kendall")
    assert tau["x", "same"] == pytest.approx(1) and tau["x", "y"] == pytest.approx(-1)
    swapped = by_pair(correlate.kendall(df, ["y", "x"]), "kendall")
    assert swapped["y", "x"] == pytest.approx(tau["x", "y"])


def test_columns_that_do_not_vary_or_never_meet_give_null(spark):
    rows = [(1.0, float(i), None if i % 2 else 1.0 * i, 1.0 * i if i % 2 else None) for i in range(10)]
    df = spark.createDataFrame(rows, "flat double, x double, even double, odd double")
    for values in (
        by_pair(correlate.pearson(df, df.columns), "pearson"),
        by_pair(correlate.spearman(df, df.columns), "spearman"),
        by_pair(correlate.kendall(df, df.columns), "kendall"),
    ):
        assert values["flat", "x"] is None and values["even", "odd"] is None
        assert values["x", "even"] == pytest.approx(1)


def test_cramers_v_and_degenerate_tables(spark):
    df = spark.createDataFrame(
        [("a", "u", "k"), ("a", "u", "k"), ("b", "v", "k"), ("c", "v", "k")], "x string, y string, z string"
    )
    v = by_pair(correlate.cramers_v(df, ["x", "y", "z"]), "cramers_v")
    assert v["x", "y"] == pytest.approx(1) and v["x", "z"] is None
    corrected = by_pair(correlate.cramers_v(df, ["x", "y"], bias_correction=True), "cramers_v")
    assert 0 <= corrected["x", "y"] <= 1


def test_normal_distribution_function():
    z = np.linspace(-8.5, 8.5, 4001)
    exact = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])
    assert np.abs(normal_cdf(z) - exact).max() < 1e-13


def test_sums_over_blocks_add_up():
    ends = np.cumsum([0.1, 0.3, 0.05, 0.25, 0.3])
    x = np.stack([np.append(0, ends[:-1]), ends], axis=1)
    y = np.array([[0, 0.4], [0.4, 0.7], [0.7, 1.0]])
    rhos = np.array([0.0, 0.5, 0.99, 1.0])
    whole = block_sums(x, y, rhos)
    parts = sum(block_sums(a, b, rhos) for a in (x[:2], x[2:]) for b in (y[:1], y[1:]))
    assert whole == pytest.approx(parts, rel=1e-9)
    assert whole[0] == pytest.approx(1, abs=1e-9) and (np.diff(whole) > 0).all()


@pytest.mark.parametrize("rho", [0.0, 0.3, 0.6, 0.9])
def test_phi_k_recovers_a_normal_correlation(spark, rho):
    rng = np.random.default_rng(3)
    x = rng.normal(size=20_000)
    y = rho * x + math.sqrt(1 - rho * rho) * rng.normal(size=20_000)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).persist()
    found = [by_pair(correlate.phi_k(df, ["x", "y"], [], bins), "phi_k")["x", "y"] for bins in (10, 20, 40)]
    assert found == pytest.approx([found[0]] * 3, abs=0.04)
    assert found[0] == pytest.approx(rho, abs=0.04)


@pytest.mark.parametrize("rho", [0.0, 0.3, 0.6, 0.9])
def test_phi_k_does_not_depend_on_the_bins(spark, rho):
    rng = np.random.default_rng(3)
    x = rng.normal(size=20_000)
    y = rho * x + math.sqrt(1 - rho * rho) * rng.normal(size=20_000)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).persist()
    found = [by_pair(correlate.phi_k(df, ["x", "y"], [], bins), "phi_k")["x", "y"] for bins in (10, 20, 40)]
    # chi-square rises with the square: of no correlation it tells little
    assert found == pytest.approx([rho] * 3, abs=0.02 if rho else 0.06)


def test_separable_sums_equal_the_direct_ones():
    rng = np.random.default_rng(1)
    x, y = (np.append(0, np.cumsum(w / w.sum())) for w in (rng.random(7), rng.random(12)))
    x, y = (np.stack([e[:-1], e[1:]], axis=1) for e in (x, y))
    rhos = np.array([0.0, 0.4, 0.8, 0.95])
    two, one = expected_sums(level_sums(x[:3]) + level_sums(x[3:]), level_sums(y), rhos)
    assert two == pytest.approx(block_sums(x, y, rhos), rel=2e-3)
    assert one[0] == pytest.approx(7 * 12)


def test_phi_k_of_columns_of_many_levels_ends(spark):
    rows = spark.range(300_000)
    df = rows.select(
        F.format_string("a%06d", F.col("id") % 100_000).alias("a"),
        F.format_string("b%06d", F.col("id") % 100_000).alias("b"),
        F.format_string("c%06d", F.xxhash64("id") % 50_000).alias("c"),
    )
    found = by_pair(correlate.phi_k(df, [], ["a", "b", "c"]), "phi_k")
    assert found["a", "b"] == pytest.approx(1)
    assert found["a", "c"] is None or found["a", "c"] < 0.1


def test_phi_k_keeps_every_column(spark):
    rows = [(float(i % 50), f"g{i % 3}", f"w{i % 101}", f"id{i}", "one", i % 7 == 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "n double, g string, wide string, id string, one string, flag boolean")
    found = by_pair(correlate.phi_k(df, ["n"], ["g", "wide", "id", "one", "flag"], block=40), "phi_k")
    assert len(found) == 15
    assert found["n", "g"] == pytest.approx(0, abs=0.1)
    assert all(v is None for pair, v in found.items() if "one" in pair)
    same = correlate.phi_k(df.withColumn("again", F.col("g")), [], ["g", "again"])
    assert by_pair(same, "phi_k")["g", "again"] == pytest.approx(1)


def test_binned_kendall_is_exact_where_bins_hold_one_value_each(spark):
    rng = random.Random(12)
    rows = [(float(rng.randrange(6)), float(rng.randrange(5)), None if k % 9 == 0 else float(rng.randrange(4)), 1.0) for k in range(400)]
    df = spark.createDataFrame(rows, "a double, `b.c` double, d double, one double")
    names = ["a", "b.c", "d", "one"]
    exact = by_pair(correlate.kendall(df, names), "kendall")
    found = correlate.kendall_binned(df, names, bins=64)
    assert found.where("binned").count() == 6
    got = by_pair(found, "kendall")
    assert got == {k: v if v is None else pytest.approx(v) for k, v in exact.items()}


NAMES = ["all", "a", "b", "a_b", "count", "copies", "_n", "x.y", "pair", "slice", "value"]


def test_every_column_name_gives_the_same_figures(spark):
    rng = np.random.default_rng(11)
    values = rng.integers(0, 9, (120, len(NAMES))).astype(float)
    values[rng.random(values.shape) < 0.1] = np.nan
    plain = [f"k{i}" for i in range(len(NAMES))]
    one = spark.createDataFrame(pd.DataFrame(values, columns=plain))
    two = spark.createDataFrame(pd.DataFrame(values, columns=NAMES))
    back = dict(zip(NAMES, plain))
    for function in (correlate.pearson, correlate.spearman, correlate.kendall, correlate.missing_correlation):
        a, b = function(one, plain), function(two, NAMES)
        figure = a.columns[-1]
        want = by_pair(a, figure)
        got = {(back[p], back[q]): v for (p, q), v in by_pair(b, figure).items()}
        assert got == pytest.approx(want, nan_ok=True), function.__name__
    for function in (correlate.cramers_v, correlate.phi_k):
        a, b = function(one, plain, []), function(two, NAMES, [])
        if function is correlate.cramers_v:
            a, b = function(one, [], plain), function(two, [], NAMES)
        figure = a.columns[-1]
        got = {(back[p], back[q]): v for (p, q), v in by_pair(b, figure).items()}
        assert got == pytest.approx(by_pair(a, figure)), function.__name__
    assert profile.duplicate_groups(two.unionAll(two)).count() == profile.duplicate_groups(one.unionAll(one)).count()
    counts = lambda df, c: {(r["bin"], r["n"]) for r in profile.histogram(df, [c]).collect()}
    assert all(counts(two, n) == counts(one, p) for n, p in zip(NAMES, plain))


def test_infinite_values_are_counted_apart(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("inf"),), (float("-inf"),), (None,)], "x double")
    found = {r["bin"]: r["n"] for r in profile.histogram(df, ["x"], bins=2).collect()}
    assert found == {-1: 1, 0: 1, 1: 2, 2: 1}


def test_numeric_stats_of_awkward_columns(spark):
    rows = [(1.0, None, 2), (float("nan"), None, 2), (-3.0, None, 2), (0.0, None, None)]
    df = spark.createDataFrame(rows, "x double, nothing double, k int")
    found = {r["column"]: r for r in profile.numeric_stats(df, ["x", "nothing", "k"]).collect()}
    x = found["x"]
    assert (x["count"], x["missing"], x["distinct"], x["zeros"], x["negatives"]) == (3, 1, 3, 1, 1)
    assert (x["min"], x["max"], x["mad"]) == (-3.0, 1.0, 1.0)
    assert found["nothing"]["count"] == 0 and found["nothing"]["mean"] is None
    assert found["k"]["variance"] == 0 and found["k"]["skewness"] is None


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x double, s string, ts timestamp_ntz")
    row = profile.overview(df).first()
    assert (row["rows"], row["missing_share"], row["duplicate_rows"]) == (0, 0.0, 0)
    assert profile.numeric_stats(df, ["x"]).count() <= 1
    assert profile.histogram(df, ["x"]).count() == 0
    assert profile.categorical_stats(df, ["s"]).count() == 0
    assert profile.duplicate_groups(df).count() == 0


@pytest.mark.parametrize("slices", [1, 6])
def test_quantiles_like_pandas(spark, numbers, slices):
    df = spark.createDataFrame(numbers)
    found = {r["column"]: r for r in profile.numeric_quantiles(df, list(numbers), slices).collect()}
    for c in numbers:
        for name, p in profile.QUANTILES.items():
            assert found[c][name] == pytest.approx(numbers[c].quantile(p))


def test_duplicates_count_null_as_equal(spark):
    rows = [(1, None), (1, None), (1, "a"), (None, "a"), (1, None), (None, "a")]
    df = spark.createDataFrame(rows, "i int, s string")
    found = {(r["i"], r["s"]): r["copies"] for r in profile.duplicate_groups(df).collect()}
    assert found == {(1, None): 3, (None, "a"): 2}
    assert profile.overview(df).first()["duplicate_rows"] == 3
    assert [r["copies"] for r in profile.top_duplicates(df, 1).collect()] == [3]


def test_histogram_of_a_constant_and_a_missing_value(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 10.0), (None, 9.0)], "flat double, x double")
    found = {(r["column"], r["bin"]): r["n"] for r in profile.histogram(df, ["flat", "x"], 5).collect()}
    assert found == {("flat", 0): 2, ("x", 0): 1, ("x", 4): 2}


def test_alerts_name_what_is_odd(spark):
    rows = [(i, 1.0, 0.0 if i < 50 else float(i), "same" if i else "rare", f"v{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "key int, flat double, z double, s string, u string")
    found = {(r["column"], r["alert"]) for r in profile.alerts(df, ["key", "flat", "z"], ["s", "u"]).collect()}
    assert {
        ("key", "unique"),
        ("flat", "constant"),
        ("z", "zeros"),
        ("s", "imbalance"),
        ("u", "high_cardinality"),
        ("u", "unique"),
        ("key x z", "high_correlation"),
    } <= found


def test_text_and_time_columns(spark):
    from datetime import datetime

    df = spark.createDataFrame(
        [("é", datetime(2024, 1, 1)), ("abc", datetime(2024, 1, 2, 0, 0, 1)), (None, None)],
        "s string, ts timestamp_ntz",
    )
    text = profile.text_lengths(df, ["s"]).first()
    assert (text["min_length"], text["max_length"], text["median_length"]) == (1, 3, 2.0)
    time = profile.datetime_stats(df, ["ts"]).first()
    assert (time["missing"], time["range_seconds"]) == (1, 86401.0)


def test_a_report_has_every_section(spark, tiny):
    from tabwright.sources.fixtures import table

    orders = table(spark, tiny, "orders")
    sections = profile.report(orders, ["o_orderkey"])
    expected = {
        "overview", "missing", "missing_correlation", "numbers", "quantiles", "histogram",
        "categories", "top_values", "text_lengths", "times", "duplicates", "sample", "auto",
        "pearson", "spearman", "kendall", "cramers", "phi_k", "interactions", "alerts",
    }
    assert set(sections) == expected
    assert {r["column"] for r in sections["numbers"].collect()} == {"o_orderkey", "o_custkey", "o_totalprice"}
    pairs = {(r["left_col"], r["right_col"]) for r in sections["auto"].collect()}
    assert ("o_custkey", "o_totalprice") in pairs and len(pairs) == 6
    assert sections["sample"].count() == 20


def test_a_report_of_one_column(spark):
    sections = profile.report(spark.createDataFrame([("a",), ("b",), ("a",)], "s string"), ["s"])
    assert sections["overview"].first()["duplicate_rows"] == 1
    assert {tuple(r) for r in sections["alerts"].collect()} == set()
    for name in ("auto", "pearson", "spearman", "kendall", "cramers", "phi_k", "missing_correlation"):
        assert sections[name].count() == 0


def test_pairs_are_counted_and_correlated_in_blocks_of_rows(spark, monkeypatch):
    """Far fewer rows than rows times pairs leave the tasks, and blocks add up to the whole."""
    from tabwright.functions import blocks
    from tabwright.operators import pairs as pairs_of

    monkeypatch.setattr(blocks, "ROWS", 7_000)
    df = spark.range(0, 30_000, 1, 2).selectExpr(
        "if(id % 11 = 0, null, cast(id % 5 as string)) as a",
        "concat('v', id % 3) as b",
        "cast(1e9 + (id * 7919) % 10007 as double) as x",
        "if(id % 4 = 0, null, cast(id as double)) as y",
        "cast(0.1 as double) as z",
    )
    rows = df.toPandas()
    cells = pairs_of.pair_counts(df, {c: F.col(c) for c in ("a", "b")}, [("a", "b")])
    expected = rows.dropna(subset=["a"]).groupby(["a", "b"]).size().to_dict()
    assert {(r["x"], r["y"]): r["n"] for r in cells.collect()} == expected
    assert "Generate" not in cells._jdf.queryExecution().executedPlan().toString()
    found = {(r["left_col"], r["right_col"]): r["pearson"] for r in correlate.pearson(df, ["x", "y", "z"]).collect()}
    both = rows.dropna(subset=["y"])
    assert abs(found["x", "y"] - np.corrcoef(both["x"], both["y"])[0, 1]) < 1e-9
    assert found["x", "z"] is None and found["y", "z"] is None
