import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import hard_negatives
from tabwright.llm.hard_negatives import mine, narrowed

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, id string"


def relabelled():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def brute(rows, every=100):
    seen = {}
    for i, v, l in rows:
        if i is None or v is None or l is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        l = (l + 1) % 10 if i % 7 == 0 else l
        seen[i] = min(seen.get(i, (l, q)), (l, q))
    out = []
    for a, (la, qa) in seen.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(qa, q)) for i, (_, q) in seen.items() if len(q) == len(qa) and i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if seen[i][0] == la][:5]:
            fits = [
                i for i in order if seen[i][0] != la and 30 * score[p] <= 100 * score[i] <= 90 * score[p]
            ]
            out += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(fits[:10], 1)]
    return sorted(out)


def check(spark, rows, every=100):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in mine(df, relabelled(), F.col("id") % every == 0).collect())
    assert got == brute(rows, every)
    return got


def vectors(n, dim, seed=1, groups=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    label = rng.integers(0, groups, n)
    return [(i, (centres[c] + rng.normal(size=dim)).tolist(), int(c)) for i, c in enumerate(label)]


def test_against_brute_force(spark, monkeypatch):
    # many blocks and cells
    monkeypatch.setattr(hard_negatives, "ROWS", 37)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 5)
    assert check(spark, vectors(700, 24), every=20)


def test_awkward_rows(spark):
    rows = vectors(150, 8)
    same = [1.0] * 8
    rows += [(i, same, i % 3) for i in range(200, 260)]  # one very common vector: ties
    rows += [rows[3], rows[100]]  # repeated rows
    rows += [(500, None, 1), (501, same, None), (None, same, 1), (502, [1.0, None], 2), (503, [float("nan")] * 8, 1)]
    rows += [(504, [float("inf")] * 8, 1), (600, [1.0, 2.0], 1), (601, [1.0, 1.5], 1), (602, [0.5, 0.5], 2), (700, [], 1), (701, [], 1), (702, [], 2)]
    rows += [(800, [-1.0] * 8, 9)]
    assert check(spark, rows, every=10)


def test_same_id_with_other_content(spark):
    rows = vectors(60, 4) + [(10, [9.0, 9.0, 9.0, 9.0], 3), (10, [0.0, 0.0, 0.0, 0.0], 1)]
    assert check(spark, rows, every=10)


def test_no_rows(spark):
    assert mine(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_bounds_drop_no_answer(seed):
    rng = np.random.default_rng(seed)
    columns = rng.integers(-300, 300, (20, 500))
    vector = rng.integers(-300, 300, 20)
    exact = vector @ columns
    bar = np.sort(exact)[-7]
    looked = []

    def ask(least, most):
        looked.append(len(least))
        return most >= bar

    rows, scores = narrowed(vector, columns, columns.min(1), columns.max(1), np.arange(500), ask)
    assert sorted(rows) == sorted(np.flatnonzero(exact >= bar)) and (scores == exact[rows]).all()
    assert looked[-1] < 500
