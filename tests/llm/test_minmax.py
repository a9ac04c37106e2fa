import random

import numpy as np

from tabwright.llm.components import components
from tabwright.llm.minmax import PERMUTATIONS, crossing_pairs, keep_one, near_duplicates, shingle_sets, signature


def brute(rows):
    sets, parent = {}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(i, [])
        sets[i].append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
        parent[i] = i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 85 * len(x | y) for x in sets[a] for y in sets[b]):
                a_, b_ = find(a), find(b)
                parent[max(a_, b_)] = min(a_, b_)
    return {i: find(i) for i in ids}, {i: {len(s) for s in v} for i, v in sets.items()}


def changed(words, times):
    words = list(words)
    for _ in range(times):
        words[random.randrange(len(words))] = f"new{random.random()}"
    return " ".join(words)


def test_against_brute_force(spark):
    random.seed(5)
    base = [f"w{random.randrange(300)}" for _ in range(160)]
    rows = [(1000 - i, changed(base, random.randint(0, 6))) for i in range(250)]
    rows += [(2000 + i, " ".join(f"v{random.randrange(200)}" for _ in range(random.randint(1, 80)))) for i in range(100)]
    rows += [(3000 + i, t) for i, t in enumerate(["", None, " ", "one two", "One  TWO", "one two three four five"])]
    rows += [rows[0], rows[1]]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, words string, n int")
    want, sizes = brute(rows)
    got = near_duplicates(docs.repartition(5)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == want[r["doc_id"]] and r["n_shingles"] in sizes[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == want[r["doc_id"]])
    assert len(set(want.values())) > 100
    one = keep_one(docs)
    assert one.columns == docs.columns
    kept = [r["doc_id"] for r in one.collect()]
    assert len(kept) == len(set(want.values())) and {want[i] for i in kept} == set(want.values())


def test_pairs_between_the_thresholds(spark):
    random.seed(11)
    rows, between = [], 0
    for k in range(40):
        words = [f"u{k}x{random.randrange(5000)}" for _ in range(200)]
        at = 40 + k % 30
        near = words[:at] + ["n1"] + words[at + 1 : at + 60] + ["n2"] + words[at + 61 : at + 120] + ["n3"] + words[at + 121 :]
        near = near[:2] + ["n4"] + near[3:]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(near))]
        (x, y), _ = shingle_sets([rows[-2][1], rows[-1][1]])
        between += 80 <= 100 * len(np.intersect1d(x, y)) / len(np.union1d(x, y)) < 85
    assert between == 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r["kept"] for r in near_duplicates(docs, percent=85).collect())
    assert {r["doc_id"] for r in near_duplicates(docs, percent=80).where("kept").collect()} == set(range(0, 80, 2))


def test_pipeline_takes_pairs_from_80(spark):
    import corpus_pipeline

    words = [f"w{k}" for k in range(200)]
    near = [f"n{k}" if k in (2, 60, 110, 170) else w for k, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near))], "doc_id long, text string")
    assert dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "").count() == 1


def test_awkward_rows(awkward, no_docs):
    got = near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    by = {r["doc_id"]: r for r in got}
    assert by[4]["component_id"] == by[5]["component_id"] == by[6]["component_id"] == 4
    assert by[0]["n_shingles"] == 0 and by[0]["kept"] and by[None]["kept"]
    assert near_duplicates(no_docs).collect() == []


def test_signature_estimates_similarity():
    a = [f"a{i}" for i in range(2000)]
    (x, y), _ = shingle_sets([" ".join(a[:1800]), " ".join(a[200:])])
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs((signature(x) == signature(y)).mean() - true) < 4 * (true * (1 - true) / (2 * PERMUTATIONS)) ** 0.5


def test_components(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 500), (200, 201), (5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in [*range(61), 500]}, **{i: 100 for i in range(100, 150)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def linked_at(rows, percent):
    """Shingle sets, and a test of two ids."""
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}

    def linked(a, b):
        common = len(sets[a] & sets[b])
        return 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common)

    return sets, linked


def crossing(spark, sets, core, percent):
    """Candidates where the first ``core`` ids are one component and every other text stands alone."""
    code = {}
    tokens = [(i, code.setdefault(s, len(code))) for i, found in sets.items() for s in found]
    nodes = [(i, len(sets[i]), 0 if i < core else i, core if i < core else 1) for i in sets]
    pairs = crossing_pairs(
        spark.createDataFrame(nodes, "node long, n long, component long, size long"),
        spark.createDataFrame(tokens, "node long, shingle long"),
        percent,
    )
    return [(r["u"], r["v"]) for r in pairs.collect()]


def spread(words, times):
    """Words changed far from each other, so that every change costs five shingles."""
    words = list(words)
    for k in random.sample(range(len(words) // 8), times):
        words[8 * k + 4] = f"new{random.random()}"
    return " ".join(words)


def test_a_crowd_is_not_met_in_pairs(spark):
    """Two sizes of one crowd, of copies linked with the plain text only: candidates grow with the texts."""
    random.seed(3)
    base, met = [f"b{k}" for k in range(150)], []
    for size in (40, 160):
        rows = [(i, spread(base, min(i, 1))) for i in range(size)] + [(1000 + i, spread(base, 3)) for i in range(size)]
        sets, linked = linked_at(rows, 80)
        assert all(linked(0, i) for i in sets) and sum(linked(1, i) for i in sets if i >= 1000) < size / 2
        met.append(len(crossing(spark, sets, size, 80)))
    assert met[0] >= 40 and met[1] <= 2 * 160


def test_a_changed_copy_is_no_hub(spark):
    """The shortest text of the crowd is itself a changed copy: all others share what it lacks."""
    random.seed(5)
    base, met = [f"b{k}" for k in range(150)], []
    for size in (40, 160):
        rows = [(i, spread(base, min(i, 1))) for i in range(size - 1)]
        rows.append((size - 1, spread(base[:148], 3)))
        rows += [(1000 + i, spread(base, 3)) for i in range(size)]
        sets, linked = linked_at(rows, 80)
        assert all(linked(0, i) for i in sets) and sum(linked(size - 1, i) for i in sets if i >= 1000) < size / 2
        met.append(len(crossing(spark, sets, size, 80)))
    assert met[0] >= 40 and met[1] <= 2 * 160


def test_links_of_a_crowd_are_found(spark):
    """Copies of a text and of its variants, longer and shorter ones, against brute force."""
    random.seed(8)
    base = [f"b{k}" for k in range(150)]
    sides = [spread(base, 2).split() for _ in range(4)]
    core = 60
    rows = [(i, spread(base, random.randint(0, 3))) for i in range(core)]
    for i in range(100):
        words = spread(random.choice(sides), random.randint(0, 3)).split()
        rows.append((1000 + i, " ".join(words[: 150 - random.choice((0, 0, 4, 12))])))
    sets, linked = linked_at(rows, 80)
    found = []
    for pairs in (crossing(spark, sets, core, 80), [(a, b) for a in sets for b in sets if a < b]):
        parent = {i: 0 if i < core else i for i in sets}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for u, v in pairs:
            if linked(u, v):
                a, b = find(u), find(v)
                parent[max(a, b)] = min(a, b)
        found.append({i: find(i) for i in sets})
    assert found[0] == found[1] and 5 < len(set(found[0].values())) < 90
