import hashlib
import re

import numpy as np

from tabwright.llm import decontaminate
from tabwright.llm.decontaminate import contamination, digest, keep_clean

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(10, len(iw))
        for k in range(len(iw) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == iw[k : k + n]:
                    hit.update(range(i, i + n))
                    found.add(str(item))
    sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), sha, bool(hit)


ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "short item"),
    (3, "Única"),
    (10, "beta gamma delta epsilon zeta eta theta iota kappa lambda nu xi"),
    (4, None),
    (5, " ... "),
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (6, "a a a a a a a a a a a"),
]
TEXTS = [
    "x alpha BETA gamma, delta epsilon zeta eta theta iota kappa lambda mu y",
    "alpha beta gamma delta epsilon zeta eta theta iota",
    "a short-item; short item item short",
    "única ÚNICA",
    "a " * 25,
    "beta gamma delta epsilon zeta eta theta iota kappa lambda nu xi alpha beta",
]


def test_against_brute_force(spark, awkward, no_docs, monkeypatch):
    docs = awkward.unionByName(
        spark.createDataFrame([(50 + i, t, None, None, None, None, None, None) for i, t in enumerate(TEXTS)], awkward.schema)
    )
    bench = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, n_words int")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted((i if i is not None else -1, *brute(t, ITEMS)) for i, t in texts)
    for size in (decontaminate.BLOCK_BYTES, 60):  # one block, and many
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        got = [tuple(r) for r in digest(contamination(docs, bench)).collect()]
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == want
        clean = keep_clean(docs, bench)
        assert clean.columns == docs.columns
        assert clean.count() == sum(not w[-1] for w in want)
    assert digest(contamination(no_docs, bench)).collect() == []
    nothing = digest(contamination(docs, bench.limit(0))).collect()
    assert len(nothing) == len(texts) and not any(r["contaminated"] for r in nothing)


def test_items_without_id_mark_words_but_have_no_name(spark):
    docs = spark.createDataFrame([(1, "a secret passage here"), (2, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "secret passage"), (7, "here")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in digest(contamination(docs, bench)).collect()}
    assert got == {1: (3, 1), 2: (0, 0)}
    assert [r["doc_id"] for r in keep_clean(docs, bench).collect()] == [2]


def test_shingles_of_more_words_than_64_bits_can_number():
    block = decontaminate.Block.build([("x", " ".join(f"w{i}" for i in range(30)))], 10)
    block.vocab |= {f"more{i}".encode(): 100 + i for i in range(4_000_000)}
    keys = [k for k, _, _ in block.shingles(block.windows[-1])]
    codes = np.array(block.windows[-1], np.int32)
    at, _ = block.positions(codes, 3, np.array(sorted(keys), np.int64))
    assert at.tolist() == list(range(8))
