import hashlib
import random

import numpy as np
import pytest

from tabwright.llm import suffix_dedup
from tabwright.llm.suffix_dedup import WIDTH, Buckets, cut, digest, equal_strings, runs_of

SCHEMA = "doc_id long, text string, id string, tag long, gram long"


def brute(docs):
    """Every string of every document, looked up among those of smaller ids."""
    big = suffix_dedup.LAST
    least, out = {}, []
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - WIDTH + 1):
            s = b[k : k + WIDTH]
            least[s] = min(least.get(s, big), big if i is None else i)
    for i, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        for k in range(len(b) - WIDTH + 1):
            if least[b[k : k + WIDTH]] < (big if i is None else i):
                gone[k + 1 : k + 1 + WIDTH] = True
        edge = int((gone[1:] & ~gone[:-1]).sum())
        left = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((i, len(b), int(gone.sum()), edge, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def check(spark, docs, partitions=3):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], SCHEMA).repartition(partitions)
    assert sorted((tuple(r) for r in digest(cut(df)).collect()), key=str) == brute(docs)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 9))) for _ in range(n))


def copies(seed=5):
    """Passages, near copies and exact copies among other text."""
    rng = random.Random(seed)
    passages = [prose(rng, rng.randint(8, 60)) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages)[rng.randint(0, 40) :], prose(rng, rng.randint(0, 10))]
        docs.append([rng.randint(-50, 400), " ".join(parts)])
    for i in range(20):
        words = rng.choice(docs)[1].split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = prose(rng, 1)
        docs.append([1000 + i, " ".join(words)])
    return [tuple(d) for d in docs]


def test_against_brute_force(spark):
    check(spark, copies())


def test_many_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 500)
    monkeypatch.setattr(suffix_dedup, "TEXT_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "SPLITTERS", 40)
    check(spark, copies(6))


@pytest.mark.parametrize("bucket", [2000, 16 << 20])
def test_hot_passage(spark, monkeypatch, bucket):
    # small buckets: its grams fill several, and are compared across their boundaries
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(suffix_dedup, "TEXT_BYTES", bucket)
    rng = random.Random(bucket)
    hot = prose(rng, 30)
    docs = [(i, f"{prose(rng, 6)} {hot} {prose(rng, 6)}") for i in range(150)] + [(500 + i, hot) for i in range(50)]
    check(spark, docs)


def test_a_hot_gram_is_dealt_over_its_ranges():
    buckets = Buckets([-5, 3, 3, 3, 9], fine=2)
    gram = np.array([-9, -5, 0, 3, 3, 3, 3, 3, 3, 4, 10], np.int64)
    found = buckets.of(gram, np.arange(11))
    assert len(buckets) == 12 and buckets.hot.tolist() == [3]
    ranges = found // 2
    assert ranges[[0, 1, 2]].tolist() == [0, 0, 1] and ranges[[9, 10]].tolist() == [4, 5]
    assert set(ranges[3:9]) <= {1, 2, 3} and len(set(ranges[3:9])) > 1


def test_awkward_texts(spark):
    run = "a" * 400 + "b" * 49 + "ab" * 200
    docs = [(1, None), (2, ""), (3, "x" * 49), (4, "x" * 50), (5, "x" * 51), (4, "x" * 50), (6, run), (7, run[3:] + "c"), (8, "é漢🙂" * 30)]
    docs += [(9, "1" + "é漢🙂" * 29), (None, run), (None, "only here " * 10), (None, "only here " * 10), (-3, "y" * 200), (0, "y" * 60 + "z")]
    docs += [(6, "another text of the same id " * 4), (20, "another text of the same id " * 4)]
    check(spark, docs)


def test_long_text_in_chunks(spark, monkeypatch):
    rng = random.Random(9)
    long = prose(rng, 9000)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    check(spark, [(1, long), (2, "begins " + long[700:30000] + " ends"), (3, long[:100] + "." + long[100:])])


def test_fixtures(spark, awkward, no_docs):
    assert cut(no_docs).count() == 0
    short = awkward.where("text is null or length(text) < 1000")
    got = sorted((tuple(r) for r in digest(cut(short)).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in short.collect()])


def test_runs_cover_every_string_once():
    rng = random.Random(1)
    texts = [prose(rng, n).encode() for n in (30, 0, 3, 90, 12)] + [b"a" * 300, b"ab" * 99]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    gram, code, begin, n = runs_of(data, ends)
    covered = np.concatenate([np.arange(a, a + k) for a, k in zip(begin, n)])
    assert n.max() <= suffix_dedup.RUN
    assert covered.tolist() == [
        int(e - len(t) + k) for t, e in zip(texts, ends) for k in range(len(t) - WIDTH + 1)
    ]


def test_multikey_sort_groups_equal_strings():
    rng = random.Random(2)
    data = "".join(rng.choice("ab") for _ in range(60)) * 5 + prose(rng, 80)
    b = data.encode()
    places = np.arange(len(b) - WIDTH + 1)
    group = equal_strings(np.frombuffer(b, np.uint8), places)
    strings = [b[k : k + WIDTH] for k in places]
    assert len(set(strings)) == len(set(group.tolist())) == len(set(zip(strings, group.tolist())))
