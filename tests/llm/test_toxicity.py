import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tabwright.llm.toxicity import keep_clean, learn, remainder, score, strings, stretches, windows


def corpus(n, seed=3):
    random.seed(seed)
    syllables = "ka lo mi ne ru ta vo sen dar pol tis gra".split()
    words = ["".join(random.choices(syllables, k=random.randint(1, 4))) for _ in range(2000)]
    rows = []
    for i in range(n):
        text = random.choices(words, k=random.randint(60, 200))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                text.insert(random.randrange(len(text)), random.choice(("dreckskerl", "vollpfosten", "blödmann")))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(600)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in score(docs, learn(docs, labels)).withColumn("r", remainder(F.col("doc_id"))).collect()}
    held = [r for r in rows if got[r[0]]["r"] == 0]
    right = sum(got[i]["predicted"] == y for i, _, y in held)
    assert len(held) > 80 and right >= 0.95 * len(held)
    clean = {r["doc_id"] for r in keep_clean(docs, learn(docs, labels)).collect()}
    assert clean == {i for i in got if got[i]["predicted"] == 0}


def test_a_dominant_language_hides_no_other(spark):
    random.seed(8)
    syllables = "ka lo mi ne ru ta vo sen dar pol tis gra".split()
    words = ["".join(random.choices(syllables, k=random.randint(2, 4))) for _ in range(2000)]
    # strong and few marks in most texts; another language has many weak ones made of its own syllables
    strong, weak = ("dreckskerl", "vollpfosten"), ["".join(w) for w in zip(["polgra"] * 40, random.sample(words, 40))]
    rows = []
    for i in range(1600):
        rare, toxic = i % 8 == 0, i % 16 in (0, 1, 3, 5, 7)
        text = random.choices(words, k=random.randint(60, 160))
        for w in random.sample(weak, 6) if rare and toxic else random.choices(strong, k=4) if toxic else []:
            text.insert(random.randrange(len(text)), w)
        rows.append((i, " ".join(text), int(toxic), rare))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in score(docs, learn(docs, labels)).withColumn("r", remainder(F.col("doc_id"))).collect()}
    held = [r for r in rows if got[r[0]]["r"] == 0]
    for part in ([r for r in held if r[3] and r[2]], [r for r in held if not r[3] and r[2]], [r for r in held if not r[2]]):
        assert len(part) > 10 and sum(got[r[0]]["predicted"] == r[2] for r in part) >= 0.9 * len(part)


def test_windows_cover_every_word():
    text = " ".join(f"w{i}" for i in range(300)) + " " + "x" * 500
    found = b" ".join(windows(text)).split()
    assert {f"w{i}".encode() for i in range(300)} <= set(found)
    assert windows("") == [] and len(windows("one")) == 1


def test_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(3, 1), (4, 0), (4, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    for model in (learn(awkward, labels), learn(no_docs, labels.limit(0))):
        got = score(awkward, model).collect()
        assert len(got) == awkward.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
        assert keep_clean(awkward, model).columns == awkward.columns
        assert score(no_docs, model).collect() == []


def held_out(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = score(docs, learn(docs, labels)).withColumn("r", remainder(F.col("doc_id"))).collect()
    return {r["doc_id"]: r["predicted"] for r in got if r["r"] == 0}


def test_stems_in_compounds_that_were_never_seen(spark):
    rng = random.Random(11)
    syllables = "ka lo mi ne ru ta vo sen dar pol tis gra".split()
    words = ["".join(rng.choices(syllables, k=rng.randint(2, 4))) for _ in range(2000)]
    rows, used = [], set()
    for i in range(1000):
        text, toxic = rng.choices(words, k=rng.randint(40, 120)), i % 3 == 0
        for _ in range(4 if toxic else 0):
            # no compound occurs twice in the whole corpus
            while (w := rng.choice(("dreck", "schurk")) + "".join(rng.choices(syllables, k=3))) in used:
                pass
            used.add(w)
            text.insert(rng.randrange(len(text)), w)
        rows.append((i, " ".join(text), int(toxic)))
    found = held_out(spark, rows)
    for y in (0, 1):
        part = [i for i, _, label in rows if i in found and label == y]
        assert len(part) > 30 and sum(found[i] == y for i in part) >= 0.95 * len(part)


def test_equal_texts_with_opposite_labels_count_as_toxic(spark):
    rows = corpus(400)
    learnt = [(i, t) for i, t, y in rows if y and zlib.crc32(str(i).encode()) % 5]
    # every toxic text that is learnt from again, marked as ordinary, also where it is learnt from
    ids = (i for i in range(1000, 9000) if zlib.crc32(str(i).encode()) % 5)
    both = rows + [(next(ids), t, 0) for _, t in learnt]
    found = held_out(spark, both)
    part = [i for i, _, y in rows if i in found and y == 1]
    assert len(part) > 10 and sum(found[i] for i in part) >= 0.9 * len(part)


def test_strings_and_stretches():
    text = b" abc dreckskerl xyz "
    marks = {5: np.sort(strings(b"dreck", 5))}
    assert stretches(text, marks) == [b"dreck"]
    assert len(strings(text, 5)) == len(text) - 4 and len(strings(b"abc", 5)) == 0
