import math
from collections import Counter
import re

import numpy as np

from tabwright.llm.common import plain_words
from tabwright.llm.divergence import CLASSES, class_counts, distance, quality, references, sparse_distance

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    runs, marked = {}, set()
    for k in range(len(words) - 7):
        runs.setdefault(tuple(words[k : k + 8]), []).append(k)
    for at in runs.values():
        if len(at) > 1:
            for k in at:
                marked.update(range(k, k + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(marked) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), failed
    )


def test_base_figures(spark, awkward, no_docs):
    extra = ["same line here\n" * 5, "a b c d e f g h " * 4, "x " * 9, "a | b\n\n \n a | b\na | b"]
    rows = [(100 + i, t, "en", "s", 1, "x", 1, "y") for i, t in enumerate(extra)]
    docs = awkward.unionByName(spark.createDataFrame(rows, awkward.schema))
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    got = quality(docs).collect()
    assert len(got) == docs.count()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for i, text in texts:
        assert base(text) in [tuple(r[n] for n in names) for r in got if r["doc_id"] == i]
    assert all(not r["kept"] for r in got if r["base_failed"])
    assert quality(no_docs).collect() == []


def test_distance_of_histograms():
    p, q = np.array([[0.5, 0.5, 0.0]]), np.array([0.25, 0.25, 0.5])
    kl = lambda a, b: sum(x * math.log2(x / y) for x, y in zip(a, b) if x)
    m = (p[0] + q) / 2
    assert math.isclose(distance(p, q)[0], math.sqrt((kl(p[0], m) + kl(q, m)) / 2))
    assert distance(np.array([[1.0, 0]]), np.array([0, 1.0]))[0] == 1
    # the same from the non-empty bins: two words of bin 0, one other
    got = sparse_distance(np.array([0]), np.array([0]), np.array([2]), np.array([3]), np.array([0.3, 0.2, 0.5]))
    assert math.isclose(got[0], distance(np.array([[2 / 3, 0, 1 / 3]]), np.array([0.3, 0.2, 0.5]))[0])


def test_references_are_exact(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    got = references(docs.repartition(7).select("lang", "text"))
    assert [g[0] for g in got] == sorted(texts)
    for lang, shares, words in got:
        all_words = [w for t in texts[lang] for w in plain_words(t)]
        tally = Counter(all_words)
        counts = {w: tally[w] for w in words}
        assert all(math.isclose(n, counts[w] / len(all_words)) for w, n in words.items())
        assert len(words) == sum(n >= len(all_words) / 500 for n in tally.values())
        kinds = class_counts([t.encode() for t in texts[lang]]).sum(0)
        assert np.allclose(shares, kinds / kinds.sum())
        assert len(shares) == len(CLASSES)


def test_verdicts(spark):
    good = "the house of the old man is by the river and the sea of the north is far from it " * 1
    rows = [(i, " ".join(f"{w}" for w in (good + f" name{i} place{i} thing{i}").split()) * 3, "en") for i in range(200)]
    rows += [(1000, "%$# @@ | ** && %% $$ ## ^^ || <> " * 10 + "the of and is it a b c d e f", "en")]
    docs = spark.createDataFrame([(i, t, l) for i, t, l in rows], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality(docs).collect()}
    assert not got[1000]["kept"] and got[1000]["class_distance"] > 0.25
    assert got[3]["class_distance"] < 0.1 and got[3]["language"] == "en"


def test_a_text_without_common_words_is_rejected(spark):
    common = "the house of old man is by river and sea north far from it".split()
    rare = lambda i, n: [f"{a}{b}" for a, b in zip("ka lo mi ne ru".split() * n, (chr(97 + (i * 7 + k) % 26) * (2 + k % 3) for k in range(n)))]
    mixed = lambda i: [w for k, r in enumerate(rare(i, 80)) for w in ([common[(i + k) % 14], r] if k % 2 else [r])]
    rows = [(i, " ".join(mixed(i)), "en") for i in range(300)]
    rows += [(1000, " ".join(f"{a}{b}" for a in ("fe", "gi", "ho", "su") for b in "abcdefghijklmnopqrstuvwxyz"), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality(docs).collect()}
    far = got[1000]
    assert not far["base_failed"] and far["class_distance"] < 0.25 and not far["kept"]
    assert all(r["kept"] or r["base_failed"] for i, r in got.items() if i < 1000)
    assert sum(r["kept"] for r in got.values()) > 200


def test_a_rare_language_is_not_judged_by_another(spark):
    latin = " ".join(f"the house of old man{k} is by river and sea{k * 7}" for k in range(12))
    greek = " ".join(f"το σπίτι του γέρου{'αβγδεζηθικλμ'[k]} είναι κοντά στο ποτάμι και τη θάλασσα{'αβγδεζηθικλμ'[k]}" for k in range(12))
    rows = [(i, f"{latin} {'word' + str(i)}", "en") for i in range(1200)] + [(5000, greek, "el")]
    rows += [(5001, "%$# @@ | ** && %% $$ ## ^^ || <> " * 10 + "the of and is it a b c d e f", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert [lang for lang, _, _ in references(docs.select("lang", "text"))] == ["en"]
    got = {r["doc_id"]: r for r in quality(docs).collect()}
    assert got[5000]["kept"] and not got[5000]["base_failed"] and got[5000]["class_distance"] > 0.25
    assert got[3]["kept"] and not got[5001]["kept"]
