import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from tabwright.llm.filter_audit import audit, counts, paths, text_failures

LABELS = "doc_id long, quality int, toxic int"


def run(docs, labels):
    text = F.coalesce(F.col("text"), F.lit(""))
    return audit(counts(docs, labels, text_failures(text)), "ABCDE")


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
    }


def brute(docs, labels):
    """Every order simulated, document by document."""
    marks = {}
    for i, q, t in labels:
        old = marks.get(i, (0, 0))
        marks[i] = (max(old[0], int(q == 1)), max(old[1], int(t == 1)))
    big = 1 << 62
    least = {}
    for i, text, _ in docs:
        least[text or ""] = min(least.get(text or "", big), big if i is None else i)
    parts = {}
    for i, text, part in docs:
        bad = {n for n, x in fails(text or "").items() if x}
        if (big if i is None else i) > least[text or ""]:
            bad.add("E")
        parts.setdefault(part or "", []).append((bad, *(marks.get(i, (0, 0)) if i is not None else (0, 0))))
    out, shares = {}, Counter()
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shares[part, f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(f in r[0] for r in rows) - len(gone),
                    sum(r[0] == {f} for r in rows),
                    sum(r[1] for r in gone),
                    sum(r[2] for r in gone),
                ]
    for (part, order, step), row in out.items():
        row.append(shares[part, order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(spark, docs, labels):
    rows = run(
        spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, LABELS)
    ).collect()
    assert len({tuple(r[:3]) for r in rows}) == len(rows)
    return {tuple(r[:3]): tuple(r[3:]) for r in rows}


def test_against_every_order(spark):
    long = " ".join(f"word{i}" for i in range(220))
    texts = [long, long, long + " #", "A " * 230, "a " * 230, "SHORT", "", None, " \n\t", long + "\x0b|", "été " * 201, long]
    docs = [(i, t, ["en", "de", None, ""][i % 4]) for i, t in enumerate(texts * 3)]
    docs += [(None, long, "en"), (None, "never seen", "xx"), (None, "never seen", "xx"), (3, "A " * 230, "de")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 36, 2)] + [(0, 1, 1), (0, 0, 0), (None, 1, 1), (2, None, 1), (999, 1, 1)]
    assert found(spark, docs, labels) == brute(docs, labels)


def test_one_text_of_a_third_of_all_rows(spark):
    docs = [(i, "same text" if i % 3 == 0 else f"text {i} {'#' * (i % 2)}", f"l{i % 2}") for i in range(600)]
    labels = [(i, 1, i % 2) for i in range(600)]
    assert found(spark, docs, labels) == brute(docs, labels)


def test_no_rows_and_other_columns(spark, awkward, no_docs):
    labels = spark.createDataFrame([], LABELS)
    assert run(no_docs, labels).count() == 0
    got = {tuple(r[:3]): tuple(r[3:]) for r in run(awkward, labels).collect()}
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in awkward.collect()]
    assert got == brute(docs, [])


def test_paths_count_orders():
    forward, backward = paths(5)
    assert forward[31] == backward[0] == 120
    # every order uses one edge out of each level
    for f in range(5):
        uses = sum(forward[s] * backward[s | 1 << f] for s in range(32) if not s >> f & 1)
        assert uses == 120
