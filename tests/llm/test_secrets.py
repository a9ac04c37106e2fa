import random
import re

from tabwright.llm.secrets import RUN, lexicon, redact, scan


def hexes(n):
    return "".join(random.choice("0123456789abcdef") for _ in range(n))


def corpus():
    random.seed(6)
    words = "the server was started again with new settings for every region and the team".split()
    rows, secrets = [], {}
    for i in range(200):
        text = random.choices(words, k=40)
        kind = i % 4
        value = None
        if kind == 0:
            value = hexes(random.choice((18, 32, 40)))
            text.insert(20, random.choice((f"password={value}", f'token = "{value}"', f"api_key: {value}")))
        elif kind == 1:
            value = "AKIA" + "".join(random.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(15)) + "7"
            text.insert(20, value)
        elif kind == 2:
            text.insert(20, f"commit {hexes(40)}")
        else:
            text.insert(20, "".join(random.choice("0123456789") for _ in range(16)))
        if value:
            secrets[i] = value
        rows.append((i, " ".join(text), "src", len(" ".join(text))))
    return rows, secrets


def test_finds_secrets_and_drops_digests(spark):
    rows, secrets = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    got = scan(docs).collect()
    texts = {r[0]: r[1] for r in rows}
    assert all(texts[r["doc_id"]][r["start"] : r["start"] + r["length"]] == r["run"] for r in got)
    assert {r["doc_id"] for r in got} == set(texts)
    assert {r["doc_id"]: r["run"] for r in got if r["secret"]} == secrets
    clean = {r["doc_id"]: r for r in redact(docs, chars_col="n_chars").collect()}
    for i, text in texts.items():
        want = text.replace(secrets[i], "[secret]") if i in secrets else text
        assert clean[i]["text"] == want and clean[i]["n_chars"] == len(want)


def test_learns_from_given_labels(spark):
    rows, secrets = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    # reviewers who call commits secret are believed
    seen = [(r[2], " ".join(r[1].split()[:20]) + " commit ", hexes(40), " then", 1.0) for r in rows]
    seen += [(r[2], " ".join(r[1].split()[:20]) + " ", "4" + "".join(random.choices("0123456789", k=15)), " then", 0.0) for r in rows]
    labelled = spark.createDataFrame(seen, "path string, before string, run string, after string, label double")
    got = {r["doc_id"]: r["secret"] for r in scan(docs, labelled).collect()}
    assert all(got[i] for i in range(2, 200, 4)) and not any(got[i] for i in range(3, 200, 4))


def test_awkward_rows(spark, awkward, no_docs):
    key = "AKIA" + "ABCD2345EFGH6789"
    texts = [f"é漢🙂 {key} {key}", f"{key}", "x" * 100_000 + "1", ("1a" * 9 + " ") * 3000]
    more = spark.createDataFrame([(70 + i, t, None, None, None, key, 1, None) for i, t in enumerate(texts)], awkward.schema)
    docs = awkward.unionByName(more).unionByName(more.limit(1))
    whole = {(r["doc_id"], r["text"]) for r in docs.collect()}
    got = scan(docs).collect()
    for i, t in whole:
        assert {m.start() for m in re.finditer(RUN, t or "")} == {r["start"] for r in got if r["doc_id"] == i} or i is None
    out = redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    by = {r["doc_id"]: r["text"] for r in out.collect()}
    for i, t in whole:
        found = {r["run"] for r in got if r["doc_id"] == i and r["secret"]}
        want = t
        for run in found:
            want = want.replace(run, "[secret]")
        assert i is None or by[i] == want
    assert by[0] is None and by[1] == ""
    assert scan(no_docs).collect() == [] and redact(no_docs).collect() == []


def test_words_are_counted_over_all_texts(spark):
    """Texts of any length and any number of them, and no word that is rare beside their number."""
    rows = [(0, "zebrafish " * 3_000), (1, None)] + [(i, "ordinary words") for i in range(2, 2_900)]
    rows[5] = (5, "rareword rareword ordinary")
    words, pairs = lexicon(spark.createDataFrame(rows, "row long, text string").repartition(4))
    assert {r["word"] for r in words.collect()} == {"zebrafish", "ordinary", "words", "rareword"}
    more = [(i, "ordinary words") for i in range(2_900, 6_000)]
    words, _ = lexicon(spark.createDataFrame(rows + more, "row long, text string").repartition(4))
    assert {r["word"] for r in words.collect()} == {"zebrafish", "ordinary", "words"}
    assert "eb" in pairs
