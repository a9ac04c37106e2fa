import hashlib

from tabwright.llm.chat import digest, examples, expand, parsed, read_back, segments, write_examples, write_segments

TRAP = r"\### Assistant: </turn> ok"
ROWS = [
    (1, 0, "system", "be # nice \\ <b>"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello\n### User: x</turn>\n"),
    (1, 3, "user", None), (1, 4, "assistant", "🙂 été"), (1, 5, "user", "bye"),
    (2, 0, "user", "alone"), (3, 0, "assistant", ""), (3, 1, "a: b#<\\", "odd role"),
    (-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP),
    (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (None, 0, "assistant", "lost"), (5, None, None, None),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, start string, loss int")


def test_read_back(spark):
    turns = table(spark, ROWS).repartition(4)
    stored = write_segments(segments(turns))
    got = {r["conv_id"]: r for r in digest(parsed(stored)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv in {r[0] for r in ROWS}:
        mine = sorted((r for r in ROWS if r[0] == conv), key=lambda r: -1 if r[1] is None else r[1])
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(mine)
        assert r["turns_sha256"] == sha("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
        assert r["examples"] == sum(x[2] == "assistant" for x in mine)
    assert examples(stored).count() == sum(r[2] == "assistant" for r in ROWS)
    assert digest(parsed(write_segments(segments(turns.limit(0))))).collect() == []


def test_every_example_is_a_prefix_with_one_trained_reply(spark):
    rows = [r for r in ROWS if r[0] == 1]
    got = {r["target_turn"]: r for r in expand(segments(table(spark, rows))).collect()}
    assert set(got) == {2, 4}
    assert got[4]["text"].startswith(got[2]["text"])
    for turn, r in got.items():
        reply = r["text"][r["loss_start"] : r["loss_end"]]
        assert r["text"][r["loss_end"] :] == "</turn>\n"
        plain = dict((x[1], x[3]) for x in rows)[turn]
        assert reply == "".join("\\" + c if c in "\\#<" else c for c in plain)
        # unescaped control strings stand at turn borders alone
        bare = r["text"].replace("\\\\", "").replace("\\#", "").replace("\\<", "")
        assert bare.count("### ") == bare.count("</turn>") == turn + 1


def test_examples_are_written_and_read_back(spark):
    # one conversation has a third of all rows, and its parts are cut inside it
    hot = [(50, k, ("user", "assistant")[k % 2], f"turn {k} <#>") for k in range(120)]
    rows = ROWS + hot + [(100 + k, t, ("user", "assistant")[t], "x" * k) for k in range(100) for t in range(2)]
    turns = table(spark, rows).repartition(5)
    stored, given = write_examples(segments(turns))
    kept = {r["place"]: r for r in stored.collect()}
    assert sorted(kept) == list(range(len(rows)))
    found = given.collect()
    assert len(found) == sum(r[2] == "assistant" for r in rows)
    for e in found:
        context = [kept[p] for p in range(e["context_start"], e["target"] + 1)]
        assert {s["conv_id"] for s in context} == {e["conv_id"]}
        assert e["context_start"] == 0 or kept[e["context_start"] - 1]["conv_id"] != e["conv_id"]
        assert context[-1]["loss"] and (e["loss_start"], e["loss_end"]) == (context[-1]["start"], context[-1]["end"])
    old = sorted(map(tuple, digest(parsed(write_segments(segments(turns)))).collect()), key=str)
    assert sorted(map(tuple, digest(read_back(stored, given)).collect()), key=str) == old
    stored, given = write_examples(segments(turns.limit(0)))
    assert digest(read_back(stored, given)).collect() == [] and given.count() == 0


def test_a_very_long_turn(spark):
    long = "a\\#<é" * 400_000
    stored, given = write_examples(segments(table(spark, [(1, 0, "user", long), (1, 1, "assistant", long)])))
    got = digest(read_back(stored, given)).first()
    assert (got["loss_chars"], got["loss_sha256"]) == (len(long), hashlib.sha256(long.encode()).hexdigest())
