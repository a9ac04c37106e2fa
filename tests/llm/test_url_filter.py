import math

from tabwright.llm.url_filter import Rules, RULES, Splitter, judge, parts


def test_parts_and_rules():
    assert parts("https://WWW.Example.ORG/en/1?x#y") == ("www.example.org", "/en/1")
    assert parts("http://a.com?x") == ("a.com", "")
    assert parts("no scheme") == parts(None) == ("", "")
    find = Rules(RULES).find
    assert find("www.example.org", "/en/12") == ("example.org/en/1", "block")
    assert find("example.org", "/en/2") == ("org/", "allow")
    assert find("xexample.org", "/es/") == ("org/", "allow")
    assert find("a.com", "/de/x") == ("com/de/", "block")
    assert find("a.com", "/en/") is None and find("org", "") is None


def brute_split(label, splitter):
    best = None
    for mask in range(1 << (len(label) - 1)):
        words, begin = [], 0
        for k in range(1, len(label) + 1):
            if k == len(label) or mask >> (k - 1) & 1:
                words.append(label[begin:k])
                begin = k
        cost = sum(splitter.cost.get(w, splitter.unknown + math.log(10) * len(w)) for w in words)
        if best is None or cost < best:
            best = cost
    return best


def test_viterbi_is_the_best_split():
    splitter = Splitter({"cheap": 50, "pills": 40, "he": 90, "a": 100, "pill": 20, "s": 30}, 1000)
    for label in ("cheappills", "heapill", "zzcheap", "a", "apillsq"):
        words = splitter.split(label)
        assert "".join(words) == label
        cost = sum(splitter.cost.get(w, splitter.unknown + math.log(10) * len(w)) for w in words)
        assert math.isclose(cost, brute_split(label, splitter))
    assert splitter.host("www.cheappills.com")[1:3] == ["cheap", "pills"]


def test_judge(spark):
    rows = [(i, f"http://good{i}.org/en/a", "<p>good words</p>", "x") for i in range(30)]
    rows += [(100 + i, f"http://casino{i}.com/de/win", "<p>casino win casino</p>", "x") for i in range(30)]
    rows += [(200, "http://casino.net/win", None, "x"), (201, "http://good.net/en/a", "", None), (202, None, None, None)]
    rows += [(200, "http://casino.net/win", None, "x"), (None, "ftp", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, score string")
    got = judge(pages).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert (by[200]["rule"], by[200]["verdict"]) == (None, "block")
    assert by[201]["verdict"] == "allow" and by[0]["rule"] == "org/" and by[100]["verdict"] == "block"
    assert (by[202]["host"], by[202]["path"], by[202]["verdict"]) == ("", "", "allow")
    assert judge(pages.limit(0)).collect() == []
    assert {r["verdict"] for r in judge(pages.where("page_id >= 200")).collect()} == {"allow"}


def test_numbers_of_bayes(spark):
    """Score against counts taken by hand."""
    rows = [(1, "http://x.org/a", ""), (2, "http://x.org/b", ""), (3, "http://y.com/de/a", ""), (4, "http://z.net/a", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["score"] for r in judge(pages).collect()}
    # with an empty lexicon hosts fall into parts by cost alone; count them as the operator does
    split = Splitter({}, 0).host
    seen = [(split("x.org"), ["a"]), (split("x.org"), ["b"]), (split("y.com"), ["de", "a"])]
    names = [[f"h {w}" for w in h] + [f"p {w}" for w in p] for h, p in seen]
    allow, block = names[0] + names[1], names[2]
    both = set(allow) | set(block)
    odds = lambda t: math.log((block.count(t) + 1) / (len(block) + len(both))) - math.log(
        (allow.count(t) + 1) / (len(allow) + len(both))
    )
    mine = [f"h {w}" for w in split("z.net")] + ["p a"]
    assert math.isclose(got[4], math.log(2 / 3) + sum(odds(t) for t in mine if t in both))
