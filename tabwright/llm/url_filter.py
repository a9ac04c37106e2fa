"""URL filter: rules first, then naive Bayes on the words of host and path.

Host labels are run-together names, so each is split by unigram Viterbi: the split of greatest
probability under the shares of words in the pages' own text (words with at least 1/100,000 of
all words, counted over all pages). Multinomial naive Bayes learns from every page that a rule
decides and judges those that none does; tokens are hashed to ``BUCKETS`` numbers, which bounds
the model whatever names occur.

Cases: a null url or one without ``://`` has empty host and path, fits no rule, has no tokens
and is allowed; a null page text counts for no words; without decided pages everything else is
allowed; an equal score is allowed; repeated rows give repeated results; other columns are not
read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import col_of
from tabwright.llm.lexicon import common_words

RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
SHARE = 1e-5
LONGEST = 24
BUCKETS = 1 << 16

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_TAGS = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
_WORDS = re.compile(r"[^\W\d_]+")
_TOKENS = re.compile(r"\d+|[^\W\d_]+")
OUT = "host string, path string, rule string, verdict string, host_words array<string>, score double"


def parts(url: str | None) -> tuple[str, str]:
    """Host, lower-cased in ASCII, and path."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    rest = re.split(r"[?#]", rest, maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_UPPER), slash + path


class Rules:
    """The longest rule that fits a host and a path."""

    def __init__(self, rules: Sequence[tuple[str, str]]) -> None:
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best, labels = None, host.split(".")
        for k in range(len(labels)):
            for prefix, rule, verdict in self.by_host.get(".".join(labels[k:]), ()):
                if path.startswith(prefix) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
        return best


class Splitter:
    """Unigram Viterbi. An unknown word costs more the longer it is."""

    def __init__(self, counts: dict[str, int], total: int) -> None:
        total = max(1, total)
        self.cost = {w: math.log(total / n) for w, n in counts.items()}
        self.unknown = math.log(total) - math.log(10)
        self.split = lru_cache(100_000)(self._split)

    def _split(self, label: str) -> tuple[str, ...]:
        best, cut = [0.0], [0]
        for end in range(1, len(label) + 1):
            options = []
            for begin in range(max(0, end - LONGEST), end):
                word = label[begin:end]
                cost = self.cost.get(word, self.unknown + math.log(10) * len(word))
                options.append((best[begin] + cost, begin))
            value, begin = min(options)
            best.append(value)
            cut.append(begin)
        words, end = [], len(label)
        while end:
            words.append(label[cut[end] : end])
            end = cut[end]
        return tuple(reversed(words))

    def host(self, host: str) -> list[str]:
        return [w for label in re.split(r"[^\w]+|_", host) if label for w in self.split(label)]


def tokens(host_words: list[str], path: str) -> list[int]:
    """Hashed tokens; numbers in paths count by their length."""
    path_words = (f"#{len(w)}" if w.isdigit() else w.lower() for w in _TOKENS.findall(path))
    names = [f"h {w}" for w in host_words] + [f"p {w}" for w in path_words]
    return [zlib.crc32(t.encode()) % BUCKETS for t in names]


def page_words(html: str) -> list[str]:
    return [w.lower() for w in _WORDS.findall(_TAGS.sub(" ", html)) if len(w) <= LONGEST]


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    word_share: float = SHARE,
) -> DataFrame:
    """Per page: host, path, the rule that fits, the verdict, the words of the host and the score
    (log odds of block to allow)."""
    spark = pages.sparkSession
    rows = pages.select(
        col_of(id_col).alias("page_id"), col_of(url_col).alias("url"), col_of(text_col).alias("html")
    )
    words = common_words(rows.select(F.lit("all").alias("key"), F.col("html").alias("text")), word_share, page_words)
    total, _, counts = words.get("all", (0, [], {}))
    lexicon = spark.sparkContext.broadcast((counts, total))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, splitter = Rules(rules).find, Splitter(*lexicon.value)
        sums = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for url in batch.column("url").to_pylist():
                host, path = parts(url)
                got = find(host, path)
                if got:
                    # the last place counts pages
                    np.add.at(sums[int(got[1] == "block")], [BUCKETS, *tokens(splitter.host(host), path)], 1)
        block, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block), pa.array(bucket), pa.array(sums[block, bucket])], ["block", "bucket", "n"]
        )

    sums = np.zeros((2, BUCKETS + 1), np.int64)
    learnt = rows.select("url").mapInArrow(train, "block long, bucket long, n long")
    for r in learnt.groupBy("block", "bucket").agg(F.sum("n").alias("n")).collect():
        sums[r["block"], r["bucket"]] = r["n"]
    pages_seen, sums = sums[:, -1], sums[:, :-1]
    # add-one smoothing over the tokens of decided pages; others say nothing
    seen = sums.sum(0) > 0
    share = (sums + 1.0) / np.maximum(1, sums.sum(1) + seen.sum())[:, None]
    odds = np.where(seen, np.log(share[1] / share[0]), 0.0)
    prior = float(np.log((pages_seen[1] + 1) / (pages_seen[0] + 1)))
    model = spark.sparkContext.broadcast((odds, prior, bool(pages_seen.any())))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, splitter = Rules(rules).find, Splitter(*lexicon.value)
        odds, prior, known = model.value
        names = [c.split()[0] for c in OUT.split(", ")]
        types = [pa.string()] * 4 + [pa.list_(pa.string()), pa.float64()]
        for batch in batches:
            out = []
            for url in batch.column("url").to_pylist():
                host, path = parts(url)
                got, host_words = find(host, path), splitter.host(host)
                found = tokens(host_words, path)
                score = prior + float(odds[found].sum()) if known and found else 0.0
                verdict = got[1] if got else "block" if score > 0 else "allow"
                out.append((host, path, got[0] if got else None, verdict, host_words, score))
            cols = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *(pa.array(c, t) for c, t in zip(cols, types))], ["page_id", *names]
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.select("page_id", "url").mapInArrow(apply, f"page_id {kind}, {OUT}")
