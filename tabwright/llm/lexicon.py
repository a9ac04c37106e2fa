"""Words that hold at least a given share of all words, counted exactly over a whole table.

Two scans. The first finds candidates: a slice of rows reports the words that hold half the share
within the slice. What a word has in slices that do not report it is less than half the share of
all words, so a word with the whole share shows at least half of it in the reports, and at most
``2 / share`` words do. The second scan counts these over all rows. Sizes are bounded by the
share whatever the table holds.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import slices

SLICE = 6 << 20
_NAMES = ["key", "word", "n", "figures"]
_TYPES = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64())]
_SCHEMA = "key string, word string, n long, figures array<long>"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], _NAMES)


def _groups(batch: pa.RecordBatch) -> dict[str, list[str]]:
    groups = defaultdict(list)
    for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
        if key is not None and text:
            groups[key].append(text)
    return groups


def common_words(
    rows: DataFrame,
    share: float,
    split: Callable[[str], list[str]],
    figures: Callable[[list[str]], list[int]] = lambda texts: [],
    width: int = 0,
    key_share: float = 0.001,
) -> dict[str, tuple[int, list[int], dict[str, int]]]:
    """Per key: number of words, sums of ``figures`` (``width`` numbers) and the common words' counts.

    ``rows`` has ``key`` and ``text``; keys with less than ``key_share`` of all words are left out,
    which bounds their number too.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = defaultdict(lambda: np.zeros(width + 1, np.int64)), Counter()
        for batch in slices(batches, size=SLICE):
            for key, texts in _groups(batch).items():
                words = Counter(split("\n".join(texts)))
                total = words.total()
                sums[key] += [total, *figures(texts)]
                seen.update({(key, w): n for w, n in words.items() if n >= total * share / 2})
        yield _batch(
            [(key, w, n, None) for (key, w), n in seen.items()]
            + [(key, None, None, s.tolist()) for key, s in sums.items()]
        )

    spark = rows.sparkSession
    found = rows.mapInArrow(find, _SCHEMA).groupBy("key", "word").agg(
        F.sum("n").alias("n"), *(F.sum(F.get("figures", F.lit(k))).alias(f"f{k}") for k in range(width + 1))
    )
    # one row per key, and the heavy words of each task: read twice, so written once
    from tabwright.sources.tables import stage

    found = stage(found, "heavy-words")
    sums = found.where("word is null").select("key", *(f"f{k}" for k in range(width + 1)))
    least = (sums.agg(F.sum("f0")).first()[0] or 0) * key_share
    sums = sums.where((F.col("f0") >= least) & (F.col("f0") > 0))
    heavy = found.where("word is not null").select("key", "word", "n").join(sums.select("key", "f0"), "key")
    heavy = heavy.where(F.col("n") >= F.col("f0") * (share / 2)).select("key", "word").collect()
    keys = {r["key"]: [r[f"f{k}"] for k in range(width + 1)] for r in sums.collect()}
    wanted = defaultdict(list)
    for r in heavy:
        wanted[r["key"]].append(r["word"])
    shared = spark.sparkContext.broadcast(dict(wanted))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {key: {w: i for i, w in enumerate(words)} for key, words in shared.value.items()}
        sums = {key: np.zeros(len(words), np.int64) for key, words in index.items()}
        for batch in slices(batches, size=SLICE):
            for key, texts in _groups(batch).items():
                if key in index:
                    words = split("\n".join(texts))
                    at = np.fromiter(map(index[key].get, words, repeat(-1)), np.int64, len(words))
                    sums[key] += np.bincount(at + 1, minlength=len(sums[key]) + 1)[1:]
        yield _batch([(key, w, int(sums[key][i]), None) for key in index for w, i in index[key].items() if sums[key][i]])

    result = {key: (f[0], f[1:], {}) for key, f in keys.items()}
    for r in rows.mapInArrow(count, _SCHEMA).groupBy("key", "word").agg(F.sum("n").alias("n")).collect():
        if r["n"] >= result[r["key"]][0] * share:
            result[r["key"]][2][r["word"]] = r["n"]
    return result
