"""Benchmark decontamination by a prefix-filtered join of shingles.

A benchmark item gives one window per run of ``window`` consecutive words (a shorter item is one
window). A window is a set of three-word shingles of which a document must hold all, so the
prefix that cannot be missed is one shingle: the rarest by its count over all documents. Only
document positions with such a shingle become candidates; a candidate must leave room for the
window on both sides within the document (length and position), and is then compared word by
word with the item-sized window of the document around it. The result is exact.

The benchmark is worked off in blocks of at most ``BLOCK_BYTES`` of text (a longer item is a
block of its own), each broadcast once; documents are never shuffled.

Cases: a null or empty text has no words and is clean; an item without id marks words but is not named or
counted; an item without words has no windows;
repeated items and repeated document rows are kept as they are, one result row per document
row; an empty benchmark leaves everything clean; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import col_of, narrow, plain_words, slices

BLOCK_BYTES = 4 << 20
WINDOW = 10
SLICE = 8 << 20
SHINGLE = 3
#: Candidates compared at once.
AT_ONCE = 1 << 18

SPANS = "array<struct<start:int,end:int>>"


@dataclass
class Block:
    """Windows of some items as word numbers; number 0 is any word that no item has."""

    vocab: dict[bytes, int] = field(default_factory=dict)
    windows: list[tuple[int, ...]] = field(default_factory=list)
    items: list[list[str]] = field(default_factory=list)
    #: distinct shingles, sorted, by their length in words
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    #: per shingle length: prefix shingles, sorted, and for each the windows and places it stands for
    prefix: dict[int, tuple[np.ndarray, ...]] = field(default_factory=dict)

    @classmethod
    def build(cls, rows: list[tuple[str, str]], window: int) -> Block:
        block, seen = cls(), {}
        for item, text in rows:
            words = [block.vocab.setdefault(w, len(block.vocab) + 1) for w in plain_words(text)]
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                of = seen.setdefault(tuple(words[i : i + size]), set())
                of.add(item)
        block.windows, block.items = list(seen), [sorted(i for i in x if i is not None) for x in seen.values()]
        for size in range(1, SHINGLE + 1):
            found = {key for w in block.windows for key, n, _ in block.shingles(w) if n == size}
            if found:
                block.keys[size] = np.array(sorted(found), np.int64)
        return block

    def shingles(self, window: tuple[int, ...]) -> Iterator[tuple[int, int, int]]:
        """Key, length in words and place of every shingle of a window."""
        size, base = min(SHINGLE, len(window)), len(self.vocab) + 1
        for i in range(len(window) - size + 1):
            key = 0
            for w in window[i : i + size]:
                key = key * base + w
            # as 64-bit arithmetic has it, so that any number of words will do
            yield (key + (1 << 63)) % (1 << 64) - (1 << 63), size, i

    def choose(self, counts: dict[tuple[int, int], int]) -> None:
        """Takes the rarest shingle of each window as its prefix."""
        by: dict[int, list[tuple[int, int, int]]] = {}
        for number, w in enumerate(self.windows):
            key, size, at = min(self.shingles(w), key=lambda s: (counts.get((s[1], s[0]), 0), s))
            by.setdefault(size, []).append((key, number, at))
        for size, found in by.items():
            table = np.array(sorted(found), np.int64)
            keys, first = np.unique(table[:, 0], return_index=True)
            self.prefix[size] = (keys, np.append(first, len(table)), table[:, 1], table[:, 2])
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        self.matrix = np.zeros((len(self.windows), max(map(len, self.windows), default=1)), np.int32)
        for number, w in enumerate(self.windows):
            self.matrix[number, : len(w)] = w

    def codes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, a 0 after each, and where each begins."""
        words, ends = [], []
        for text in texts.to_pylist():
            words += plain_words(text)
            words.append(b"")
            ends.append(len(words))
        codes = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int32, len(words))
        return codes, np.array([0, *ends], np.int64)

    def positions(self, codes: np.ndarray, size: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a shingle of ``keys`` begins, and which."""
        n = len(codes) - size + 1
        if n <= 0 or not len(keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(codes[:n])
        for k in range(1, size):
            at = at[codes[at + k] > 0]
        key = np.zeros(len(at), np.int64)
        for k in range(size):
            key = key * (len(self.vocab) + 1) + codes[at + k]
        found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[found] == key
        return at[hit], found[hit]

    def matches(self, codes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of all windows that occur."""
        places, numbers = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for size, (keys, first, window, at) in self.prefix.items():
            where, found = self.positions(codes, size, keys)
            fan = first[found + 1] - first[found]
            cuts = np.flatnonzero(np.diff(np.cumsum(fan) // AT_ONCE, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(fan)]):
                many = fan[a:b]
                pick = np.repeat(first[found[a:b]] - np.cumsum(many) + many, many) + np.arange(many.sum())
                w = window[pick]
                start = np.repeat(where[a:b], many) - at[pick]
                doc = np.searchsorted(begin, np.repeat(where[a:b], many), side="right") - 1
                room = (start >= begin[doc]) & (start + self.lengths[w] < begin[doc + 1])
                start, w = start[room], w[room]
                for k in range(self.matrix.shape[1]):
                    longer = self.lengths[w] > k
                    same = ~longer
                    same[longer] = codes[start[longer] + k] == self.matrix[w[longer], k]
                    start, w = start[same], w[same]
                places.append(start)
                numbers.append(w)
        return np.concatenate(places), np.concatenate(numbers)


def _count(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        totals = {size: np.zeros(len(keys), np.int64) for size, keys in block.keys.items()}
        for batch in slices(batches, size=SLICE):
            codes, _ = block.codes(batch.column("text"))
            for size, keys in block.keys.items():
                totals[size] += np.bincount(block.positions(codes, size, keys)[1], minlength=len(keys))
        for size, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), size, np.int32)), pa.array(some), pa.array(total[some])],
                ["size", "at", "n"],
            )

    return run


def _mark(shared, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in slices(batches, size=SLICE):
            codes, begin = block.codes(batch.column("text"))
            place, number = block.matches(codes, begin)
            edge = np.zeros(len(codes) + 1, np.int32)
            np.add.at(edge, place, 1)
            np.add.at(edge, place + block.lengths[number], -1)
            before, held = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for row, spans in enumerate(before):
                for s in spans:
                    edge[begin[row] + s["start"]] += 1
                    edge[begin[row] + s["end"]] -= 1
            marked = np.concatenate([[False], np.cumsum(edge)[:-1] > 0, [False]])
            turns = np.flatnonzero(marked[1:] != marked[:-1])
            starts, ends = turns[::2], turns[1::2]
            doc = np.searchsorted(begin, starts, side="right") - 1
            spans = [[] for _ in before]
            for d, a, b in zip(doc.tolist(), (starts - begin[doc]).tolist(), (ends - begin[doc]).tolist()):
                spans[d].append({"start": a, "end": b})
            items = [set(x) for x in held]
            pairs = np.unique(np.stack([np.searchsorted(begin, place, side="right") - 1, number]), axis=1)
            for d, w in pairs.T.tolist():
                items[d].update(block.items[w])
            names = ["doc_id", "text"] if keep_text else ["doc_id"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.array(np.diff(begin) - 1, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ],
                [*names, "n_words", "spans", "items"],
            )

    return run


def _blocks(docs: DataFrame, text: Column, items: DataFrame, window: int) -> Iterator[tuple[Broadcast, bool]]:
    """The benchmark's blocks with their prefixes, and whether another follows. An empty benchmark
    gives one empty block."""
    spark = docs.sparkSession
    size = items.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item"), F.lit(0)))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        block = Block.build([tuple(r) for r in part.collect()], window)  # a block is bounded
        counts = {}
        if block.windows:
            shared = spark.sparkContext.broadcast(block)
            counted = docs.select(text.alias("text")).mapInArrow(_count(shared), "size int, at long, n long")
            for r in counted.groupBy("size", "at").agg(F.sum("n").alias("n")).collect():
                counts[r["size"], int(block.keys[r["size"]][r["at"]])] = r["n"]
        block.choose(counts)
        yield spark.sparkContext.broadcast(block), k + 1 < blocks


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    items = benchmark.select(col_of(item_col).cast("string").alias("item"), col_of(text_col).alias("text"))
    return items.where("text is not null").distinct()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Per document row: id, number of words, the word spans that occur in the benchmark
    (start, end; merged and in order) and the ids of the items they come from, sorted as strings."""
    items = _items(benchmark, item_col, item_text_col)
    rows = narrow(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    marked = rows.withColumn("n_words", F.lit(0).cast("long")).withColumn(
        "spans", F.array().cast(SPANS)
    ).withColumn("items", F.array().cast("array<string>"))
    for shared, more in _blocks(rows, F.col("text"), items, window):
        marked = marked.mapInArrow(
            _mark(shared, more),
            f"doc_id {kind}, {'text string, ' * more}n_words long, spans {SPANS}, items array<string>",
        )
    return marked


def keep_clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The rows in which no window of the benchmark occurs, with all their columns."""
    at, out = docs.columns.index(text_col), docs

    def filtered(shared: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in slices(batches, text_col, SLICE):
                codes, begin = block.codes(pc.fill_null(batch.column(at), ""))
                place, _ = block.matches(codes, begin)
                hit = np.zeros(len(batch), bool)
                hit[np.searchsorted(begin, place, side="right") - 1] = True
                yield batch.filter(pa.array(~hit))

        return run

    text = F.coalesce(col_of(text_col), F.lit(""))
    for shared, _ in _blocks(docs, text, _items(benchmark, item_col, item_text_col), window):
        out = out.mapInArrow(filtered(shared), docs.schema)
    return out


def digest(marked: DataFrame) -> DataFrame:
    """One row per document: words, words hit, items and their digest."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return marked.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
