"""Hard negatives by a vertical scan: dimension after dimension, until bounds settle every row (BOND).

Vectors are kept by columns, in blocks of ``ROWS`` rows with the least and greatest value of every
dimension. An anchor reads a block's dimensions in descending order of its own magnitude there,
so that what is still unread can change a score little. After every few dimensions each row of the
candidate bitmap has a partial score and, from the minima and maxima of the unread ones, a range in
which its score lies. A row whose range misses what the anchor still looks for leaves the bitmap;
rows that are left at the end have exact integer scores. Two scans are made:

1. positives: the best rows of the anchor's own label;
2. negatives: rows of other labels inside a window of scores around each positive's score, the
   best first. All windows of an anchor share one scan.

Anchors are searched against all rows in blocks: rows are dealt to cells, every block of anchors
visits every cell, and what a block of anchors finds in the rows before raises the bar for the next.
A visit keeps at most the rows asked for, so the merge of all visits is small, and no
vector meets another outside a block. Work is anchors times rows, as an exact search needs;
blocks bound the memory of a task at any size.

Cases: rows with a null id, label or vector, with a null or non-finite component, or with a
component of 2 ** 26 or more after scaling (scores must fit 64 bits) take no part; vectors are compared
with those of the same length, empty ones score 0; rows of one id are one row, the one with the smallest
label and vector; an anchor without positives, and a positive without negatives, give no rows; an empty
table gives no rows; ties go to the smaller id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm.common import col_of
from tabwright.sources.tables import stage

#: Rows of a block, anchors of a block, and row blocks of a cell at most.
ROWS, ANCHORS, CELL = 4096, 512, 32
#: Dimensions read between two looks at the bounds.
STEP = 8
SCALE = 256
LARGEST = 1 << 26

BLOCK = "dim int, block long, ids binary, labels binary, vectors binary"
FOUND = "anchor_id long, slot int, rank int, other_id long, score long"


def prepared(rows: DataFrame, label: Column, id_col: str, vector_col: str) -> DataFrame:
    """Valid rows as ``id, label, vector`` of scaled integers, one per id."""
    given = col_of(vector_col)
    scaled = F.transform(given, lambda x: F.floor(x.cast("double") * SCALE))
    sound = F.forall(given, lambda x: x.isNotNull() & (F.abs(x.cast("double") * SCALE) < LARGEST))
    good = rows.where(col_of(id_col).isNotNull() & label.isNotNull() & given.isNotNull() & sound)
    out = good.select(col_of(id_col).cast("long").alias("id"), label.cast("long").alias("label"), scaled.alias("vector"))
    out = stage(out, "vectors")
    # ids only first: whole vectors move where an id really occurs again
    again = stage(out.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated-ids")
    one = out.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r"))
    return out.join(again, "id", "left_anti").unionByName(one.select("id", "r.label", "r.vector"))


def blocks(rows: DataFrame, size: int, extra: str = "") -> DataFrame:
    """Rows packed in blocks of one vector length; vectors are laid out by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}

        def pack(dim: int, some: list[tuple]) -> pa.RecordBatch:
            ids = np.concatenate([s[0] for s in some])
            labels = np.concatenate([s[1] for s in some])
            table = np.concatenate([s[2] for s in some]).reshape(len(ids), dim).T
            number = int(ids[0])
            columns = [
                pa.array([dim], pa.int32()),
                pa.array([number], pa.int64()),
                *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (ids, labels, table)),
            ]
            if extra:
                columns.append(pa.array([np.concatenate([s[3] for s in some]).tobytes()], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, ["dim", "block", "ids", "labels", "vectors", *[extra] * bool(extra)])

        for batch in batches:
            lists = batch.column("vector")
            lengths = np.diff(lists.offsets.to_numpy())
            values = lists.values.to_numpy()[lists.offsets[0].as_py() :]
            starts = np.concatenate([[0], np.cumsum(lengths)])
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            windows = np.array(batch.column(extra).to_pylist(), np.int64) if extra else None
            for dim in np.unique(lengths).tolist():
                here = np.flatnonzero(lengths == dim)
                flat = values[(starts[here][:, None] + np.arange(dim)).ravel()].astype(np.int32)
                for a in range(0, len(here), size):
                    at = here[a : a + size]
                    part = (ids[at], labels[at], flat[a * dim : (a + size) * dim], *([windows[at]] if extra else []))
                    some = waiting.setdefault(dim, [])
                    if some and sum(len(s[0]) for s in some) + len(at) > size:
                        yield pack(dim, some)
                        some.clear()
                    some.append(part)
        for dim, some in waiting.items():
            if some:
                yield pack(dim, some)

    return rows.mapInArrow(run, BLOCK + (f", {extra} binary" if extra else ""))


def visits(anchors: DataFrame, rows: DataFrame, search: Callable, spread: int) -> DataFrame:
    """Every block of anchors beside every block of rows, cell by cell, through ``search``."""
    count = rows.count()
    cells = max(1, -(-count // CELL), min(count, spread))
    placed = rows.withColumn("cell", F.pmod(F.xxhash64("dim", "block"), F.lit(cells)).cast("int"))
    calls = anchors.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    named = placed.select(F.col("dim"), F.col("cell"), *(F.col(c).alias(f"row_{c}") for c in ("ids", "labels", "vectors")))
    # an explicit number: cells are few bytes and much work, and must not be merged by size
    both = calls.repartition(cells, "cell").hint("merge").join(named.repartition(cells, "cell"), ["dim", "cell"])
    return both.mapInArrow(search, FOUND)


def narrowed(
    vector: np.ndarray, columns: np.ndarray, low: np.ndarray, high: np.ndarray, alive: np.ndarray, ask: Callable
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a block that may answer an anchor, and their exact scores.

    ``columns`` is dimension by row, ``low`` and ``high`` its extremes. ``ask(least, most)`` says which
    rows, given the ranges of their scores, stay.
    """
    order = np.argsort(-np.abs(vector), kind="stable")
    weights = vector[order]
    a, b = weights * low[order], weights * high[order]
    # what the dimensions from each place on add at least and at most
    floor = np.concatenate([np.cumsum(np.minimum(a, b)[::-1])[::-1], [0]])
    ceiling = np.concatenate([np.cumsum(np.maximum(a, b)[::-1])[::-1], [0]])
    rows, partial = alive, np.zeros(len(alive), np.int64)
    for at in range(0, len(order), STEP):
        for w, d in zip(weights[at : at + STEP], order[at : at + STEP]):
            partial += w * (columns[d] if len(rows) == columns.shape[1] else columns[d][rows])
        end = min(at + STEP, len(order))
        stay = ask(partial + floor[end], partial + ceiling[end])
        if stay is not None and not stay.all():
            rows, partial = rows[stay], partial[stay]
        if not len(rows):
            break
    return rows, partial


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` highest scores, ties by smaller id, without repeated ids."""
    order = np.lexsort((ids, -scores))[: 2 * n]
    _, first = np.unique(ids[order], return_index=True)
    order = order[np.sort(first)][:n]
    return scores[order], ids[order]


class Visit:
    """What one block of anchors has found in the blocks of rows it has visited so far."""

    def __init__(self, record: dict, windows: bool) -> None:
        self.key = record["ids"]
        self.ids = np.frombuffer(record["ids"], np.int64)
        self.labels = np.frombuffer(record["labels"], np.int64)
        self.vectors = np.frombuffer(record["vectors"], np.int32).reshape(record["dim"], len(self.ids)).T.astype(np.int64)
        self.windows = np.frombuffer(record["windows"], np.int64).reshape(len(self.ids), -1, 2) if windows else None
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def keep(self, k: int, slot: int, scores: np.ndarray, ids: np.ndarray, n: int) -> None:
        old = self.found.get((k, slot))
        if old is not None:
            scores, ids = np.concatenate([old[0], scores]), np.concatenate([old[1], ids])
        self.found[k, slot] = best(scores, ids, n)

    def bar(self, k: int, slot: int, n: int) -> int:
        """The score that a row must reach to be among the ``n`` best."""
        old = self.found.get((k, slot))
        return int(old[0][-1]) if old is not None and len(old[0]) == n else np.iinfo(np.int64).min

    def rows(self) -> pa.RecordBatch:
        parts = [(k, slot, len(s[0])) for (k, slot), s in self.found.items()]
        sizes = [n for *_, n in parts]
        columns = [
            np.repeat([self.ids[k] for k, *_ in parts], sizes),
            np.repeat([slot for _, slot, _ in parts], sizes).astype(np.int32),
            np.concatenate([np.arange(1, n + 1) for n in sizes] or [[]]).astype(np.int32),
            np.concatenate([s[1] for s in self.found.values()] or [[]]).astype(np.int64),
            np.concatenate([s[0] for s in self.found.values()] or [[]]).astype(np.int64),
        ]
        columns[0] = np.asarray(columns[0], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in FOUND.split(", ")])


def _searched(each: Callable, windows: bool) -> Callable:
    """Runs ``each(visit, k, ids, labels, columns, low, high)`` for every anchor of every pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for i in range(batch.num_rows):
                record = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if now is None or now.key != record["ids"]:
                    if now is not None:
                        yield now.rows()
                    now = Visit(record, windows)
                ids = np.frombuffer(record["row_ids"], np.int64)
                labels = np.frombuffer(record["row_labels"], np.int64)
                columns = np.frombuffer(record["row_vectors"], np.int32).reshape(record["dim"], len(ids)).astype(np.int64)
                low, high = columns.min(1), columns.max(1)
                for k in range(len(now.ids)):
                    each(now, k, ids, labels, columns, low, high)
        if now is not None:
            yield now.rows()

    return run


def nth_highest(values: np.ndarray, n: int) -> int:
    return int(np.partition(values, len(values) - n)[len(values) - n])


def positives_in(n: int) -> Callable:
    """Per anchor the ``n`` best rows of its own label."""

    def each(visit: Visit, k: int, ids, labels, columns, low, high) -> None:
        alive = np.flatnonzero((labels == visit.labels[k]) & (ids != visit.ids[k]))
        if not len(alive):
            return

        def ask(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            bar = visit.bar(k, 0, n)
            if len(least) >= n:
                bar = max(bar, nth_highest(least, n))
            return most >= bar

        rows, scores = narrowed(visit.vectors[k], columns, low, high, alive, ask)
        if len(rows):
            visit.keep(k, 0, scores, ids[rows], n)

    return _searched(each, False)


def negatives_in(n: int) -> Callable:
    """Per anchor and window the ``n`` best rows of other labels whose score lies in the window."""

    def each(visit: Visit, k: int, ids, labels, columns, low, high) -> None:
        spans = [(slot, int(a), int(b)) for slot, (a, b) in enumerate(visit.windows[k]) if a <= b]
        alive = np.flatnonzero(labels != visit.labels[k])
        if not spans or not len(alive):
            return

        def ask(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            stay = np.zeros(len(least), bool)
            for slot, a, b in spans:
                bar = max(a, visit.bar(k, slot, n))
                sure = least[(least >= a) & (most <= b)]
                if len(sure) >= n:
                    bar = max(bar, nth_highest(sure, n))
                stay |= (most >= bar) & (least <= b)
            return stay

        rows, scores = narrowed(visit.vectors[k], columns, low, high, alive, ask)
        for slot, a, b in spans:
            inside = (scores >= a) & (scores <= b)
            if inside.any():
                visit.keep(k, slot, scores[inside], ids[rows[inside]], n)

    return _searched(each, True)


def merged(found: DataFrame, n: int) -> DataFrame:
    """The ``n`` best of all visits per anchor and slot."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(
    rows: DataFrame,
    label: Column | None = None,
    anchor: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
) -> DataFrame:
    """Per anchor and positive the best rows of other labels with a score between ``low_percent`` and
    ``high_percent`` of the positive's.

    ``label`` is an expression for the label, ``anchor`` a condition on the column ``id``.
    """
    spark = rows.sparkSession
    label = col_of(label_col) if label is None else label
    anchor = F.pmod("id", F.lit(100)) == 0 if anchor is None else anchor
    known = stage(prepared(rows, label, id_col, vector_col), "prepared-vectors")
    spread = 2 * spark.sparkContext.defaultParallelism
    packed = stage(blocks(known, ROWS), "vector-blocks")
    # few and small beside the rows they meet: blocks of anchors should be full
    anchors = known.where(anchor)
    full = max(1, -(-anchors.count() // (8 * ANCHORS)))
    calls = stage(blocks(anchors.repartition(full), ANCHORS), "anchor-blocks")

    first = stage(visits(calls, packed, positives_in(positives), spread), "positive-visits")
    chosen = stage(merged(first, positives).select("anchor_id", F.col("rank").alias("slot"), "other_id", "score"), "positives")
    # whole numbers between the two shares of the score; none where the positive's score is negative
    windows = chosen.select(
        "anchor_id",
        "slot",
        F.expr(f"cast(ceil(cast({low_percent} * score as decimal(38, 0)) / 100) as long)").alias("a"),
        F.expr(f"cast(floor(cast({high_percent} * score as decimal(38, 0)) / 100) as long)").alias("b"),
    )
    per_anchor = windows.groupBy("anchor_id").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", F.array("a", "b")))).alias("w")
    )
    none = F.array(F.lit(1).cast("long"), F.lit(0).cast("long"))
    spans = F.flatten(F.array(*(F.coalesce(F.col("w")[s], none) for s in range(1, positives + 1)))).alias("windows")
    asking = anchors.join(per_anchor.withColumnRenamed("anchor_id", "id"), "id").select("id", "label", "vector", spans)
    asking = stage(blocks(asking.repartition(full), ANCHORS, "windows"), "asking-blocks")
    second = stage(visits(asking, packed, negatives_in(negatives), spread), "negative-visits")
    out = merged(second, negatives).withColumn("slot", F.col("slot") + 1).alias("n")
    return out.join(chosen.alias("p"), ["anchor_id", "slot"]).select(
        "anchor_id",
        F.col("p.other_id").alias("positive_id"),
        F.col("n.rank").alias("rank"),
        F.col("n.other_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )
