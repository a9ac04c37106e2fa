"""Removes passages that an earlier document has: a suffix array over the suffixes that matter.

A byte goes if a string of ``WIDTH`` bytes over it also starts in a document with a smaller id. An array of
all suffixes would shuffle every byte ``WIDTH`` times, so the array is sparse. Among the grams of ``GRAM`` bytes
inside a string one has the smallest hash; equal strings agree on it. Neighbouring strings that agree on
their gram form a run, about one run for every 14 bytes, and each run gives one suffix:

1. Suffixes are ordered by leading tokens: the gram, then the whole text of the run (both as
   64-bit codes, 128 bits together), then the id. Splitters sampled from some documents range-partition
   them by gram, and every bucket sorts its own by multikey quicksort. Equal neighbours show runs that an
   earlier document has as a whole; those are removed. Grams that only one run has are done
   with, which is most text.
2. What is left are first runs whose gram other runs share: the ends of passages and the places
   where copies were changed. Their texts are read, range-partitioned by gram, and every string in
   them is a suffix of its own, sorted by multikey quicksort on eight-byte tokens of the text itself;
   equal strings stand together, and the smallest id among them keeps its own.
3. A gram that takes more than a bucket shows as splitters that repeat, and is dealt over all of their
   buckets, so a passage that a third of all documents share is spread. In each bucket all but
   the smallest id are settled; only the smallest ones are compared across boundaries.

Removed runs and strings are gathered per document and joined with its text.

Cases: a null or empty text, or one shorter than ``WIDTH`` bytes, keeps all its bytes; matches are
between documents, never inside one; rows of one id are one document in this sense, repeated
rows get repeated results; a null id is larger than every other and not smaller than another null;
very long texts are worked off in chunks; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import col_of, slices
from tabwright.sources.tables import stage

WIDTH, GRAM = 50, 24
#: Strings of one run at most: as many as can agree on one place of a gram.
RUN = WIDTH - GRAM + 1
#: Strings hashed at once, and bytes of texts taken from a batch at once.
CHUNK, SLICE = 1 << 19, 1 << 20
#: Bytes of text behind one bucket of suffixes, and of run texts in one bucket.
BUCKET_BYTES, TEXT_BYTES = 16 << 20, 4 << 20
#: Splitters at most (finer buckets divide a range by hash), and bytes of texts they are sampled from.
SPLITTERS, SAMPLE_BYTES = 1 << 15, 64 << 20
LAST = (1 << 63) - 1

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: ``place`` is the first string of a run and, in its last bits, how many it has
BITS = 5
RUNS = "bucket int, gram long, code long, id long, tag int, place long"
FOUND = "kind int, gram long, code long, id long, tag int, place long"
#: kinds of a run: removed as a whole, compared string by string, or open at a boundary
WHOLE, PARTLY, OPEN = 0, 1, 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _codes(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Per size the polynomial code of the string of that many bytes at every place, from codes of powers of two."""
    now, have, base = _mix(data.astype(np.uint64) + np.uint64(1)), 1, _BASE
    out: list = [None] * len(sizes)
    done = [0] * len(sizes)
    with np.errstate(over="ignore"):
        while have <= max(sizes):
            for i, size in enumerate(sizes):
                if size & have:
                    if out[i] is None:
                        out[i] = now
                    else:
                        n = len(data) - done[i] - have + 1
                        out[i] = out[i][:n] * base + now[done[i] : done[i] + n]
                    done[i] += have
            n = len(data) - 2 * have + 1
            if n <= 0:
                break
            now, have, base = now[:n] * base + now[have : have + n], 2 * have, np.multiply(base, base)
    return [_mix(x) for x in out]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` neighbours from every place on."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


def runs_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of strings that agree on their gram: gram, code of the whole run, first string, strings.

    ``data`` holds texts one after another, ``ends`` their ends; no run crosses an end.
    """
    empty = np.empty(0, np.int64)
    if len(data) < WIDTH:
        return empty, empty, empty, empty
    grams, strings = _codes(data, (GRAM, WIDTH))
    least = _least(grams, RUN)
    owner = np.searchsorted(ends, np.arange(len(least)), side="right")
    valid = np.arange(len(least)) + WIDTH <= ends[np.minimum(owner, len(ends) - 1)]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    # the same gram again and again: cut, so that two strings cover every byte of a run
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(least)))
    if (length > RUN).any():
        inside = np.arange(len(least)) - np.repeat(begin, length)
        new = inside % RUN == 0
        begin = np.flatnonzero(new)
    n = np.add.reduceat(valid.astype(np.int64), begin)
    begin, n = begin[n > 0], n[n > 0]
    with np.errstate(over="ignore"):
        code = _mix(strings[begin] * _BASE + strings[begin + n - 1] + n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return least[begin].view(np.int64), code.view(np.int64), begin, n


class Buckets:
    """Ranges of grams between splitters; a gram that fills several ranges is dealt over them."""

    def __init__(self, splitters: list[int], fine: int = 1) -> None:
        self.splitters, self.fine = np.array(splitters, np.int64), fine
        again = self.splitters[1:][self.splitters[1:] == self.splitters[:-1]]
        self.hot = np.unique(again)

    def __len__(self) -> int:
        return (len(self.splitters) + 1) * self.fine

    def of(self, gram: np.ndarray, deal: np.ndarray) -> np.ndarray:
        """Bucket of every gram; ``deal`` spreads the rows of a hot one."""
        low = np.searchsorted(self.splitters, gram, side="left")
        with np.errstate(over="ignore"):
            if len(self.hot):
                high = np.searchsorted(self.splitters, gram, side="right")
                room = np.maximum(high - low, 1).astype(np.uint64)
                low = low + (_mix(deal.view(np.uint64)) % room).astype(np.int64)
            part = (_mix(gram.view(np.uint64)) % np.uint64(self.fine)).astype(np.int64)
        return (low * self.fine + part).astype(np.int32)

    def is_hot(self, gram: np.ndarray) -> np.ndarray:
        return np.isin(gram, self.hot) if len(self.hot) else np.zeros(len(gram), bool)


def sampled(rows: DataFrame, column: str, buckets: int, share: float = 1.0) -> Buckets:
    """Splitters at the quantiles of a column of whole numbers, from a share of the rows."""
    coarse = min(buckets, SPLITTERS)
    fine = -(-buckets // coarse)
    if coarse < 2:
        return Buckets([], fine)
    shares = [i / coarse for i in range(1, coarse)]
    some = rows.sample(False, share, seed=1) if share < 1 else rows
    found = some.agg(F.percentile_approx(column, shares, 20 * coarse)).first()[0]
    return Buckets(sorted(found or []), fine)


def _runs(batches: Iterator[pa.RecordBatch], chunk: int, buckets: Buckets) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in RUNS.split(", ")]
    for batch in slices(batches, size=SLICE):
        ids, tags = batch.column("id").to_numpy(), batch.column("tag").to_numpy()
        texts = batch.column("text")
        lengths = pc.binary_length(texts).to_numpy().astype(np.int64)
        first = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset]
        whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[first : first + lengths.sum()]
        stops = np.cumsum(lengths)
        # a chunk ends so many strings on; its last strings reach into the next one
        for lo in range(0, max(1, len(whole) - WIDTH + 1), chunk):
            data = whole[lo : lo + chunk + WIDTH - 1]
            a = int(np.searchsorted(stops, lo, side="right"))
            b = int(np.searchsorted(stops, lo + len(data), side="left"))
            ends = np.minimum(stops[a : b + 1], lo + len(data)) - lo
            gram, code, begin, n = runs_of(data, ends)
            if not len(begin):
                continue
            doc = a + np.searchsorted(ends, begin, side="right")
            at = begin + lo - (stops[doc] - lengths[doc])
            own = ids[doc]
            columns = [buckets.of(gram, code ^ own), gram, code, own, tags[doc], at << BITS | n]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _equal(*keys: np.ndarray) -> np.ndarray:
    """True where a row's keys are those of the row before."""
    same = np.ones(max(len(keys[0]) - 1, 0), bool)
    for k in keys:
        same &= k[1:] == k[:-1]
    return np.append(False, same)[: len(keys[0])]


def _judged(batches: Iterator[pa.RecordBatch], buckets: Buckets) -> Iterator[pa.RecordBatch]:
    """Kinds of the runs of a bucket; runs that are alone give no row."""
    names = [f.split()[0] for f in RUNS.split(", ")][1:]
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    del held
    gram = table.column("gram").to_numpy()
    # multikey quicksort: the next key only for those that share the last
    order = np.argsort(gram)
    same = _equal(gram[order])
    # a run of a hot gram may have its like in another bucket
    order = order[same | np.append(same[1:], False) | buckets.is_hot(gram[order])]
    table = table.select(names).take(pa.array(order))
    gram, code, ids = (table.column(c).to_numpy() for c in names[:3])
    order = np.lexsort((ids, code, gram))
    gram, code, ids = gram[order], code[order], ids[order]
    if not len(gram):
        return
    new_gram = ~_equal(gram)
    new_code = ~_equal(gram, code)
    grams, codes = np.cumsum(new_gram) - 1, np.cumsum(new_code) - 1
    least = ids[new_code][codes]  # the smallest id of a code stands first
    starts = np.flatnonzero(new_gram)
    several = np.maximum.reduceat(ids, starts) != np.minimum.reduceat(ids, starts)
    shared = several & (np.add.reduceat(new_code.astype(np.int64), starts) > 1)
    rest = np.where(buckets.is_hot(gram), OPEN, np.where(shared[grams], PARTLY, -1))
    kind = np.where(least < ids, WHOLE, rest).astype(np.int32)
    keep = kind >= 0
    table = table.take(pa.array(order[keep])).add_column(0, "kind", pa.array(kind[keep]))
    yield from table.combine_chunks().to_batches(max_chunksize=1 << 16)


def judged_runs(rows: DataFrame, buckets: Buckets) -> DataFrame:
    """Runs that an earlier document has as a whole, and runs to be compared string by string."""
    runs = rows.select("id", "tag", "text").mapInArrow(partial(_runs, chunk=CHUNK, buckets=buckets), RUNS)
    dealt = runs.repartitionById(len(buckets), F.col("bucket"))
    found = stage(dealt.mapInArrow(partial(_judged, buckets=buckets), FOUND), "judged-runs")
    if not len(buckets.hot):
        return found
    still = found.where(F.col("kind") == OPEN).drop("kind")
    codes = stage(still.groupBy("gram", "code").agg(F.min("id").alias("owner"), F.max("id").alias("last")), "open-codes")
    grams = codes.groupBy("gram").agg(
        F.min("owner").alias("least"), F.max("last").alias("most"), F.count("*").alias("codes")
    )
    shared = (F.col("codes") > 1) & (F.col("least") < F.col("most"))
    kind = F.when(F.col("owner") < F.col("id"), WHOLE).when(shared, PARTLY)
    closed = still.join(codes.drop("last"), ["gram", "code"]).join(grams, "gram").withColumn("kind", kind)
    closed = closed.where("kind is not null").select(*found.columns)
    return stage(found.where(F.col("kind") != OPEN).unionByName(closed), "runs")


def _texts(batches: Iterator[pa.RecordBatch], buckets: Buckets) -> Iterator[pa.RecordBatch]:
    """The bytes under every run that is to be compared."""
    names = [f.split()[0] for f in PIECE.split(", ")]
    for batch in slices(batches, size=SLICE):
        lists = batch.column("runs")
        runs = lists.flatten()
        row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
        gram, place = runs.field("gram").to_numpy(), runs.field("place").to_numpy()
        texts = [t.encode() for t in batch.column("text").to_pylist()]
        at, n = place >> BITS, place & (1 << BITS) - 1
        parts = [texts[r][a : a + k + WIDTH - 1] for r, a, k in zip(row.tolist(), at.tolist(), n.tolist())]
        own = batch.column("id").take(pa.array(row))
        columns = [
            pa.array(buckets.of(gram, own.to_numpy())),
            pa.array(gram),
            own,
            batch.column("tag").take(pa.array(row)),
            pa.array(place),
            pa.array(parts, pa.binary()),
        ]
        piece = pa.RecordBatch.from_arrays(columns, names)
        # rows of one id may differ in text and still share a tag
        yield piece.filter(pa.array([len(p) == k + WIDTH - 1 for p, k in zip(parts, n.tolist())], pa.bool_()))


PIECE = "bucket int, gram long, id long, tag int, place long, text binary"


def equal_strings(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers of the groups of equal strings of ``WIDTH`` bytes at ``places``, by multikey quicksort.

    Strings are sorted by their first token of eight bytes; those whose token another string
    has too are sorted by the next, and so on.
    """
    token, have = data.astype(np.uint64), 1
    while have < 8:
        n = len(token) - have
        token = token[:n] << np.uint64(8 * have) | token[have : have + n]
        have *= 2
    group = np.zeros(len(places), np.int64)
    rows = np.arange(len(places))
    fresh = 1
    for step in (*range(0, WIDTH - 8, 8), WIDTH - 8):
        if not len(rows):
            break
        key = token[places[rows] + step]
        order = np.lexsort((key, group[rows])) if step else np.argsort(key)
        rows, key = rows[order], key[order]
        old = group[rows]
        new = np.append(True, (key[1:] != key[:-1]) | (old[1:] != old[:-1]))
        numbers = np.cumsum(new) - 1
        group[rows] = fresh + numbers
        fresh += int(numbers[-1]) + 1
        counts = np.bincount(numbers)
        rows = rows[counts[numbers] > 1]
    return group


STRINGS = "kind int, id long, tag int, place long, text binary"


def _compared(batches: Iterator[pa.RecordBatch], buckets: Buckets) -> Iterator[pa.RecordBatch]:
    """Removed strings of a bucket, and what its hot grams leave open."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).sort_by("gram")
    del held
    gram = table.column("gram").to_numpy()
    # grams are compared by themselves, so a bucket can be worked off in pieces of whole ones
    starts = np.flatnonzero(~_equal(gram))
    cuts = starts[np.unique(np.searchsorted(starts, np.arange(0, len(gram), PIECE_ROWS)).clip(max=len(starts) - 1))]
    cuts = np.unique(np.append(cuts, [0, len(gram)]))
    for a, b in zip(cuts, cuts[1:]):
        yield from _compare(table.slice(a, b - a), buckets)


def _compare(table: pa.Table, buckets: Buckets) -> Iterator[pa.RecordBatch]:
    texts = table.column("text").to_pylist()
    data = np.frombuffer(b"".join(texts), np.uint8)
    place = table.column("place").to_numpy()
    at, n = place >> BITS, place & (1 << BITS) - 1
    start = np.cumsum(n + WIDTH - 1) - (n + WIDTH - 1)
    row = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    group = equal_strings(data, start[row] + inside)
    ids = table.column("id").to_numpy()[row]
    order = np.lexsort((ids, group))
    new = ~_equal(group[order])
    least = np.empty(len(ids), np.int64)
    least[order] = ids[order][new][np.cumsum(new) - 1]
    gone = least < ids
    still = ~gone & buckets.is_hot(table.column("gram").to_numpy())[row]
    for kind, chosen in ((WHOLE, gone), (OPEN, still)):
        # neighbours are one row
        opens = chosen & ~(np.append(False, chosen[:-1]) & _equal(row))
        first = np.flatnonzero(opens)
        if not len(first):
            continue
        count = np.bincount((np.cumsum(opens) - 1)[chosen], minlength=len(first))
        own = row[first]
        inner = inside[first]
        columns = [
            pa.array(np.full(len(first), kind, np.int32)),
            *(table.column(c).take(pa.array(own)).combine_chunks() for c in ("id", "tag")),
            pa.array((at[own] + inner) << BITS | count),
            pa.array(
                [texts[r][i : i + k + WIDTH - 1] if kind == OPEN else None for r, i, k in zip(own.tolist(), inner.tolist(), count.tolist())],
                pa.binary(),
            ),
        ]
        yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in STRINGS.split(", ")])


#: Runs compared at once, if their grams allow.
PIECE_ROWS = 1 << 14


def compared_strings(rows: DataFrame, runs: DataFrame, spread: int) -> DataFrame:
    """Strings of partly shared runs that an earlier document has, as ``id, tag, place``."""
    partly = runs.where(F.col("kind") == PARTLY)
    count = partly.count()
    buckets = sampled(partly, "gram", max(spread, -(-count * (WIDTH + RUN) // TEXT_BYTES)))
    asked = partly.groupBy("id", "tag").agg(F.collect_set(F.struct("gram", "place")).alias("runs"))
    texts = rows.join(asked, ["id", "tag"]).select("id", "tag", "text", "runs")
    pieces = texts.mapInArrow(partial(_texts, buckets=buckets), PIECE)
    dealt = pieces.repartitionById(len(buckets), F.col("bucket"))
    found = stage(dealt.mapInArrow(partial(_compared, buckets=buckets), STRINGS), "compared-strings")
    gone = found.where(F.col("kind") == WHOLE).select("id", "tag", "place")
    if not len(buckets.hot):
        return gone
    # one row per hot string and bucket, of its smallest id there
    k = F.explode(F.expr(f"sequence(0, cast(place & {(1 << BITS) - 1} as int) - 1)")).alias("k")
    still = found.where(F.col("kind") == OPEN).select("id", "tag", "place", "text", k)
    string = F.expr(f"substring(text, k + 1, {WIDTH})").alias("string")
    own = F.expr(f"shiftleft(shiftright(place, {BITS}) + k, {BITS}) + 1").alias("place")
    still = stage(still.select("id", "tag", own, string), "open-strings")
    least = still.groupBy("string").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    closed = still.join(least.drop("most"), "string").where("least < id")
    return gone.unionByName(closed.select("id", "tag", "place"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` (null as the largest), ``tag`` of the text, and ``text``, beside the own ``doc_id``."""
    text = F.coalesce(col_of(text_col), F.lit(""))
    number: Column = F.coalesce(col_of(id_col).cast("long"), F.lit(LAST))
    return docs.select(col_of(id_col).alias("doc_id"), number.alias("id"), F.hash(text).alias("tag"), text.alias("text"))


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, tag`` of documents that lose bytes, with the strings (first, how many) that go."""
    rows = keyed(docs, id_col, text_col)
    # sizes and samples steer the spread only
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spread = 2 * docs.sparkSession.sparkContext.defaultParallelism
    some = rows.sample(False, min(1.0, SAMPLE_BYTES / max(size, 1)), seed=1).select("id", "tag", "text")
    grams = some.mapInArrow(partial(_runs, chunk=CHUNK, buckets=Buckets([])), RUNS)
    runs = judged_runs(rows, sampled(grams, "gram", max(spread, -(-size // BUCKET_BYTES))))
    strings = compared_strings(rows, runs, spread)
    gone = runs.where(F.col("kind") == WHOLE).select("id", "tag", "place").unionByName(strings)
    return gone.groupBy("id", "tag").agg(F.collect_list("place").alias("spans"))


def _kept(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Sizes, removed bytes, the maximal runs they form, and what is left of every text."""
    texts = [t.encode() for t in batch.column("text").to_pylist()]
    lengths = np.array([len(t) for t in texts], np.int64)
    # every text has one byte more, which is never removed and parts it from the next
    begin = np.cumsum(lengths + 1) - lengths - 1
    lists = batch.column("spans")
    place = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(texts)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    first, last = place >> BITS, (place >> BITS) + (place & (1 << BITS) - 1) + WIDTH - 1
    first, last = (np.minimum(x, lengths[row]) + begin[row] for x in (first, last))
    total = int((lengths + 1).sum())
    mark = np.bincount(first, minlength=total + 1) - np.bincount(last, minlength=total + 1)
    gone = np.cumsum(mark)[:total] > 0
    opens = gone & ~np.append(False, gone[:-1])
    ends = begin + lengths + 1
    before = np.concatenate([[0], np.cumsum(gone)])
    runs = np.concatenate([[0], np.cumsum(opens)])
    n = before[ends] - before[begin]
    left = [
        t if not k else np.frombuffer(t, np.uint8)[~gone[a : a + len(t)]].tobytes()
        for t, k, a in zip(texts, n.tolist(), begin.tolist())
    ]
    columns = [
        batch.column("doc_id"),
        pa.array(lengths),
        pa.array(n),
        pa.array(runs[ends] - runs[begin]),
        pa.array(left, pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row its bytes, those removed, the runs they form, and the remaining bytes."""
    rows = keyed(docs, id_col, text_col)
    spans = stage(removed(docs, id_col, text_col), "removed-spans")
    both = rows.join(spans, ["id", "tag"], "left").select("doc_id", "text", "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE):
            yield _kept(batch)

    return both.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(left: DataFrame) -> DataFrame:
    """The columns of :func:`cut` with a digest in place of the bytes."""
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
