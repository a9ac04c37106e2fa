"""Near-duplicates by min-max hashing: the smallest and the largest value of each permutation.

A text is the set of its five-word shingles. Each of ``PERMUTATIONS`` hash functions gives two
signature values, its minimum and its maximum over the set, so a signature of twice the length
costs no further hashing. Bands of ``ROWS`` values put texts into buckets; two texts at the
threshold of 0.85 share fewer than two of the 32 with probability 2e-7, at 0.8 with 5e-5.

1. Texts with equal words are one node, named by the smallest id.
2. In every bucket each node is paired with the bucket's smallest: at most one pair per node and
   band, however large the bucket. Pairs are confirmed on the full sets and joined to components.
3. What a star can miss are links between texts of different components that share buckets.
   Texts with two such buckets at least are compared by a prefix join: with shingles ordered by rarity, linked texts
   share one of their first ``n - ceil(t n) + 1`` shingles at a threshold ``t``, and the place of that shingle
   limits how much they can share at all. A changed copy begins with shingles that only it has,
   so it meets only texts that can reach the threshold, not its whole group. Shingles are met
   across components only. Where many texts share a shingle, all are compared with one of them, the
   hub, and only what shares a shingle that the hub lacks is compared further: copies of one text that
   are too far from it share none. These pairs are confirmed on the full sets too.

So no group is written out as pairs, and within the buckets nothing is lost.

Cases: a null or empty text, or one without words, has no set, is linked with nothing and kept;
rows of one id are one document; a null id takes the component of its equal texts, and is
kept where these have no id either; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm.common import col_of, fresh, narrow, slices
from tabwright.llm.components import components
from tabwright.sources.tables import stage

SHINGLE = 5
PERMUTATIONS, ROWS = 80, 5
BANDS = 2 * PERMUTATIONS // ROWS
#: Links need 100 * intersection >= percent * union.
PERCENT = 85
SLICE = 6 << 20
#: Rows of a shingle that are met one by one; the others are first compared with one of them.
LIGHT = 16

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SEED = np.random.Generator(np.random.PCG64(20240229))
_TIMES = _SEED.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _SEED.integers(0, 1 << 63, PERMUTATIONS, np.uint64)
_MIX = _SEED.integers(0, 1 << 63, max(SHINGLE, ROWS) + 1, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = np.uint64(29)


def _fold(columns: Iterator[np.ndarray], key: np.ndarray) -> np.ndarray:
    for k, c in enumerate(columns):
        key = ((key ^ (key >> _SHIFT)) + c) * _MIX[k]
    return key ^ (key >> _SHIFT)


def shingle_sets(texts: list[str]) -> tuple[list[np.ndarray], list[bytes]]:
    """Per text its distinct shingles as sorted 64-bit hashes, and a digest of its words."""
    words, ends, digests = [], [0], []
    for t in texts:
        w = t.encode().translate(_LOWER).split()
        words += w
        ends.append(len(words))
        digests.append(hashlib.md5(b" ".join(w), usedforsecurity=False).digest())
    if not words:
        return [np.empty(0, np.uint64) for _ in texts], digests
    coded = pa.array(words, pa.binary()).dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    word = known[coded.indices.to_numpy()]
    n = len(word) - SHINGLE + 1
    start = np.full(max(n, 0), SHINGLE, np.uint64)
    key = _fold((word[k : k + n] for k in range(SHINGLE)), start) if n > 0 else start
    sets = []
    for a, b in zip(ends, ends[1:]):
        if b - a >= SHINGLE:
            sets.append(np.unique(key[a : b - SHINGLE + 1]))
        elif b > a:
            sets.append(_fold((word[k : k + 1] for k in range(a, b)), np.array([b - a], np.uint64)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets, digests


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum and maximum under every permutation."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for k in range(0, len(hashes), 4096):
        values = hashes[None, k : k + 4096] * _TIMES[:, None] + _PLUS[:, None]
        low = np.minimum(low, values.min(1))
        high = np.maximum(high, values.max(1))
    # a permutation's two values go to different bands
    return np.concatenate([low, high])


def bands(sign: np.ndarray) -> np.ndarray:
    """One hash per band, the band's number being part of it."""
    table = sign[: BANDS * ROWS].reshape(BANDS, ROWS)
    return _fold((table[:, k] for k in range(ROWS)), np.arange(1, BANDS + 1, dtype=np.uint64))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, size=SLICE):
        sets, digests = shingle_sets(batch.column("text").to_pylist())
        found = [bands(signature(s)).view(np.int64) if len(s) else np.empty(0, np.int64) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(digests, pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(found, pa.list_(pa.int64())),
            ],
            ["doc_id", "words", "n", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, size=SLICE):
        sets, _ = shingle_sets(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
            ["node", "shingles"],
        )


def _confirm(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for name in ("left", "right"):
                lists = batch.column(name)
                values = lists.values.to_numpy().view(np.uint64)
                at = lists.offsets.to_numpy()
                columns.append([values[a:b] for a, b in zip(at, at[1:])])
            keep = []
            for x, y in zip(*columns):
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v")], ["u", "v"]
            ).filter(pa.array(keep, pa.bool_()))

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("right"))
    both = pairs.join(left, "u").join(right, "v").select("u", "v", "left", "right")
    kind = pairs.schema["u"].dataType.simpleString()
    return both.mapInArrow(_confirm(percent), f"u {kind}, v {kind}")


def near_size(a: str, b: str, percent: int = PERCENT) -> str:
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def crossing_pairs(nodes: DataFrame, tokens: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs of nodes of different components that can reach the threshold by their rare shingles.

    ``nodes`` has ``node, n, component, size`` (of the component), ``tokens`` their ``node, shingle``.
    """
    counts = tokens.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    rare = tokens.join(counts, "shingle").select("node", "shingle", "df")
    own = Window.partitionBy("node")
    # shingles that no other text has come first: their number moves all others back
    placed = rare.withColumn("shared", F.count("*").over(own)).withColumn(
        "place", F.row_number().over(own.orderBy("df", "shingle"))
    )
    rows = placed.join(nodes, "node").withColumn("rank", F.expr("n - shared + place"))
    rows = rows.where(f"rank <= n - (n * {percent} + 99) div 100 + 1").drop("df", "shared", "place")
    rows = stage(rows, "prefix-shingles")
    # in each shingle's row the largest component is met by the others, never with itself
    most = rows.groupBy("shingle").agg(
        F.max(F.struct("size", "component")).alias("m"),
        F.min("component").alias("a"),
        F.max("component").alias("b"),
        F.count("*").alias("met"),
    )
    most = most.where("a != b").select("shingle", F.col("m.component").alias("main"), "met")
    rows = stage(rows.join(most, "shingle"), "mixed-shingles")
    light = rows.where(f"met <= {LIGHT}")
    few = _other(light.where("component != main"), "shingle", "node", "n", "component", "rank")
    # both first ranks known, at most one and what is left after them can be shared
    reach = "1 + least(n - rank, n_ - rank_)"
    pairs = light.join(few, "shingle").where(
        f"component != component_ and (component = main or node < node_) and {near_size('n', 'n_', percent)}"
        f" and {reach} >= {_need(percent)}"
    )
    crowd = rows.where(f"met > {LIGHT}").select("main", "node", "n", "component").distinct()
    pairs = _ordered(pairs).unionByName(_crowd_pairs(stage(crowd, "crowds"), stage(rare, "shared-shingles"), percent))
    return pairs.distinct()


def _need(percent: int, n: str = "n", other: str = "n_") -> str:
    """How many shingles texts of two sizes must share to be linked."""
    return f"({percent} * ({n} + {other}) + {99 + percent}) div {100 + percent}"


def _other(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    return rows.select(key, *(F.col(c).alias(f"{c}_") for c in columns))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("node", "node_").alias("u"), F.least("node", "node_").alias("v"))


def _crowd_pairs(crowd: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Pairs ``u, v`` that can be linked, of nodes that met in a crowded row of the same ``main`` component.

    Every node is compared with one, the hub: the text of the main component that shares most with the
    crowd for its length, so that what it lacks few others have. What is linked with it needs no other link
    to that component. A pair that is not settled so has a node x that is not linked with the hub, and if
    the other is no shorter than the hub, it needs more shingles than x shares with the hub: the pair
    shares one that the hub lacks. These are met by the prefix join, among shingles that the hub lacks
    only. Texts shorter than the hub are met as a whole where what both share with the hub may be enough.
    """
    inner = crowd.join(shared, "node").select("main", "node", "n", "component", "shingle")
    held = inner.groupBy("main", "shingle").agg(F.count("*").alias("held"))
    sizes = crowd.groupBy("main").agg(F.min("n").alias("shortest"), F.avg("n").alias("usual"))
    central = inner.where("component = main").join(held, ["main", "shingle"])
    central = central.groupBy("main", "node", "n").agg(F.sum("held").alias("held")).join(sizes, "main")
    hubs = central.groupBy("main", "shortest").agg(F.min(F.expr("struct(-held / (n + usual) as far, node, n)")).alias("hub"))
    hubs = hubs.select("main", "shortest", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
    hubs = stage(hubs, "hubs")
    inside = hubs.join(shared.select(F.col("node").alias("hub"), "shingle"), "hub").select(
        "main", "shingle", F.lit(True).alias("inside")
    )
    own = Window.partitionBy("main", "node")
    rows = crowd.join(hubs, "main").where("node != hub").join(shared, "node").join(inside, ["main", "shingle"], "left")
    rows = rows.withColumn("inside", F.coalesce("inside", F.lit(False)))
    rows = rows.withColumn("common", F.count_if("inside").over(own)).withColumn("total", F.count("*").over(own))
    # shingles that only this text has come first, then those that the hub lacks
    rows = rows.withColumn("place", F.row_number().over(own.orderBy("inside", "df", "shingle")))
    rows = rows.withColumn("linked", F.expr(f"100 * common >= {percent} * (n + hub_n - common)"))
    rows = rows.withColumn("settled", F.expr("linked or component = main")).withColumn("rest", F.expr("n - common"))
    rows = rows.withColumn("rank", F.expr("n - total + place"))
    least = f"(n * {percent} + 99) div 100"
    first = f"not inside and rank <= rest - greatest(1, {least} - common) + 1"
    names = ("main", "node", "n", "component", "common", "shortest")
    rows = rows.where(f"place = 1 or ({first})").withColumn("met", F.expr(first))
    rows = stage(rows.select(*names, "hub", "hub_n", "linked", "settled", "rest", "rank", "place", "shingle", "met"), "hub-shingles")
    to_hub = rows.where("place = 1 and linked and component != main")
    to_hub = to_hub.select(F.greatest("node", "hub").alias("u"), F.least("node", "hub").alias("v"))

    met = rows.where("met")
    open_rows = _other(met.where("not settled"), "main", "shingle", "node", "n", "component", "common", "rest", "rank")
    different = f"component != component_ and {near_size('n', 'n_', percent)}"
    by_shingle = met.join(open_rows, (met["main"] == open_rows["main"]) & (met["shingle"] == open_rows["shingle_"])).where(
        f"{different} and (settled or node < node_)"
        f" and least(common, common_) + 1 + least(rest - rank, rest_ - rank_) >= {_need(percent)}"
    )
    # no text of the crowd needs less than its shortest one does
    enough = rows.where(f"place = 1 and common >= greatest({least}, {_need(percent, 'n', 'shortest')})")
    short = enough.where("n < hub_n")
    whole = short.join(_other(enough.where("not settled"), "main", "node", "n", "component", "common"), "main").where(
        f"{different} and least(common, common_) >= {_need(percent)}"
    )
    return to_hub.unionByName(_ordered(by_shingle)).unionByName(_ordered(whole))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """Per document row: size of its set, smallest id reachable over links of a similarity of at
    least ``percent``, and whether it is that one."""
    rows = narrow(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    sketch = rows.mapInArrow(_sketch, f"doc_id {kind}, words binary, n long, bands array<long>")
    sketch = stage(sketch, "sketches")

    nodes = sketch.where("n > 0").groupBy("words").agg(
        F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    nodes = stage(nodes, "nodes")
    placed = nodes.where("node is not null").select("node", "n", F.explode("bands").alias("bucket"))
    heads = placed.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("head"), F.count("*").alias("size"))
    placed = placed.join(heads.where("size > 1"), "bucket")
    placed = stage(placed.select("bucket", "node", "n", "head"), "buckets")
    star = placed.where(f"node != head.node and {near_size('n', 'head.n', percent)}")
    star = stage(star.select(F.col("node").alias("u"), F.col("head.node").alias("v")).distinct(), "star-pairs")

    wanted = placed.select(F.col("node").alias("doc_id")).distinct()
    texts = rows.join(wanted, "doc_id", "left_semi")
    sets = stage(texts.mapInArrow(_sets, f"node {kind}, shingles array<long>"), "shingle-sets")
    links = stage(confirmed(star, sets, percent), "star-links")
    first = stage(components(links), "star-components")

    sizes = first.groupBy("component").agg(F.count("*").alias("size"))
    known = first.join(sizes, "component")
    mine = placed.select("bucket", "node", "n").join(known, "node", "left")
    mine = mine.withColumn("component", F.coalesce("component", "node")).fillna(1, ["size"])
    mine = stage(mine, "bucket-components")
    mixed = mine.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a != b")
    mixed = mine.join(mixed.select("bucket"), "bucket", "left_semi")
    open_nodes = mixed.groupBy("node", "n", "component", "size").agg(F.count("*").alias("mixed")).where("mixed > 1")
    open_nodes = stage(open_nodes.drop("mixed"), "open-nodes")
    tokens = open_nodes.select("node").join(sets, "node").select("node", F.explode("shingles").alias("shingle"))
    tokens = stage(tokens, "open-shingles")
    more = stage(confirmed(crossing_pairs(open_nodes, tokens, percent), sets, percent), "crossing-links")

    # components joined by the further links; nodes without any stay their own
    label = first.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    joined = more.join(label, "v", "left").join(
        label.select(F.col("v").alias("u"), F.col("cv").alias("cu")), "u", "left"
    )
    joined = joined.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    second = components(joined).select(F.col("node").alias("component"), F.col("component").alias("final"))
    named = nodes.select("words", "node").join(first, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node")).join(second, "component", "left")
    named = named.select("words", F.coalesce("final", "component").alias("component_id"))
    out = sketch.select("doc_id", "n", "words").join(named, "words", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def keep_one(docs: DataFrame, text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents with one row of each group of near-duplicates, with all their columns."""
    row = fresh(docs, "row_number")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "dedup-input")
    kept = near_duplicates(numbered, row, text_col, percent).where("kept").select(F.col("doc_id").alias(row))
    return numbered.join(kept, row, "left_semi").select(*map(col_of, docs.columns))
