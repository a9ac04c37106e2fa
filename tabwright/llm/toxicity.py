"""Toxicity by compression distance: which of two trained zstandard dictionaries codes a window shorter.

Both dictionaries come from zstandard's trainer, over raw bytes. The ordinary one is trained on ordinary
texts. The toxic one is trained on the windows of toxic texts, weighted by class: of each
only the stretches count whose byte strings toxic texts hold significantly more often than ordinary
ones (the trainer picks what is frequent, and ordinary syllables are frequent in both
classes), and filled up with stretches that the trainer left out; it ends with the strongest part of the ordinary dictionary, so that ordinary prose costs
nearly the same under either. A window is one word with the spaces around it, as long windows drown a
word's bytes in the noise of the others; strings match in part, so compounds and inflections of a
toxic stem count that no text of the sample had. Thresholds are calibrated: how many windows save each number of
bytes under the toxic dictionary, by length of the text, goes through a logistic regression.

Stretches are found by strings of one length or of several; which suits the corpus, and how often
ordinary texts may have them, is chosen by the calibration texts among ``CHOICES``.

Learning uses rows whose ``crc32(id as text) mod 5`` is not 0: remainders 1 to 3 for the
dictionaries, 4 for the calibration. It is bounded by ``per_class`` labelled documents of each class
and use (those with the smallest id hashes) of at most ``LEARN_CHARS`` characters, and by
``PLAIN_TEXTS`` ordinary texts for the trainer; everything else covers all rows. Scores depend on
the text alone.

Cases: a null or empty text has no windows and gets the score of no gain; rows without label are
scored, not learnt from; of labels that contradict each other, on one id or on equal texts, the toxic one
counts; without toxic or without ordinary labels every score is the share of toxic labels; repeated rows
give repeated results; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import col_of, plain_words, slices
from tabwright.sources.tables import stage

FOLDS = 5
PER_CLASS = 2_000
#: Longer texts are not used for learning, so the sample is bounded in bytes too.
LEARN_CHARS = 20_000
#: Ordinary texts that the trainer sees.
PLAIN_TEXTS = 500
#: Longest window; a longer word is cut.
WINDOW = 48
#: Lengths of strings, how often ordinary texts may have them as a share of toxic ones, least standard
#: errors, bytes of the toxic dictionary, and the trainer's segment and string lengths.
CHOICES = (
    ((5,), 0.05, 5.0, 4096, 24, 6),
    ((5, 8, 12), 0.05, 4.0, 8192, 24, 6),
    ((8, 12, 16), 0.1, 4.0, 8192, 40, 8),
)
LEAST_DOCS = 4
ORDINARY_BYTES, SHARED_BYTES = 6144, 2048
GAINS = (1, 2, 3, 4, 5, 6, 8)
SLICE = 4 << 20
#: Gains of words that a worker remembers.
MEMORY = 200_000


def remainder(id_col: Column, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """Every word with a space on both sides; a longer word is cut."""
    out = []
    for word in plain_words(text):
        out += [word] if len(word) <= size else [word[k : k + size] for k in range(0, len(word), size)]
    return [b" " + w + b" " for w in out]


def strings(text: bytes, size: int) -> np.ndarray:
    """A code for the string of ``size`` bytes at every place of a text."""
    data = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    n = max(0, len(data) - size + 1)
    code = np.full(n, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + data[k : k + n]
    return code.view(np.int64)


def line(text: str) -> bytes:
    """A text's words with one space around each."""
    return b" " + b" ".join(plain_words(text)) + b" "


def stretches(text: bytes, marks: dict[int, np.ndarray]) -> list[bytes]:
    """The parts of a text's words that are covered by marked strings."""
    covered = np.zeros(len(text), bool)
    for size, marked in marks.items():
        for at in np.flatnonzero(np.isin(strings(text, size), marked)).tolist():
            covered[at : at + size] = True
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32).tolist()
    parts = []
    for a, b in zip(spaces, spaces[1:]):
        inside = np.flatnonzero(covered[a : b + 1])
        if len(inside) > 3:
            parts.append(text[a + int(inside[0]) : a + int(inside[-1]) + 1])
    return parts


def trained(samples: list[bytes], size: int, segment: int = 32, string: int = 8) -> bytes:
    """A dictionary from samples; the last of them where there is too little to train on."""
    try:
        return zs.train_dictionary(size, samples, k=segment, d=string).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[-size:]


def filled(dictionary: bytes, parts: Counter, size: int) -> bytes:
    """The dictionary with the most frequent stretches that its trainer left out, as far as they fit."""
    room, more = size - len(dictionary), []
    for part, _ in sorted(parts.items(), key=lambda x: (-x[1], x[0])):
        if len(part) <= room and part not in dictionary:
            more.append(part)
            room -= len(part)
    return b"".join(reversed(more)) + dictionary


class Model:
    """Two dictionaries and the weights of the calibration."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.ordinary, self.toxic = ordinary, toxic
        self.weights = np.zeros(len(GAINS) + 2)

    def open(self) -> Model:
        parameters = zs.ZstdCompressionParameters(
            window_log=17,
            hash_log=15,
            chain_log=15,
            search_log=6,
            min_match=4,
            target_length=64,
            strategy=zs.STRATEGY_BTLAZY2,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        self.coders = [
            zs.ZstdCompressor(
                dict_data=zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT),
                compression_params=parameters,
            )
            for content in (self.ordinary, self.toxic + self.ordinary[-SHARED_BYTES:])
        ]
        # a known beginning keeps a window from being stored uncompressed, and the last bytes of a
        # frame are never matched
        self.frame = self.ordinary[-24:], b"\0" * 8
        self.known: dict[bytes, int] = {}
        return self

    def gains(self, parts: list[bytes]) -> np.ndarray:
        """Bytes that each window saves under the toxic dictionary."""
        new = [w for w in dict.fromkeys(parts) if w not in self.known]
        if len(self.known) + len(new) > MEMORY:
            self.known = {}
            new = list(dict.fromkeys(parts))
        if new:
            head, tail = self.frame
            framed = [head + w + tail for w in new]
            plain, toxic = (c.multi_compress_to_buffer(framed) for c in self.coders)
            self.known.update((w, len(plain[i]) - len(toxic[i])) for i, w in enumerate(new))
        return np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: windows that reach each gain (logarithm), windows in all, and a constant."""
        parts = [windows(t) for t in texts]
        counts = np.array([len(p) for p in parts], np.int64)
        flat = [w for p in parts for w in p]
        out = np.zeros((len(texts), len(GAINS) + 2))
        if flat and self.toxic:
            gain = self.gains(flat)
            doc = np.repeat(np.arange(len(texts)), counts)
            for k, least in enumerate(GAINS):
                out[:, k] = np.log2(1 + np.bincount(doc[gain >= least], minlength=len(texts)))
        out[:, -2] = np.log2(1 + counts) / 8
        out[:, -1] = 1
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, penalty: float = 0.2) -> float:
        """Logistic regression by Newton steps, ridge on all but the constant; returns its loss."""
        w = np.zeros(x.shape[1])
        ridge = np.full(len(w), penalty)
        ridge[-1] = 1e-6
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (p - y) + ridge * w
            bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
            step = np.linalg.solve(bend, slope)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w
        p = np.clip(self.score(x), 1e-9, 1 - 1e-9)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum() + (ridge * w * w).sum() / 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _counted(early: DataFrame, sizes: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per size the strings of at least ``LEAST_DOCS`` toxic texts, and how many toxic and ordinary texts have each."""

    def toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE):
            lines = [line(t) for t in batch.column("text").to_pylist()]
            for size in sizes:
                code, n = np.unique(np.concatenate([np.unique(strings(x, size)) for x in lines]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(code), size, np.int32)), pa.array(code), pa.array(n)], ["size", "code", "n"]
                )

    schema = "size int, code long, n long"
    few = early.where("y = 1").select("text").mapInArrow(toxic, schema).groupBy("size", "code").agg(F.sum("n").alias("n"))
    # strings of the bounded sample
    rows = few.where(F.col("n") >= LEAST_DOCS).toArrow()
    of, code, n = (rows.column(c).to_numpy() for c in ("size", "code", "n"))
    found = {}
    for size in sizes:
        order = np.argsort(code[of == size])
        found[size] = code[of == size][order], n[of == size][order]
    wanted = {size: codes for size, (codes, _) in found.items()}

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SLICE):
            lines = [line(t) for t in batch.column("text").to_pylist()]
            for size in sizes:
                codes = wanted[size]
                count = np.zeros(len(codes) + 1, np.int64)
                for x in lines:
                    own = np.unique(strings(x, size))
                    at = np.searchsorted(codes, own)
                    known = at < len(codes)
                    known[known] = codes[at[known]] == own[known]
                    count[at[known]] += 1
                some = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), size, np.int32)), pa.array(codes[some]), pa.array(count[some])],
                    ["size", "code", "n"],
                )

    rows = early.where("y = 0").select("text").mapInArrow(plain, schema).groupBy("size", "code").agg(F.sum("n").alias("n"))
    rows = rows.toArrow()
    of, code, n = (rows.column(c).to_numpy() for c in ("size", "code", "n"))
    out = {}
    for size, (codes, a) in found.items():
        b = np.zeros(len(codes))
        b[np.searchsorted(codes, code[of == size])] = n[of == size]
        out[size] = codes, a, b
    return out


def _sample(docs: DataFrame, marked: DataFrame, id_col: str, text_col: str, per_class: int) -> DataFrame:
    """``text, y, late``: the bounded sample, each text once."""
    texts = docs.select(col_of(id_col).alias("id"), col_of(text_col).alias("text"))
    fits = texts.where(F.char_length("text").between(1, LEARN_CHARS))
    # only ids that have a text to learn from are drawn
    marked = marked.join(fits.select("id").distinct(), "id", "left_semi")
    drawn = None
    for use in (F.col("fold") < FOLDS - 1, F.col("fold") == FOLDS - 1):
        for y in (0, 1):
            part = marked.where(use & (F.col("y") == y)).orderBy(F.xxhash64("id"), "id").limit(per_class)
            drawn = part if drawn is None else drawn.union(part)
    # at most four times per_class rows
    sample = fits.join(F.broadcast(drawn), "id")
    late = F.col("fold") == FOLDS - 1
    return sample.groupBy("text").agg(F.max("y").alias("y"), F.min(late).alias("late"))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    label_id_col: str = "doc_id",
    per_class: int = PER_CLASS,
) -> Model:
    """Dictionaries and calibration from a bounded sample of labelled rows."""
    marked = (
        labels.select(col_of(label_id_col).alias("id"), col_of(label_col).cast("int").alias("y"))
        .dropna()
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .withColumn("fold", remainder(F.col("id")))
        .where("fold > 0")
    )
    sample = stage(_sample(docs, marked, id_col, text_col, per_class), "toxic-sample")
    early, late = sample.where("not late"), sample.where("late")
    sizes = {bool(r["y"]): r["n"] for r in early.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic_n, plain_n = sizes.get(True, 0), sizes.get(False, 0)
    models = [Model(b"", b"")]
    if toxic_n and plain_n:
        models = _dictionaries(early, toxic_n, plain_n)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [m.open() for m in models]
        for batch in slices(batches, size=SLICE):
            texts = batch.column("text").to_pylist()
            x = np.concatenate([m.features(texts) for m in ready], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(list(x))], ["y", "x"])

    rows = late.select("text", "y").mapInArrow(measure, "y int, x array<double>").collect()
    if not rows:
        return models[0]
    y, x = np.array([r["y"] for r in rows], float), np.array([r["x"] for r in rows])
    losses = [m.fit(part, y) for m, part in zip(models, np.split(x, len(models), axis=1))]
    return models[int(np.argmin(losses))]


def _dictionaries(early: DataFrame, toxic_n: int, plain_n: int) -> list[Model]:
    """One model per choice, without weights."""
    counted = _counted(early, sorted({size for c in CHOICES for size in c[0]}))
    marks = []
    for lengths, rare, errors, *_ in CHOICES:
        own = {}
        for size in lengths:
            codes, a, b = counted[size]
            share = (a + b) / (toxic_n + plain_n)
            spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / toxic_n + 1 / plain_n))
            z = (a / toxic_n - b / plain_n) / spread
            own[size] = codes[(z >= errors) & (b / plain_n < rare * a / toxic_n)]
        marks.append(own)

    def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.binary())
        for batch in slices(batches, size=SLICE):
            lines = [line(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([stretches(x, m) for x in lines], kind) for m in marks]
            yield pa.RecordBatch.from_arrays(columns, [f"s{k}" for k in range(len(marks))])

    schema = ", ".join(f"s{k} array<binary>" for k in range(len(marks)))
    # of the bounded sample
    rows = early.where("y = 1").select("text").mapInArrow(weighted, schema).collect()
    plain = early.where("y = 0").orderBy(F.xxhash64("text")).limit(PLAIN_TEXTS).collect()
    ordinary = trained([line(r["text"]) for r in plain], ORDINARY_BYTES)
    models = []
    for k, (_, _, _, size, segment, string) in enumerate(CHOICES):
        found = [[bytes(p) for p in r[k]] for r in rows]
        # sorted, so that the trainer sees them in the same order each time
        samples = sorted(b"".join(parts) for parts in found if parts)
        toxic = trained(samples, size, segment, string) if samples else b""
        parts = Counter(p for parts in found for p in set(parts))
        models.append(Model(ordinary, filled(toxic, parts, size)))
    return models


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row its id, score from 0 to 1, and 1 where the score is at least 0.5."""
    rows = docs.select(col_of(id_col).alias("doc_id"), F.coalesce(col_of(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = model.open()
        for batch in slices(batches, size=SLICE):
            s = ready.score(ready.features(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that the model does not reject, with all their columns."""
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = model.open()
        for batch in slices(batches, text_col, SLICE):
            texts = ["" if t is None else t for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(ready.score(ready.features(texts)) < 0.5))

    return docs.mapInArrow(run, docs.schema) if names else docs
