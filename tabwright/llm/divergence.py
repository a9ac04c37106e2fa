"""Quality by distribution divergence: a text's character classes and common words against
references of the languages, by Jensen-Shannon distance, beside plain base rules.

References come from all documents: a language is one that has at least 1/1000 of all words, a
word is common in it if it has at least 1/500 of the language's words. Both bounds make the
references small whatever the corpus: at most 1000 languages of 500 words, counted exactly.

A text is compared with the reference nearest to it, so a wrong or missing language mark does
not count against it. Common words hold only a part of a language, so how far a text can get from
its words differs: the word limit is a part of the distance that a text without any of the
reference's common words has. Short texts have unsteady histograms: below ``min_chars`` and
``min_words`` a distance is not judged.

Cases: a null or empty text has no words, fails the base rules and gets no distances; documents
without a language count for no reference and are judged by the nearest; a text marked with a
language that has no reference gets distances to the nearest, but is not judged by them; without
any reference nothing is judged by distance; repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import SPACES, col_of, plain_words, slices
from tabwright.llm.lexicon import common_words

LANGUAGE_SHARE = 1 / 1000
WORD_SHARE = 1 / 500
WINDOW = 8
SLICE = 6 << 20
MIN_CHARS, MIN_WORDS = 200, 60
MAX_CLASS_DISTANCE = 0.25
#: Of the distance that a text without common words has.
MAX_WORD_PART = 0.9

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

#: Character classes by UTF-8 byte: continuation bytes are none, a lead byte is one character.
CLASSES = ("space", "lower", "upper", "digit", "mark", "symbol", "other", "wide")
_CLASS = np.full(256, 6, np.uint8)
for _set, _kind in (
    (SPACES, 0),
    (range(97, 123), 1),
    (range(65, 91), 2),
    (range(48, 58), 3),
    (b".,;:'\"!?-()", 4),
    (SYMBOLS, 5),
    (range(0xC0, 256), 7),
    (range(0x80, 0xC0), 8),
):
    _CLASS[list(_set)] = _kind
_WHITE = SPACES.decode()
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64) | 1 for k in range(WINDOW)], np.uint64)

OUT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, language string, class_distance double, word_distance double, kept boolean"
)


def class_counts(texts: list[bytes]) -> np.ndarray:
    """Characters of each class, a row per text."""
    flat = _CLASS[np.frombuffer(b"".join(texts), np.uint8)]
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    return np.bincount(doc * 9 + flat, minlength=9 * len(texts)).reshape(-1, 9)[:, :8]


def repeated_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and those in runs of ``WINDOW`` words that the text has twice or more.

    Runs are found by a 64-bit hash; those whose hash repeats are then compared word by word.
    """
    words, sizes = [], []
    for t in texts:
        w = t.split()
        words += w
        sizes.append(len(w))
    sizes = np.array(sizes, np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    n = len(words) - WINDOW + 1
    if n <= 0:
        return sizes, np.zeros(len(texts), np.int64)
    code = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.uint64)
    at = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])
    key = doc[at].astype(np.uint64)
    for k in range(WINDOW):
        key = (key ^ (key >> np.uint64(29))) * _ODD[k] + code[at + k]
    order = np.sort(key)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return sizes, np.zeros(len(texts), np.int64)
    found = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    at = at[twice[found] == key]
    runs = np.stack([doc[at].astype(np.uint64), *(code[at + k] for k in range(WINDOW))], axis=1)
    _, which, counts = np.unique(runs, axis=0, return_inverse=True, return_counts=True)
    at = at[counts[which.ravel()] > 1]
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return sizes, np.bincount(doc[np.cumsum(edge)[:-1] > 0], minlength=len(texts))


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(_WHITE)]
    return len(lines) - len(set(lines))


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (root of the divergence in bits) of each row of ``p`` to ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def plain_text(text: str) -> list[str]:
    return [w.decode() for w in plain_words(text)]


def references(docs: DataFrame) -> list[tuple[str, np.ndarray, dict[bytes, float]]]:
    """Language, class shares, and shares of its common words. Reads ``lang`` and ``text``."""
    found = common_words(
        docs.select(F.col("lang").alias("key"), "text"),
        WORD_SHARE,
        plain_text,
        lambda texts: class_counts([t.encode() for t in texts]).sum(0).tolist(),
        len(CLASSES),
        LANGUAGE_SHARE,
    )
    return [
        (lang, np.array(classes) / max(1, sum(classes)), {w.encode(): n / total for w, n in words.items()})
        for lang, (total, classes, words) in sorted(found.items())
    ]


def quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    min_chars: int = MIN_CHARS,
    min_words: int = MIN_WORDS,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_part: float = MAX_WORD_PART,
) -> DataFrame:
    """Per document row the base figures, the nearest language, both distances and the verdict."""
    rows = docs.select(
        col_of(id_col).alias("doc_id"),
        F.coalesce(col_of(text_col), F.lit("")).alias("text"),
        col_of(lang_col).cast("string").alias("lang"),
    )
    refs = references(rows.select("lang", "text"))
    shared = docs.sparkSession.sparkContext.broadcast(refs)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = shared.value
        vocab = {w: i for i, w in enumerate(sorted({w for _, _, words in refs for w in words}))}
        columns = [np.array([vocab[w] for w in words], np.int64) for _, _, words in refs]
        shares = [np.array(list(words.values()), float) for _, _, words in refs]
        known = {None, *(lang for lang, _, _ in refs)}
        limits = np.array([max_word_part * wordless(q) for q in shares] or [np.nan])
        for batch in slices(batches, size=SLICE):
            texts = batch.column("text").to_pylist()
            raw = [t.encode() for t in texts]
            n_words, repeats = repeated_words(raw)
            classes = class_counts(raw)
            chars = classes.sum(1)
            lines = np.fromiter(map(duplicate_lines, texts), np.int64, len(texts))
            failed = (n_words < 20) | (100 * repeats > 30 * n_words)
            plain = [plain_words(t) for t in texts]
            sizes = np.fromiter(map(len, plain), np.int64, len(plain))
            flat = [w for x in plain for w in x]
            code = np.fromiter(map(vocab.get, flat, repeat(len(vocab))), np.int64, len(flat))
            width = len(vocab) + 1
            key, n = np.unique(np.repeat(np.arange(len(texts)), sizes) * width + code, return_counts=True)
            doc, word = key // width, key % width
            far_class = np.full((len(texts), max(1, len(refs))), np.nan)
            far_word = far_class.copy()
            for k, (_, reference, _) in enumerate(refs):
                p = classes / np.maximum(1, chars)[:, None]
                far_class[:, k] = distance(p, reference)
                slot = np.full(width, -1)
                slot[columns[k]] = np.arange(len(columns[k]))
                own = slot[word] >= 0
                far_word[:, k] = sparse_distance(
                    doc[own], slot[word[own]], n[own], sizes, np.append(shares[k], 1 - shares[k].sum())
                )
            near = np.zeros(len(texts), int)
            if refs:
                near = np.argmin(far_class + far_word, axis=1)
            pick = np.arange(len(texts)), near
            a, b = far_class[pick], far_word[pick]
            some = (sizes > 0) & bool(refs)
            bad = (chars >= min_chars) & (a > max_class_distance)
            bad |= (sizes >= min_words) & (b > limits[near])
            bad &= np.fromiter((lang in known for lang in batch.column("lang").to_pylist()), bool, len(texts))
            names = [refs[k][0] if ok else None for k, ok in zip(near, some)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words),
                    pa.array((classes[:, 1:]).sum(1)),
                    pa.array(classes[:, 5]),
                    pa.array(lines),
                    pa.array(repeats),
                    pa.array(failed),
                    pa.array(names, pa.string()),
                    pa.array(a, mask=~some),
                    pa.array(b, mask=~some),
                    pa.array(~(failed | (bad & some))),
                ],
                ["doc_id", *(c.split()[0] for c in OUT.split(", "))],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, {OUT}")


def wordless(shares: np.ndarray) -> float:
    """Distance of a text without common words to a reference with these ``shares`` of them."""
    q = np.append(shares, max(0.0, 1 - shares.sum()))
    return float(distance(np.append(np.zeros(len(shares)), 1.0)[None], q)[0])


def sparse_distance(
    doc: np.ndarray, slot: np.ndarray, n: np.ndarray, sizes: np.ndarray, q: np.ndarray
) -> np.ndarray:
    """As ``distance`` for word histograms given by their non-empty bins; the last bin of ``q``
    takes all other words."""
    total = np.maximum(1, sizes)
    rest = sizes - np.bincount(doc, n, len(sizes))
    p = n / total[doc]

    def part(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        m = (p + q) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)

    # a bin without words of the text adds q * log2(2) = q
    seen = np.bincount(doc, part(p, q[slot]) - q[slot], len(sizes))
    both = seen + q[:-1].sum() + part(rest / total, np.full(len(sizes), q[-1]))
    return np.sqrt(np.clip(both / 2, 0, 1))
