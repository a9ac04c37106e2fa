"""Cuts texts where byte-level BPE pre-tokenisation always cuts, so that equal pieces are coded once.

The pattern of the byte-level tokenizers never joins what stands on both sides of a space that
has a visible character before or after it, and such a space begins the token that follows.
Texts can therefore be cut before every such space, and a piece has the same tokens wherever
it stands. A text in which a space stands between other white space (or ends a text after
white space) stays one piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
#: A space that no cut may precede: white space on its left, and white space or the end on its right.
UNSAFE = rf"{_WHITE} (?:{_WHITE}|\z)"


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pieces, the piece numbers of all texts one after another, and where each text begins."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    mark = next(
        m for m in map(chr, range(0xE000, 0x10FFFF)) if not pc.any(pc.match_substring(texts, m)).as_py()
    ) if len(texts) else ""
    marked = pc.if_else(
        pc.match_substring_regex(texts, UNSAFE), texts, pc.replace_substring(texts, " ", f"{mark} ")
    )
    lists = pc.split_pattern(marked, mark)
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return coded.dictionary, coded.indices.to_numpy(), offsets - offsets[0]


def gather(starts: np.ndarray, values: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """``values[starts[c]:starts[c + 1]]`` for every code, one after another."""
    lists = pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), pa.array(values))
    return lists.take(pa.array(codes, pa.int64())).flatten().to_numpy()
