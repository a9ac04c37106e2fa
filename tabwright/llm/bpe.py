"""Byte-level BPE in SQL: each task holds a small DuckDB that merges and decodes its own rows.

Encoding. Texts are cut into words by the tokenizer's pattern; a word that occurs again is coded
once. A recursive query starts from one row per byte (word, place, token). Every round joins
neighbouring rows with the merge table, takes the smallest rank of each word, and contracts its
pairs of that rank from the left, until no word has a pair left.

Decoding. Token rows join the vocabulary; an aggregation ordered by position puts the bytes of
each text together again.

The merge table follows from the rank file: a token is the merge of any two tokens whose bytes
are its own. Texts are worked off in slices, words in batches, so memory is bounded; a task's
DuckDB has one thread, a memory limit, and spills to the executor's own temporary folder.

Cases: a null or empty text has no ids and decodes to nothing; strings of special tokens are
ordinary text; a very long word is merged like any other; repeated rows give repeated results;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tabwright.llm.common import narrow, slices
from tabwright.llm.pieces import cut, gather

#: Bytes of words merged by one query.
WORD_BYTES = 200_000
#: Words that a worker remembers, in two generations of this size: at most about 25 MB each.
MEMORY = 100_000
SLICE = 3 << 20
TOKENS = "doc_id {kind}, ids array<int>, decoded binary"

MERGE = """
with recursive t(w, g, id, len, live) as (
    select w, g, id, 1, true from bytes_of_words
    union all (
        with p as materialized (
            -- places leave a gap after every word, so that neighbours are of one word
            select a.w, a.g, a.len as l1, b.len as l2, m.merged
            from t a join t b on b.g = a.g + a.len join merges m on m.pair = (a.id::bigint << 32) + b.id
            where a.live
        ),
        best as materialized (select w, min(merged) as merged from p group by w),
        hit as materialized (
            select p.w, p.g, p.l1, p.l2, p.merged from p join best on best.w = p.w and best.merged = p.merged
        ),
        -- pairs that overlap stand in one run, of which every other one is contracted; they are rare
        tied as materialized (
            select a.g as g, b.g as next from hit a join hit b on b.g = a.g + a.l1
        ),
        ties as (select g, min(opens) as opens from (select g, 1 as opens from tied union all select next, 0 from tied) group by g),
        run as (select g, sum(opens) over (order by g) as r from ties),
        second as (
            select g from (select g, row_number() over (partition by r order by g) as k from run) where k % 2 = 0
        ),
        picked as materialized (select * from hit where g not in (select g from second)),
        edits as materialized (
            select g, merged, l1 + l2 as len from picked union all select g + l1, -1, 0 from picked
        )
        select t.w, t.g, coalesce(e.merged, t.id), coalesce(e.len, t.len), best.w is not null
        from t left join best on best.w = t.w left join edits e on e.g = t.g
        where t.live and (e.merged is null or e.merged >= 0)
    )
)
select w, id from t where not live order by w, g
"""

DECODE = """
select doc, string_agg(v.hex, '' order by pos) as hex
from tokens join vocabulary v on v.id = tokens.id group by doc order by doc
"""


class Coder:
    """One DuckDB with the tables of a rank file."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.find = regex.compile(pattern).findall
        # a batch of words takes a few MB; only a single word of many MB needs more, and nothing is spilt
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})
        pairs, merged = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    merged.append(rank)
        self._table("merges", pair=pa.array(pairs, pa.int64()), merged=pa.array(merged, pa.int32()))
        self._table(
            "vocabulary",
            id=pa.array(list(ranks.values()), pa.int32()),
            hex=pa.array([t.hex() for t in ranks]),
        )
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _table(self, name: str, **columns: pa.Array) -> None:
        source = pa.table(columns)  # noqa: F841  read by name
        self.db.execute(f"create or replace table {name} as from source")

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word by the recursive query, 32 bits each."""
        flat = np.frombuffer(b"".join(words), np.uint8)
        w = np.repeat(np.arange(len(words), dtype=np.int32), [len(x) for x in words])
        place = np.arange(len(flat), dtype=np.int32) + w
        self._table("bytes_of_words", w=pa.array(w), g=pa.array(place), id=pa.array(self.byte[flat]))
        rows = self.db.sql(MERGE).fetchnumpy()
        at = (4 * np.searchsorted(rows["w"], np.arange(len(words) + 1))).tolist()
        ids = np.asarray(rows["id"], "<i4").tobytes()
        return [ids[a:b] for a, b in zip(at, at[1:])]

    def words(self, words: list[str]) -> None:
        """Learns the ids of words not met before."""
        missing = [w for w in dict.fromkeys(words) if w not in self.known]
        self.known.update((w, self.older[w]) for w in missing if w in self.older)
        new = [w for w in missing if w not in self.known]
        batch, size = [], 0
        for k, w in enumerate(new):
            batch.append(w.encode())
            size += len(batch[-1])
            if size >= WORD_BYTES or k + 1 == len(new):
                names = new[k + 1 - len(batch) : k + 1]
                self.known.update(zip(names, self.merge(batch)))
                batch, size = [], 0

    def forget(self, most: int = MEMORY) -> None:
        """What has not been met since the last time goes, once there are ``most`` newer words."""
        if len(self.known) > most:
            self.known, self.older = {}, self.known

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and where each text begins."""
        pieces, codes, offsets = cut(texts)
        names = pieces.to_pylist()
        # most pieces are one word, met before
        parts = list(map(self.known.get, names))
        open_at = [k for k, got in enumerate(parts) if got is None]
        found = [self.find(names[k]) for k in open_at]
        self.words([w for words in found for w in words])
        for k, words in zip(open_at, found):
            parts[k] = b"".join(map(self.known.__getitem__, words))
        self.forget()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), "<i4")
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.concatenate([[0], np.cumsum(sizes[codes])])[offsets]
        return gather(starts, flat, codes), at

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """The bytes of every text from its ids."""
        out, texts, step = [b""] * (len(at) - 1), 0, 1 << 19
        cuts = [0, *(np.flatnonzero(np.diff(at[:-1] // step)) + 1).tolist(), len(at) - 1]
        for a, b in zip(cuts, cuts[1:]):
            some = ids[at[a] : at[b]]
            doc = np.repeat(np.arange(a, b), np.diff(at[a : b + 1]))
            self._table("tokens", doc=pa.array(doc), pos=pa.array(np.arange(len(some))), id=pa.array(some))
            for k, text in self.db.sql(DECODE).fetchall():
                out[k] = bytes.fromhex(text)
        return out


@cache
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def _slices(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[tuple]:
    run = coder(path, pattern)
    for batch in slices(batches, size=SLICE):
        ids, at = run.encode(batch.column("text"))
        yield batch, ids, at, run.decode(ids, at)
    # workers live on for other stages, which need the memory
    run.older = {}
    pa.default_memory_pool().release_unused()


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row its ids and the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, at, texts in _slices(batches, path, pattern):
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"]
            )

    rows = narrow(docs, id_col, text_col)
    return rows.mapInArrow(run, TOKENS.format(kind=rows.schema["doc_id"].dataType.simpleString()))


def digest(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids_too: bool = False
) -> DataFrame:
    """Per document row the number of its ids and digests of ids and decoded bytes (and the ids)."""

    def sha(x: bytes) -> str:
        return hashlib.sha256(x).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, at, texts in _slices(batches, path, pattern):
            lists = pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), pa.array(ids).cast(pa.large_string()))
            joined = pc.binary_join(lists, pa.scalar(",", pa.large_string())).to_pylist()
            own = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))] if ids_too else []
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(at)),
                    pa.array([sha(x.encode()) for x in joined], pa.string()),
                    pa.array([sha(x) for x in texts], pa.string()),
                    *own,
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids_too],
            )

    rows = narrow(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + ", ids array<int>" * ids_too)
