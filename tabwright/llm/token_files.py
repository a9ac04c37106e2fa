"""Token ids of all documents as flat unsigned integer files with 64-bit document offsets.

Documents are range-partitioned by id, every task encodes its range and writes three files to
the shared folder: the ids (`.bin`, little-endian, 16 bit if the vocabulary allows), the
document offsets within the part (`.off`, unsigned 64 bit, one more than documents) and the
document ids (`.doc`, signed 64 bit). Where a part begins in the whole sequence is the prefix
sum of the parts before; the manifest keeps it. Readers map the files into memory.

Every attempt of a task writes under a name of its own and only the files of attempts that
Spark reports back enter the manifest, so lost executors and repeated tasks do no harm.

Cases: a null text is empty and gives the end id alone; a null document id comes first and is
stored as the smallest 64-bit integer; rows that repeat a document id are all kept, in the
order of their text hashes; an empty table gives no part; other columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.common import narrow, slices
from tabwright.llm.pieces import cut, gather
from tabwright.session import work_path

NO_ID = -(1 << 63)
#: Pre-tokens whose ids a worker remembers.
MEMORY = 1_000_000
INDEX = "part int, path string, docs long, tokens long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"

#: Below it the classes of characters are the same in every version of Unicode; texts with
#: characters from there on leave the cutting into words to the tokenizers library.
STABLE = "\u0250"

#: The pre-tokenisation pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids of texts by a byte-level tokenizer file; a pre-token is encoded once per worker."""

    def __init__(self, path: str, special_as_text: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: strings that the library gives a token of their own, wherever they stand
        self.whole = [] if special_as_text else [t.content for t in added]
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.find = regex.compile(PATTERN).findall
        self.known: dict[str, bytes] = {}
        # byte-level vocabularies name bytes by printable characters; the others follow from 256 on
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = (b for b in range(256) if b not in shown)
        self.names = {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.space = self.names[32]

    def word(self, word: str) -> bytes:
        """Ids of one pre-token of characters below ``STABLE``."""
        if word.isascii() and word.isprintable():
            named = word.replace(" ", self.space)
        else:
            named = word.encode().decode("latin-1").translate(self.names)
        return array(self.kind.char, [t.id for t in self.model.tokenize(named)]).tobytes()

    def piece(self, piece: str) -> bytes:
        known = self.known
        got = known.get(piece)
        if got is not None:
            return got
        if piece and (max(piece) >= STABLE or any(t in piece for t in self.whole)):
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            return array(self.kind.char, ids).tobytes()
        out = []
        for w in self.find(piece):
            got = known.get(w)
            if got is None:
                if len(known) >= MEMORY:
                    known.clear()
                got = self.word(w)
                if len(w) < 64:
                    known[w] = got
            out.append(got)
        return b"".join(out)

    def batch(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, ``end`` after each, and where each text begins."""
        pieces, codes, offsets = cut(texts)
        coded = [self.piece(p) for p in pieces.to_pylist()]
        flat = np.frombuffer(b"".join(coded), self.kind)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // self.kind.itemsize
        starts = np.concatenate([[0], np.cumsum(sizes)])
        ids = gather(starts, flat, codes)
        at = np.concatenate([[0], np.cumsum(sizes[codes])])[offsets]
        ids = np.insert(ids, at[1:], end)
        return ids, at + np.arange(len(at))


@cache
def encoder(path: str, special_as_text: bool = True) -> Encoder:
    return Encoder(path, special_as_text)


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder)


def _map(fs: pafs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file as an array: mapped where the folder is a local mount, read otherwise."""
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
    special_as_text: bool = True,
) -> tuple[str, list[dict]]:
    """Writes the files and returns their folder and manifest, one entry per part with its base.

    Strings of special tokens are ordinary text, or, without ``special_as_text``, get their tokens,
    as the library does when it is left as it is.
    """
    spark = docs.sparkSession
    folder = folder or work_path(spark, "token-files")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, coder, files = TaskContext.get().partitionId(), encoder(tokenizer, special_as_text), None
        n = total = 0
        for batch in slices(batches):
            if files is None:
                fs, base = _open(folder)
                fs.create_dir(base, recursive=True)
                name = f"part-{part:06d}-{uuid.uuid4().hex}"
                files = [fs.open_output_stream(f"{base}/{name}.{x}") for x in ("bin", "off", "doc")]
            ids, at = coder.batch(batch.column("text"), end_id)
            if end_id > np.iinfo(coder.kind).max:
                raise ValueError(f"end id {end_id} does not fit {coder.kind}")
            files[0].write(ids.astype(coder.kind, copy=False).tobytes())
            files[1].write((at[:-1] + total).astype("<u8").tobytes())
            files[2].write(pc.fill_null(batch.column("doc_id"), NO_ID).to_numpy().astype("<i8").tobytes())
            n, total = n + len(batch), total + len(ids)
        if files:
            files[1].write(np.array([total], "<u8").tobytes())
            for f in files:
                f.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name]), pa.array([n]), pa.array([total])],
                ["part", "path", "docs", "tokens"],
            )

    rows = narrow(docs, id_col, text_col)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # equal ids may be many: hash and row number let them spread over parts
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("n", F.monotonically_increasing_id())
    keys = [F.col("doc_id").asc_nulls_first(), "h", "n"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    # one row per part reaches the driver
    parts = sorted(ordered.mapInArrow(write, INDEX).collect(), key=lambda r: r["part"])
    bases = accumulate((p["tokens"] for p in parts), initial=0)
    return folder, [p.asDict() | {"base": b} for p, b in zip(parts, bases)]


def read_token_files(spark: SparkSession, folder: str, parts: list[dict], tokenizer: str) -> DataFrame:
    """One row per document from the mapped files: where it starts, its length and checksum."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        kind = encoder(tokenizer).kind
        for batch in batches:
            for i in batch.column(0).to_pylist():
                part = parts[i]
                ids, at, docs = (
                    _map(fs, f"{base}/{part['path']}.{x}", k)
                    for x, k in (("bin", kind), ("off", "<u8"), ("doc", "<i8"))
                )
                at = at.astype(np.int64)
                for lo in range(0, len(docs), 4096):
                    hi = min(lo + 4096, len(docs))
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[lo:hi], at[lo + 1 : hi + 1])]
                    names = np.asarray(docs[lo:hi])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names, pa.int64(), mask=names == NO_ID),
                            pa.array(at[lo:hi] + part["base"]),
                            pa.array(np.diff(at[lo : hi + 1])),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInArrow(read, ROWS)
