"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts of a batch that Python works on at once, in bytes (a longer text is one slice).
SLICE_BYTES = 8 << 20

#: Bytes below 0x80 that are white space in the contracts: [\x20\x09-\x0D].
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


#: A-Z become a-z; of ASCII only 0-9 and a-z belong to words, of the rest everything.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def plain_words(text: str) -> list[bytes]:
    """Words of letters and digits, lower-cased in ASCII, as UTF-8."""
    return text.encode().translate(_PLAIN).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col_of(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet."""
    have, name = {c.lower() for c in df.columns}, stem
    while name.lower() in have:
        name = f"{name}_"
    return name


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, under fixed names; a null text becomes an empty one."""
    return df.select(
        col_of(id_col).alias("doc_id"), F.coalesce(col_of(text_col), F.lit("")).alias("text")
    )


def slices(
    batches: Iterator[pa.RecordBatch], text_col: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``size`` bytes of text, so that memory stays bounded."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(text_col)).fill_null(0).to_numpy()
        block = np.cumsum(lengths.astype(np.int64)) // size
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(lengths)]):
            yield batch.slice(a, b - a)
