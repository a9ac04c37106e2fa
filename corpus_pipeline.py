"""From raw documents to token ids: each stage works on all rows that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import bpe, decontaminate, minmax, secrets, toxicity
from tabwright.llm.common import table
from tabwright.sources.tables import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance takes for toxic go."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, of a similarity of 0.8 or more, stays."""
    return minmax.keep_one(docs, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in it are blanked out."""
    return secrets.redact(docs, chars_col="n_chars")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of them and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digest(docs, path, public_tokenizers.PATTERN, ids_too=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("byte_bpe", tokenize),
]

#: Compression lengths, a forest and recursive merges are beyond SQL; tests/llm compares each
#: stage with its operator, which is tested by itself.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
