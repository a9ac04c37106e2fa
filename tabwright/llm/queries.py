"""One registered query per operator of this package, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.common import table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.url_filter import judge

    return judge(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.toxicity import learn, remainder, score

    docs = table(spark, sf_dir, "documents")
    scored = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("held_out", remainder(F.col("doc_id")) == 0)


def op3_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.divergence import quality

    return quality(table(spark, sf_dir, "documents"))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.hilbert import shard

    placed = shard(table(spark, sf_dir, "documents"))
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.decontaminate import contamination, digest

    return digest(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.minmax import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.secrets import scan

    return scan(table(spark, sf_dir, "documents")).drop("row")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.bpe import digest

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digest(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


#: A conversation whose texts hold the control strings of common templates.
TRAP = r"\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.chat import digest, read_back, segments, write_examples

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = [(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)]
    turns = turns.unionByName(spark.createDataFrame(trap, turns.schema))
    stored, examples = write_examples(segments(turns))
    return digest(read_back(stored, examples))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.token_files import read_token_files, write_token_files

    path = public_tokenizers.path("byte_bpe_50k.json")
    folder, parts = write_token_files(table(spark, sf_dir, "documents"), path, end_id=2, special_as_text=False)
    return read_token_files(spark, folder, parts, path)


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.suffix_dedup import cut, digest

    return digest(cut(table(spark, sf_dir, "documents")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.hard_negatives import mine

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), label, F.col("id") % 100 == 0)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabwright.llm.filter_audit import audit, counts, text_failures

    conditions = text_failures(F.coalesce(F.col("text"), F.lit("")))
    found = counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), conditions)
    return audit(found, "ABCDE")


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_toxicity": op2_toxicity,
    "op3_divergence": op3_divergence,
    "op4_hilbert_shards": op4_hilbert_shards,
    "op5_decontaminate": op5_decontaminate,
    "op6_minmax_dedup": op6_minmax_dedup,
    "op7_secrets": op7_secrets,
    "op8_bpe": op8_bpe,
    "op9_chat": op9_chat,
    "op10_token_files": op10_token_files,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_filter_audit": op13_filter_audit,
}
