import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tabwright.llm import bpe
from tabwright.llm.decontaminate import contamination, digest
from tabwright.llm.minmax import near_duplicates
from tabwright.llm.toxicity import learn, score

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_against_their_operators(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    labels = spark.read.parquet(f"{tiny}/labels.parquet")
    bench = spark.read.parquet(f"{tiny}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    one = stages["toxicity"](spark, docs, tiny)
    assert one.columns == docs.columns
    assert ids(one) == ids(score(docs, learn(docs, labels)).where("predicted = 0"))
    two = stages["near_dedup"](spark, docs, tiny)
    assert ids(two) == ids(near_duplicates(docs, percent=80).where("kept"))
    three = stages["decontamination"](spark, docs, tiny)
    assert ids(three) == ids(digest(contamination(docs, bench)).where("not contaminated"))
    four = stages["secrets"](spark, docs, tiny)
    assert four.columns == docs.columns and ids(four) == ids(docs)
    assert four.where(F.col("text").contains("[secret]")).count() > 0


def test_run(spark, tiny):
    got = corpus_pipeline.run(spark, tiny).collect()
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    assert 0 < len(got) < docs.count() and len({r["doc_id"] for r in got}) == len(got)
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    texts = docs.join(spark.createDataFrame([(r["doc_id"],) for r in got], "doc_id long"), "doc_id")
    whole = bpe.digest(texts, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    same = {tuple(r) for r in whole.collect()} & {tuple(r)[:4] for r in got}
    assert len(same) > 0.9 * len(got)  # the others had a secret
