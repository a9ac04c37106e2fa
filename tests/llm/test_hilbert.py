import zlib

import pytest
from pyspark.sql import functions as F

from tabwright.llm.hilbert import curve_index, quantised, shard, write_shards


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (1, 3), (2, 1)])
def test_curve_visits_every_cell_in_unit_steps(spark, dims, bits):
    side = 1 << bits
    cells = [F.expr(f"cast(id div {side**k} % {side} as int)").alias(f"c{k}") for k in range(dims)]
    grid = spark.range(side**dims).select(*cells)
    rows = grid.withColumn("at", curve_index([F.col(c) for c in grid.columns], bits)).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(side**dims))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[f"c{k}"] - b[f"c{k}"]) for k in range(dims)) == 1


def test_shards_of_awkward_rows(spark, awkward, no_docs):
    docs = awkward.unionByName(awkward).unionByName(awkward)
    got = shard(docs, shards=4).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(x) for x in by.values()]
    assert set(by) == {0, 1, 2, 3} and max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert want == sorted((r["doc_id"] or -1, r["size"], r["text_crc32"]) for r in got)
    assert shard(no_docs).collect() == []
    assert sorted(r["shard"] for r in shard(awkward.limit(3), shards=8).collect()) == [0, 2, 5]


def test_files_prune_every_dimension(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id as doc_id", "cast(id as string) as text", "id % 64 as a", "(id * 7) div 64 % 64 as b")
    out = write_shards(rows, str(tmp_path / "out"), ["a", "b"], shards=16)
    assert out.count() == 4000
    for c in ("a", "b"):
        spans = out.groupBy("shard").agg((F.max(c) - F.min(c)).alias("w")).agg(F.avg("w")).first()[0]
        assert spans < 32  # a cut by rows alone would span all 64 in one of the two


def test_texts_with_a_common_beginning_keep_their_axis(spark):
    rows = spark.range(3200).selectExpr(
        "id as doc_id", "cast(id as string) as text", "concat('https://example.org/', lpad(cast(id * 37 % 64 as string), 2, '0')) as source"
    )
    one, = quantised(rows, ["source"], 4)
    cells = rows.select("source", one.alias("cell"))
    sizes = {r["cell"]: r["n"] for r in cells.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    assert len(sizes) == 16 and max(sizes.values()) <= 5 * 50
    spans = cells.groupBy("source").agg(F.count_distinct("cell").alias("n")).agg(F.max("n")).first()[0]
    assert spans == 1
    order = cells.distinct().orderBy("source").collect()
    assert [r["cell"] for r in order] == sorted(r["cell"] for r in order)


def test_equal_texts_of_a_hot_cell_stay_together(spark):
    rows = spark.range(1000).selectExpr("id as doc_id", "concat('text ', cast(id % 100 as string)) as text", "'hot' as source")
    got = shard(rows, dimensions=["source"], shards=10).join(rows, "doc_id")
    apart = got.groupBy("text").agg(F.count_distinct("shard").alias("n")).agg(F.sum("n")).first()[0]
    assert apart <= 100 + 9  # a text is parted at a cut at most
