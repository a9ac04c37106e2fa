"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.sources.tables import stage


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("sum(hash(u, v)) as h"), F.expr("bit_xor(xxhash64(u, v)) as x")).first()
    return row["n"], row["h"], row["x"]


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node with an edge.

    Every round is written to the shared folder, so lost executors cost one round. A node with
    many neighbours is only ever met by a partial minimum and by a join that can be split.
    """
    now = edges.where(F.col(u) != F.col(v)).select(
        F.greatest(u, v).alias("u"), F.least(u, v).alias("v")
    ).distinct()
    now = stage(now, "stars")
    mark = _mark(now)
    while True:
        # each node points its larger neighbours at the smallest node around it
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # and itself and its smaller neighbours at the smallest of these
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where("u != v").unionByName(least.select("u", F.col("m").alias("v")))
        now = stage(small.distinct(), "stars")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    ends = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(ends)
