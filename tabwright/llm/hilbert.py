"""Sharding along a Hilbert curve: rows near in several metadata columns share a file.

Each dimension is quantised to ``2 ** bits`` cells at its quantiles (text by whole values),
the cells are numbered along a Hilbert curve, rows are ordered by that number and the order is
cut into runs of equal row counts (law ``rows``: counts differ by one at most). Files then cover
small boxes in every dimension, and readers that filter on any of them skip most files.

Only DataFrame functions are used. One pass over the texts writes a narrow table (id, size,
checksum, dimensions); all further steps work on it. The order is settled by range partitioning
with the row number as last key, so a cell, a source or an id that holds a third of all rows
spreads over many tasks. Ranks are the row's place in its partition plus the prefix sum of the
partitions before.

Cases: null dimensions come first on their axis; a null text has size 8 and the checksum of no
bytes; equal rows get neighbouring slots; fewer rows than shards leave shards empty; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import col_of
from tabwright.session import work_path

BITS = 4
SHARDS = 24
DIMENSIONS = ("source", "lang", "n_chars")


def measure(df: DataFrame, name: str) -> Column:
    """A dimension as a number, or the bytes of a text, in the column's order."""
    kind = df.schema[name].dataType
    c = col_of(name)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return c.cast("binary")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def curve_index(cells: Sequence[Column], bits: int) -> Column:
    """Place of a cell along the Hilbert curve of ``2 ** bits`` cells a side (Skilling's transform)."""
    n = len(cells)
    steps = F.array(
        *(
            F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
            for b in range(bits - 1, 0, -1)
            for i in range(n)
        )
    )
    axes = F.array(*(c.cast("int") for c in cells))

    def turn(x: Column, step: Column) -> Column:
        first, own, low = F.get(x, F.lit(0)), F.get(x, step["i"]), step["q"] - 1
        flip = own.bitwiseAND(step["q"]) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        return F.transform(
            x,
            lambda v, j: F.when(j == 0, F.when(flip, v.bitwiseXOR(low)).otherwise(v.bitwiseXOR(swap)))
            .when((j == step["i"]) & ~flip, v.bitwiseXOR(swap))
            .otherwise(v),
        )

    powers = F.array(*(F.lit(1 << b) for b in range(bits - 1, -1, -1)))

    def gray(x: Column) -> Column:
        """Each axis takes in those before it."""
        return F.transform(
            x, lambda v, j: F.aggregate(F.slice(x, F.lit(1), j + 1), F.lit(0), lambda a, w: a.bitwiseXOR(w))
        )

    def place(g: Column) -> Column:
        """All axes corrected by the last, then their bits one after another."""
        last = F.element_at(g, n)
        fix = F.aggregate(
            powers, F.lit(0), lambda a, q: F.when(last.bitwiseAND(q) != 0, a.bitwiseXOR(q - 1)).otherwise(a)
        )
        return let(
            fix,
            lambda f: F.aggregate(
                powers,
                F.lit(0).cast("long"),
                lambda a, q: F.aggregate(
                    g, a, lambda b, v: b * 2 + F.when(v.bitwiseXOR(f).bitwiseAND(q) != 0, 1).otherwise(0)
                ),
            ),
        )

    turned = F.aggregate(steps, axes, turn) if bits > 1 else axes
    return let(let(turned, gray), place)


def above(points: Sequence[float] | Sequence[bytearray]) -> Callable[[Column], Column]:
    """How many of the points a value is above."""
    return lambda x: sum((F.when(x > p, 1).otherwise(0) for p in points), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.StringType, T.BinaryType))


def text_cuts(df: DataFrame, name: str, sides: int) -> list[bytearray]:
    """The values of a text column at its quantiles, by counts of distinct values.

    Values are counted before they are ordered; ranks are sums inside ranges of values plus
    those of the ranges before, so no task sees the whole column. At most ``sides - 1`` come back.
    """
    spark = df.sparkSession
    counts = df.select(measure(df, name).alias("value")).where("value is not null").groupBy("value").agg(
        F.count("*").alias("n")
    )
    path = work_path(spark, "text-values")
    counts.repartitionByRange("value").sortWithinPartitions("value").withColumn(
        "part", F.spark_partition_id()
    ).write.parquet(path)
    values = spark.read.parquet(path)
    sums = values.groupBy("part").agg(F.sum("n").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per range
    bases = sums.select(
        "part",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"),
        F.sum("rows").over(Window.partitionBy()).alias("total"),
    )
    upto = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ends = values.withColumn("end", F.sum("n").over(upto)).join(F.broadcast(bases), "part")
    ends = ends.withColumn("end", F.col("end") + F.col("base"))
    passed = F.expr(f"sequence(1, {sides - 1})")
    crossed = F.filter(
        passed, lambda k: (k * F.col("total") > (F.col("end") - F.col("n")) * sides) & (k * F.col("total") <= F.col("end") * sides)
    )
    found = ends.select("value", F.explode(crossed).alias("k")).collect()
    return [r["value"] for r in sorted(found, key=lambda r: r["k"])]


def quantised(df: DataFrame, dimensions: Sequence[str], bits: int) -> list[Column]:
    """The cell of every dimension, 0 for null, cut at quantiles of the whole table."""
    sides = 1 << bits
    parts = [k / sides for k in range(1, sides)]
    cuts: dict[str, list] = {d: text_cuts(df, d, sides) for d in dimensions if is_text(df, d)}
    numbers = [d for d in dimensions if d not in cuts]
    if numbers:
        found = df.select(
            *(F.percentile_approx(measure(df, d), parts, 10_000).alias(f"d{k}") for k, d in enumerate(numbers))
        ).first()
        cuts |= {d: found[k] or [] for k, d in enumerate(numbers)}
    # equal cut points would leave empty cells between; the curve does not mind them
    return [F.coalesce(let(measure(df, d), above(cuts[d])), F.lit(0)) for d in dimensions]


def shard(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    dimensions: Sequence[str] = DIMENSIONS,
    shards: int = SHARDS,
    bits: int = BITS,
    row_col: str | None = None,
) -> DataFrame:
    """Per row: id, size, checksum, place on the curve, law, shard and slot (and ``row_col`` as ``row``)."""
    spark = docs.sparkSession
    text = F.coalesce(col_of(text_col).cast("string"), F.lit(""))
    narrow = docs.select(
        col_of(id_col).alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        curve_index(quantised(docs, dimensions, bits), bits).alias("curve"),
        *([col_of(row_col).alias("row")] if row_col else []),
    )
    first = work_path(spark, "shard-rows")
    narrow.write.parquet(first)
    rows = spark.read.schema(narrow.schema).parquet(first)

    # equal texts of a cell stand together
    keys = ["curve", "text_crc32", "doc_id", "n"]
    placed = (
        rows.withColumn("n", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("at", F.monotonically_increasing_id())
        .drop("n")
    )
    second = work_path(spark, "shard-order")
    placed.write.parquet(second)
    placed = spark.read.schema(placed.schema).parquet(second)

    part = F.shiftright("at", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per partition of the order
    bases = counts.withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0))).withColumn(
        "total", F.sum("rows").over(Window.partitionBy())
    )
    ranked = placed.withColumn("part", part).join(F.broadcast(bases.drop("rows")), "part")
    rank = F.col("base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = ranked.withColumn("rank", rank)
    number = F.expr(f"int(rank * {shards} div total)")
    # a shard begins at the rounded-up share of the rows
    begin = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", number).select(
        "doc_id",
        "size",
        "text_crc32",
        "curve",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - begin).cast("long").alias("slot"),
        *(["row"] if row_col else []),
    )


def write_shards(
    docs: DataFrame,
    path: str,
    dimensions: Sequence[str] = DIMENSIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """Writes all columns in files by shard, each in the order of the curve; returns the table."""
    from tabwright.llm.common import fresh

    row, number, slot = (fresh(docs, x) for x in ("row_number", "shard", "slot"))
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    kept = work_path(docs.sparkSession, "shard-input")
    numbered.write.parquet(kept)
    numbered = docs.sparkSession.read.schema(numbered.schema).parquet(kept)
    placed = shard(numbered, id_col, text_col, dimensions, shards, bits, row_col=row)
    placed = placed.select(
        F.col("row").alias(row), F.col("shard").alias(number), F.col("slot").alias(slot)
    )
    out = numbered.join(placed, row).drop(row)
    out.repartitionByRange(number, slot).sortWithinPartitions(number, slot).write.partitionBy(number).parquet(path)
    return docs.sparkSession.read.parquet(path)
