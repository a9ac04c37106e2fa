r"""Chat formatting by prefix-target expansion: every assistant turn is an example of its own.

An example is all turns before an assistant turn as context and that reply as the only text
under the loss. Written out, the contexts of one conversation grow with the square of its turns
(a third of all rows may be one conversation), so every formatted turn is stored once, in order,
and an example points at the prefix that is its context: ``segments`` has a row per turn,
``examples`` a row per assistant turn with the order of its last segment and the span of the
reply. ``write_examples`` numbers the segments of the whole table in order and writes both tables; an
example is there the range of segments that is its context, its target and the span of the reply, and
``read_back`` gets what is trained from the examples it reads. No step takes a conversation into one
task but the digests, which stream. ``expand`` joins the texts together for a reader that
wants whole strings.

The template is ``### Role: text</turn>`` and a line end. Inside roles and texts the characters
``\``, ``#`` and ``<`` are preceded by a backslash, so no control string can occur there, and
dropping those backslashes gives the original back.

Cases: a null text or role is empty; a null turn comes first; rows that repeat a turn are all
kept, ordered by role and text; a conversation without an assistant has segments and no
example; a null conversation id is a conversation of its own; an empty table gives empty
outputs; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import col_of
from tabwright.session import work_path

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
DIGEST = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, examples long"
)


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\#<])", r"\\$1")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def segments(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    target: str = "assistant",
) -> DataFrame:
    """A formatted row per turn, its text being code points ``start`` to ``end`` of ``formatted``;
    ``loss`` says whether it is trained. No shuffle: every row is formatted by itself."""
    role = F.coalesce(col_of(role_col).cast("string"), F.lit(""))
    text = F.coalesce(col_of(text_col).cast("string"), F.lit(""))
    head = F.concat(F.lit(OPEN), escaped(role), F.lit(MIDDLE))
    body = escaped(text)
    return turns.select(
        col_of(conv_col).alias("conv_id"),
        col_of(turn_col).alias("turn"),
        F.xxhash64(role, text).alias("tie"),
        F.concat(head, body, F.lit(CLOSE)).alias("formatted"),
        F.char_length(head).alias("start"),
        (F.char_length(head) + F.char_length(body)).alias("end"),
        (role == F.lit(target)).alias("loss"),
    )


def write_segments(formatted: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the rows in order of conversation and turn, cut anywhere, and returns the table."""
    spark = formatted.sparkSession
    path = path or work_path(spark, "chat")
    keys = ["conv_id", "turn", "formatted"]
    formatted.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(path)
    return spark.read.schema(formatted.schema).parquet(path)


def examples(formatted: DataFrame) -> DataFrame:
    """One row per example: its conversation, the segment that ends it and the trained span there.
    Context is every segment of the conversation before that one."""
    return formatted.where("loss").select(
        "conv_id",
        F.col("turn").alias("target_turn"),
        F.col("tie").alias("target_tie"),
        F.col("start").alias("loss_start"),
        F.col("end").alias("loss_end"),
    )


def write_examples(formatted: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes segments with their ``place`` in the whole table, and one row per example: its context
    is the segments from ``context_start`` up to ``target``, of which the span is trained."""
    spark = formatted.sparkSession
    path = path or work_path(spark, "chat")
    keys = ["conv_id", "turn", "formatted"]
    ordered = formatted.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the number of a row in its part; parts are ranges, cut anywhere, also inside a conversation
    inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ordered.select("*", F.spark_partition_id().alias("part"), inside.alias("row")).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    # one row per part
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = F.broadcast(sizes.select("part", before.alias("base")))
    placed = rows.join(bases, "part").withColumn("place", F.col("base") + F.col("row")).drop("part", "row", "base")
    placed.write.parquet(f"{path}/segments")
    stored = spark.read.parquet(f"{path}/segments")
    begins = stored.groupBy("conv_id").agg(F.min("place").alias("context_start")).withColumnRenamed("conv_id", "of")
    given = stored.where("loss").select(
        "conv_id", F.col("place").alias("target"), F.col("start").alias("loss_start"), F.col("end").alias("loss_end")
    )
    given = given.join(begins, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    given.write.parquet(f"{path}/examples")
    return stored, spark.read.parquet(f"{path}/examples")


def read_back(stored: DataFrame, given: DataFrame) -> DataFrame:
    """Roles and texts of the segments, and beside the target of an example its reply, cut out by its span."""
    spans = given.select(F.col("target").alias("place"), "loss_start", "loss_end")
    both = stored.join(spans, "place", "left")
    reply = F.substring("formatted", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    role = F.substring("formatted", F.lit(len(OPEN) + 1), F.col("start") - len(OPEN) - len(MIDDLE))
    body = F.substring("formatted", F.col("start") + 1, F.col("end") - F.col("start"))
    return both.select(
        "conv_id",
        "turn",
        unescaped(role).alias("role"),
        unescaped(body).alias("text"),
        F.col("loss_start").isNotNull().alias("loss"),
        F.char_length("formatted").cast("long").alias("chars"),
        unescaped(reply).alias("reply"),
    )


def expand(formatted: DataFrame) -> DataFrame:
    """Whole example texts, with the trained span counted in them.

    Output is as large as the method makes it: the sum of all prefixes.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "formatted")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    context = F.array_join(F.collect_list("formatted").over(upto), "")
    shift = F.char_length("text") - F.char_length("formatted")
    return (
        formatted.withColumn("text", context)
        .where("loss")
        .select(
            "conv_id",
            F.col("turn").alias("target_turn"),
            "text",
            (shift + F.col("start")).alias("loss_start"),
            (shift + F.col("end")).alias("loss_end"),
        )
    )


def parsed(formatted: DataFrame) -> DataFrame:
    """Roles and texts read back from the formatted rows."""
    role = F.substring("formatted", F.lit(len(OPEN) + 1), F.col("start") - len(OPEN) - len(MIDDLE))
    body = unescaped(F.substring("formatted", F.col("start") + 1, F.col("end") - F.col("start")))
    return formatted.select(
        "conv_id",
        "turn",
        unescaped(role).alias("role"),
        body.alias("text"),
        "loss",
        F.char_length("formatted").cast("long").alias("chars"),
    )


def digest(turns_read: DataFrame) -> DataFrame:
    """One row per conversation; what is trained is the column ``reply`` where there is one. The digests are hashed turn by turn as the rows stream by, so a
    task holds one turn at a time however long a conversation is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *(c.split()[0] for c in DIGEST.split(", "))]
        now, done, first, kind = None, [], True, None

        def close() -> None:
            if not first:
                done.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), size, given))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*done))
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for batch in batches:
            kind = batch.column(0).type
            for conv, role, text, trained, length, reply in zip(*(c.to_pylist() for c in batch.columns)):
                if first or conv != now:
                    close()
                    now, first = conv, False
                    n = chars = size = given = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                turns.update(f"{role}\n{text}\n".encode())
                if trained:
                    loss.update(reply.encode())
                    chars, given = chars + len(reply), given + 1
                n, size = n + 1, size + length
            if len(done) >= 4096:
                yield flush()
        close()
        if done:
            yield flush()

    kind = turns_read.schema["conv_id"].dataType.simpleString()
    if "reply" not in turns_read.columns:
        turns_read = turns_read.withColumn("reply", F.when(F.col("loss"), F.col("text")))
    rows = turns_read.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text", "loss", "chars", "reply").mapInArrow(run, f"conv_id {kind}, {DIGEST}")
