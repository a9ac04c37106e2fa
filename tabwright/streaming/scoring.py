"""Scoring a stream, by one model or by what an alias means, and labels that arrive later."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabwright.operators.metrics import classifier_evaluation
from tabwright.plans.training import score
from tabwright.sources.commits import CommitLog
from tabwright.sources.registry import ModelRegistry
from tabwright.sources.tables import load_model, vectors_to_arrays
from tabwright.spec import FeatureSpec

#: what scored each batch of a stream
BATCHES = "batch long, version int, path string"


def parquet_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New parquet files of a folder as a stream; ``pattern`` picks files by name."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what the source holds now to a parquet table, then stops.

    The checkpoint remembers what was read, so the next call goes on from there and a
    restart after a failure repeats nothing.
    """
    return (
        vectors_to_arrays(stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_stream(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Scores every new row with a batch scorer such as ``model.transform``."""
    return write_available(transform(stream), path, checkpoint)


def _write_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_stream_by_alias(
    stream: DataFrame,
    registry: ModelRegistry,
    alias: str,
    spec: FeatureSpec,
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Scores every batch with the model that the alias means when the batch begins.

    Rows carry ``model_version``. Which version scores a batch is committed before it is
    scored, and a batch is a folder of its own under ``path``, so a batch that is run again
    after a failure replaces itself and keeps its version, even if the alias has moved since.
    """
    batches = CommitLog(stream.sparkSession, f"{path}/_batches", BATCHES)

    def write(rows: DataFrame, batch: int) -> None:
        known = batches.rows().filter(F.col("batch") == batch).first()
        if known is None:
            now = registry.aliases().filter(F.col("alias") == alias).first()
            if now is None:
                raise KeyError(f"no version of {registry.model!r} has the alias {alias!r}")
            chosen = {"batch": batch, "version": now["version"], "path": now["path"]}
            known = batches.append(lambda _: chosen)
        scored = score(load_model(known["path"]), rows, spec)
        scored = vectors_to_arrays(scored).withColumn("model_version", F.lit(known["version"]))
        scored.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return _write_batches(stream, write, checkpoint, "append")


def running_evaluation(
    stream: DataFrame, label: str, prediction: str, path: str, checkpoint: str, pos_label: int = 0
) -> StreamingQuery:
    """The nine figures of a classifier over all labelled rows so far, one row per batch.

    State is one row of counts. The row of a batch that is run again replaces itself.
    """
    figures = classifier_evaluation(stream, label, prediction, pos_label)

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return _write_batches(figures, write, checkpoint, "update")


def as_instant(df: DataFrame, column: str) -> DataFrame:
    """A zone-less time column as an instant of the session's zone, for watermarks."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def join_late_labels_stream(
    predictions: DataFrame,
    labels: DataFrame,
    keys: Sequence[str],
    prediction_ts: str,
    label_ts: str,
    within: str,
    lateness: str = "1 hour",
    unanswered: bool = False,
) -> DataFrame:
    """Predictions with the label that arrives within a time bound.

    Both sides keep state only as long as the watermark and the bound allow; labels
    later than that are dropped, which the batch join does not do. With ``unanswered``
    a prediction whose label can no longer come, as the watermark has passed the bound,
    comes out with null labels; without it, it is never seen.
    """
    left = predictions.withWatermark(prediction_ts, lateness)
    right = labels.withWatermark(label_ts, lateness).select(
        *[F.col(c).alias(f"_label_{c}" if c in keys else c) for c in labels.columns]
    )
    same = [F.col(k) == F.col(f"_label_{k}") for k in keys]
    in_bound = (F.col(label_ts) >= F.col(prediction_ts)) & (
        F.col(label_ts) <= F.col(prediction_ts) + F.expr(f"INTERVAL {within}")
    )
    condition = in_bound
    for s in same:
        condition = s & condition
    how = "left_outer" if unanswered else "inner"
    return left.join(right, condition, how).drop(*[f"_label_{k}" for k in keys])
