"""Reading and writing tables, and storing fitted pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.session import work_path


def scan(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table by name, or a parquet table by path."""
    return spark.read.parquet(table) if "/" in table else spark.table(table)


def vectors_to_arrays(df: DataFrame) -> DataFrame:
    """Vector columns as arrays of doubles, which any reader of the table understands."""
    return df.select(
        *[
            vector_to_array(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, VectorUDT)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def write_predictions(
    df: DataFrame,
    table: str,
    path: str | None = None,
    bucket_by: tuple[int, str] | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Overwrites a named parquet table with all columns and returns the table.

    ``bucket_by`` (buckets, key) lets a later join on that key, such as the one with
    late labels, read the table without shuffling it again.
    """
    writer = vectors_to_arrays(df).write.format("parquet").mode("overwrite")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


#: Rows of a file, and of a task, of tables that learners and other work on single rows read.
ROWS_PER_FILE, ROWS_PER_TASK, LEAST_ROWS_PER_TASK = 25_000, 250_000, 2_500


def stage(df: DataFrame, name: str, rows_per_file: int | None = None) -> DataFrame:
    """Writes ``df`` to the shared work folder and returns the written table.

    For tables that several passes read: later passes read only the columns they need,
    and what executors computed outlives them. ``rows_per_file`` bounds the files, so that
    small rows that cost much work later are read by more than one task.
    """
    path = work_path(df.sparkSession, name)
    writer = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in partitions of at most about ``ROWS_PER_TASK`` rows, as many as fill all cores.

    Bytes on disk say little about the work that a row makes for a learner.
    """
    rows, cores = df.count(), max(1, df.sparkSession.sparkContext.defaultParallelism)
    full = cores * -(-rows // (ROWS_PER_TASK * cores))
    return df.repartition(max(1, min(full, rows // LEAST_ROWS_PER_TASK)))


def preview(df: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows by key; a limit without an order would pick any rows."""
    return df.orderBy(*keys).limit(n)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
