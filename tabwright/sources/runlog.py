"""A run log as append-only tables: runs, params, metrics and table artifacts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = "run_id string, run_name string, parent_run_id string"
PARAMS = "run_id string, key string, value string"
METRICS = "run_id string, key string, value double"


class RunLog:
    """Three long-format tables under one path; each append adds files, none is rewritten."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{table}")

    def append_run(
        self,
        run_id: str,
        run_name: str,
        parent_run_id: str | None = None,
        params: Mapping[str, object] | None = None,
        metrics: Mapping[str, float] | None = None,
    ) -> None:
        """One run with its parameters and metrics."""
        one = self.spark.createDataFrame([(run_id, run_name, parent_run_id)], RUNS)
        self.append_runs(one)
        if params:
            rows = [(run_id, k, str(v)) for k, v in params.items()]
            self.append_params(self.spark.createDataFrame(rows, PARAMS))
        if metrics:
            rows = [(run_id, k, float(v)) for k, v in metrics.items()]
            self.append_metrics(self.spark.createDataFrame(rows, METRICS))

    def append_runs(self, runs: DataFrame) -> None:
        self._append("runs", runs.select("run_id", "run_name", "parent_run_id"))

    def append_params(self, params: DataFrame) -> None:
        self._append("params", params.select("run_id", "key", "value"))

    def append_metrics(self, metrics: DataFrame) -> None:
        self._append("metrics", metrics.select("run_id", "key", "value"))

    def append_artifact(self, run_id: str, name: str, table: DataFrame) -> None:
        """A small result table, kept beside the run."""
        table.write.mode("overwrite").parquet(f"{self.path}/artifacts/{run_id}/{name}")

    def runs(self) -> DataFrame:
        return self.spark.read.schema(RUNS).parquet(f"{self.path}/runs")

    def params(self) -> DataFrame:
        return self.spark.read.schema(PARAMS).parquet(f"{self.path}/params")

    def metrics(self) -> DataFrame:
        return self.spark.read.schema(METRICS).parquet(f"{self.path}/metrics")

    def artifact(self, run_id: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/artifacts/{run_id}/{name}")


def wide_metrics(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per run, one column per named metric (the highest where logged twice)."""
    return metrics.groupBy("run_id").pivot("key", list(names)).agg(F.max("value"))
