"""Model versions, aliases and signatures as tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.metrics import max_version
from tabwright.sources.commits import CommitLog, latest
from tabwright.sources.tables import load_model, save_model

#: a commit without alias registers a version, one with an alias moves it
COMMITS = "model string, version int, path string, signature string, run_id string, alias string, ts timestamp"


def current_aliases(events: DataFrame, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """``alias, version``: the last event of each alias, by time, then by sequence.

    An aggregate, so a busy alias is reduced before the shuffle.
    """
    return events.groupBy("alias").agg(
        F.max_by("version", F.struct(F.col(ts), F.col(seq))).alias("version")
    )


def signature_of(inputs: DataFrame, outputs: DataFrame | None = None) -> str:
    """Names and types of a model's input (and output) columns, as JSON text."""
    parts = {"inputs": inputs.schema.jsonValue()}
    if outputs is not None:
        parts["outputs"] = outputs.schema.jsonValue()
    return json.dumps(parts)


def schema_differences(df: DataFrame, signature: str) -> DataFrame:
    """``column, problem, expected, actual, rows``: what sets a table apart from a signature.

    A problem is ``missing``, ``extra`` or ``type``; ``rows`` counts the non-null values
    the table has in the column. No row means that the table can be scored.
    """
    wanted = {
        f.name: f.dataType.simpleString()
        for f in T.StructType.fromJson(json.loads(signature)["inputs"]).fields
    }
    there = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    found = []
    for name in dict.fromkeys([*wanted, *there]):
        expected, actual = wanted.get(name), there.get(name)
        if expected == actual:
            continue
        problem = "missing" if actual is None else "extra" if expected is None else "type"
        rows = F.lit(0).cast("bigint") if actual is None else F.count(F.col(f"`{name}`"))
        found.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(problem).alias("problem"),
                F.lit(expected).cast("string").alias("expected"),
                F.lit(actual).cast("string").alias("actual"),
                rows.alias("rows"),
            )
        )
    if not found:
        return df.sparkSession.createDataFrame(
            [], "column string, problem string, expected string, actual string, rows bigint"
        )
    return df.agg(F.array(*found).alias("_all")).select(F.inline("_all"))


class ModelRegistry:
    """Versions of one named model under a path that all executors share.

    Registering a model and moving an alias are commits of one log (:mod:`tabwright.sources.commits`).
    A version's number is part of its commit, and an alias names the version and the folder of its
    model, so both mean the same model for good, whatever the writers' clocks say.
    """

    def __init__(self, spark: SparkSession, path: str, model: str):
        self.spark, self.path, self.model = spark, path.rstrip("/"), model
        self.log = CommitLog(spark, f"{self.path}/log/{model}", COMMITS)

    def _commit(self, make: Callable[[DataFrame], dict]) -> dict:
        now = datetime.now(timezone.utc).isoformat()
        return self.log.append(lambda rows: {"model": self.model, "ts": now, **make(rows)})

    def versions(self) -> DataFrame:
        """Every registered model with its ``version``, from 1; a row per model trained."""
        rows = self.log.rows().filter(F.col("alias").isNull())
        return rows.select("model", "path", "signature", "run_id", "ts", "version")

    def alias_events(self) -> DataFrame:
        """Every move of an alias; ``seq`` is its place in the log."""
        rows = self.log.rows().filter(F.col("alias").isNotNull())
        return rows.select("model", "alias", "version", "path", "ts", F.col("number").alias("seq"))

    def aliases(self) -> DataFrame:
        """``alias, version, path``: what each alias means now."""
        rows = self.log.rows().filter(F.col("alias").isNotNull())
        return latest(rows, "alias", "version", "path")

    def latest_version(self) -> int:
        """The highest version number, 0 if there is none."""
        return max_version(self.versions(), "version").first()["max_version"] or 0

    def register(self, model: PipelineModel, signature: str, run_id: str = "") -> int:
        target = save_model(model, f"{self.path}/models/{self.model}/{uuid.uuid4().hex}")

        def make(rows: DataFrame) -> dict:
            last = max_version(rows, "version").first()["max_version"] or 0
            return {"path": target, "signature": signature, "run_id": run_id, "version": last + 1}

        return self._commit(make)["version"]

    def set_alias(self, alias: str, version: int) -> None:
        target = self._row(version)["path"]
        self._commit(lambda rows: {"alias": alias, "version": version, "path": target})

    def _alias(self, alias: str) -> Row:
        row = self.aliases().filter(F.col("alias") == alias).first()
        if row is None:
            raise KeyError(f"no version of {self.model!r} has the alias {alias!r}")
        return row

    def version_of(self, alias: str) -> int:
        return self._alias(alias)["version"]

    def _row(self, version: int) -> Row:
        row = self.versions().filter(F.col("version") == version).first()
        if row is None:
            raise KeyError(f"{self.model!r} has no version {version}")
        return row

    def load_version(self, version: int) -> PipelineModel:
        return load_model(self._row(version)["path"])

    def load(self, alias: str) -> PipelineModel:
        return load_model(self._alias(alias)["path"])

    def load_with_version(self, alias: str) -> tuple[int, PipelineModel]:
        """The alias's version and its model, of one reading of the log."""
        row = self._alias(alias)
        return row["version"], load_model(row["path"])

    def signature(self, alias: str) -> str:
        return self._row(self.version_of(alias))["signature"]
