"""Session settings the operators are written for, and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "tabwright", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the cluster's own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_path(spark: SparkSession, name: str) -> str:
    """A new path for tables and stream checkpoints that a job writes on its way.

    It lies under ``spark.checkpoint.dir``, the folder all executors share, or where that
    is not set beside the tables, in ``spark.sql.warehouse.dir``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tabwright/{name}-{uuid.uuid4().hex}"
