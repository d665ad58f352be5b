"""A session with the settings the jobs are planned for."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that do not depend on the cluster's size. Executor memory, cores and the number
# of shuffle partitions belong to the submit command.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tidemark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """For tests and the bench: one JVM, no UI."""
    return build_session(
        app="tidemark-local",
        **{
            "spark.master": f"local[{cores}]",
            "spark.sql.shuffle.partitions": str(partitions),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            **conf,
        },
    )


def shared_dir(spark: SparkSession) -> str:
    """A folder that all executors reach: ``spark.checkpoint.dir``, else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def lead_workers_here(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package wherever the session was started.

    On a cluster the package comes with ``--py-files`` or is installed; the path does no harm there.
    """
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (known, root) if p)
