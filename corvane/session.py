"""Sessions: settings for the engine, and the package made importable in Python workers."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it is a folder that they can see; a cluster may ship it otherwise."""
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, path) if x)
    return spark


def session(app: str = "corvane", **conf: str) -> SparkSession:
    """A session with adaptive execution, in UTC; master, memory and partitions are left to the cluster, or to `conf`."""
    b = SparkSession.builder.appName(app)
    for k, v in {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true", **conf}.items():
        b = b.config(k, v)
    return ship(b.getOrCreate())
