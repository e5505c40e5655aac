"""Every registered query of the engine, and its SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvane.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Registers a function of (spark, sf_dir), and the SQL that gives the same rows, if SQL can."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"two queries {name}")
        QUERIES[name] = functools.wraps(f)(lambda spark, sf_dir: f(ship(spark), sf_dir))
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


from corvane.plans import discovery, gates, labels, manifests, relational, storage, texts  # noqa: E402, F401
from corvane.plans.gates import flagship  # noqa: E402, F401
