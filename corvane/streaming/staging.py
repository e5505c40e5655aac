"""Staged rows: files that arrive in a folder are committed to a table once each, by a streaming query with a checkpoint."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corvane.sources.catalog import Catalog, dedup_last


def folder(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir, or in a temporary one where that is unset and all runs on this machine, as in tests."""
    import tempfile

    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not at:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is unset: executors need a folder that all of them see")
        at = tempfile.gettempdir()
    return f"{at.rstrip('/')}/stream-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, False)


def drain_while(spark: SparkSession, staging: str, schema: StructType, catalog: Catalog, name: str, checkpoint: str, alive, seq: str | None = None, seconds: float = 5.0) -> int:
    """Drains what arrives every so many seconds while `alive()` says that something upstream still writes, and once more after. Returns the
    number of drains."""
    import time

    n = 0
    while True:
        last = not alive()
        drain(spark, staging, schema, catalog, name, checkpoint, seq).awaitTermination()
        n += 1
        if last:
            return n
        time.sleep(seconds)


def drain(spark: SparkSession, staging: str, schema: StructType, catalog: Catalog, name: str, checkpoint: str, seq: str | None = None, seconds: int | None = None):
    """Commits what is in `staging` (JSON lines) to a table: all that is there, or every so many seconds until stopped.

    A batch that repeats a key counts by its last row of `seq`. Rows without a key go to <staging>-failed."""
    keys = list(catalog.tables[name].keys)

    def commit(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        bad = batch.where(" or ".join(f"{k} is null" for k in keys))
        if not bad.isEmpty():
            bad.write.mode("append").json(f"{staging}-failed")
        good = batch.where(" and ".join(f"{k} is not null" for k in keys))
        good = dedup_last(good, keys, seq).drop(seq) if seq else good.dropDuplicates(keys)
        catalog.upsert(name, good)
        batch.unpersist()

    stream = spark.readStream.schema(schema).json(staging).writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    stream = stream.trigger(processingTime=f"{seconds} seconds") if seconds else stream.trigger(availableNow=True)
    return stream.start()


def commit_staged(spark: SparkSession, rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows staged as JSON lines, committed to a new table of that schema by a stream, and read back."""
    from corvane.sources.catalog import Table

    at = folder(spark)
    rows.write.json(f"{at}/staging")
    catalog = Catalog(spark, f"{at}/catalog", {"staged": Table(", ".join(f"`{n}` {t}" for n, t in rows.dtypes), tuple(keys))})
    catalog.ensure()
    drain(spark, f"{at}/staging", rows.schema, catalog, "staged", f"{at}/checkpoint").awaitTermination()
    return catalog.read("staged")
