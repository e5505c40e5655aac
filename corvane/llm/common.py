"""Session, shared-folder and text helpers of the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import sys
import tempfile
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane import session

#: The white space of every contract here: space, and tab to carriage return.
WS = r"[\x20\x09-\x0D]+"
WS_CHARS = " \t\n\x0b\x0c\r"

#: Finds a character outside those whose classes (letter, number, space) are the same to `re` and to the patterns of
#: vocabularies: Latin-1 and Latin Extended-A and -B without superscripts, fractions and ordinals, general punctuation.
PLAIN = re.compile("[^\x00-\x1b\x20-\xa9\xab-\xb1\xb4-\xb8\xbb\xbf-\u024f\u2010-\u2027\u2030-\u205e]")

def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, and bound an Arrow batch by rows (whole texts can be long)."""
    session.ship(spark)
    spark.conf.set(BATCH_ROWS, "128")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of this machine's only where that is unset and all runs on this machine, as in tests."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not at:
        at = sc.getCheckpointDir()
    if not at:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is unset: executors need a folder that all of them see")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corvane-"))
        at = sc.getCheckpointDir()
    return at.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Files of a table of a few numbers a row, at most, for each core of the cluster.
FILES_A_CORE, INPUT_A_FILE = 3, 2 << 30
SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Seconds after its last task in which a Python worker that has nothing to do gives back what its operator keeps.
IDLE_SECONDS = 3.0
_lock, _worker = threading.Lock(), {"name": None, "busy": False, "turn": 0}


def _release(name: str | None) -> None:
    """Calls `release` of the operator's module: it drops what that keeps between tasks. Freed memory goes to the system."""
    module = sys.modules.get(f"corvane.llm.{name}")
    if module is None:
        return
    module.release()
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _begin(name: str) -> None:
    with _lock:
        if _worker["name"] not in (None, name):
            _release(_worker["name"])
        _worker.update(name=name, busy=True, turn=_worker["turn"] + 1)


def _end() -> None:
    with _lock:
        _worker["busy"] = False
        timer = threading.Timer(IDLE_SECONDS, _idle, [_worker["turn"]])
    timer.daemon = True
    timer.start()


def _idle(turn: int) -> None:
    with _lock:
        if not _worker["busy"] and _worker["turn"] == turn:
            _release(_worker["name"])
            _worker["name"] = None


def keeps(name: str):
    """For functions over batches in Python workers, which outlive stages: what the operator's module keeps for its next task
    goes when another operator takes the worker over, or once the worker is idle."""

    def wrap(f):
        def run(batches):
            _begin(name)
            try:
                yield from f(batches)
            finally:
                _end()

        return run

    return wrap


class Cuts:
    """Tables written in the shared folder to cut lineage, each deletable once what needs it has been written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def cut(self, df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
        """df as a table in the shared folder. What was shuffled for it is deleted, as the table takes its place.

        A `narrow` one, of some numbers a row, is written by FILES_A_CORE tasks a core, or one for each INPUT_A_FILE bytes read for it if those are
        more, so that many steps do not make a small file for each partition of each."""
        if narrow:
            leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
            read = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
            most = FILES_A_CORE * max(2, self.spark.sparkContext.defaultParallelism)
            if read < 1 << 60:  # known
                df = df.coalesce(max(most, read // INPUT_A_FILE))
        self.paths[name] = path = new_dir(self.spark, name)
        was = self.spark.conf.get(SHUFFLES)
        self.spark.conf.set(SHUFFLES, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(SHUFFLES, was)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, *names: str) -> None:
        """Drops all tables but these."""
        self.drop(*(n for n in list(self.paths) if n not in names))

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, self.paths.pop(name))


def delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def whole(text: Column) -> Column:
    """A null text counts as empty."""
    return F.coalesce(text, F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def maybe_in(df: DataFrame, column: str, wanted: DataFrame, bits: int = 1 << 23) -> DataFrame:
    """df with `_maybe`: false for rows whose hash in `column` is certainly not in the column of that name of `wanted`.

    The hashes wanted are sent as a bitmap of fixed size (1 MB). As it fills, more rows pass, so what follows must be exact.
    A null is in nothing.
    """
    at = F.pmod(F.col(column), F.lit(bits)) + 1  # Spark numbers the bits of a bucket from 1 on
    maps = wanted.select(at.alias("_at")).groupBy(F.bitmap_bucket_number("_at").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_map"))
    rows = df.withColumn("_at", at).join(F.broadcast(maps), F.bitmap_bucket_number(F.col("_at")) == F.col("_bucket"), "left")
    rows = rows.withColumn("_byte", F.expr("cast(conv(hex(substring(_map, cast(bitmap_bit_position(_at) div 8 as int) + 1, 1)), 16, 10) as int)"))
    hit = F.coalesce(F.expr("shiftright(_byte, cast(bitmap_bit_position(_at) % 8 as int)) & 1") == 1, F.lit(False))
    return rows.withColumn("_maybe", hit).drop("_at", "_bucket", "_map", "_byte")
