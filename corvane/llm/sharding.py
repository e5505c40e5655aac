"""Sharding by size-tiered compaction.

Arrivals are appended as small immutable shards. Shards of similar size (one tier of sizes) are merged once there are
enough of them, into files of the target size, and a tier's result moves up. What a table consists of is a manifest of
shards; a new version is committed by a step that fails if another writer has made that version, so readers see all of
a change or nothing. That step is a hard link on a local or mounted file system (`file:`), and elsewhere a rename that does not replace, which is
atomic on HDFS. An object store has neither: let one writer at a time commit there.

Files of an older version stay until they are vacuumed, which spares what a reader or writer of the last GRACE_SECONDS may hold.
Shards are written by executors, one task a shard or run of shards; the driver holds the manifest (a few numbers a
shard), never rows.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.common import new_dir, ship, table

TARGET_BYTES = 128 << 20
TIER_FACTOR, TIER_WIDTH, SMALLEST = 4, 4, 1 << 16
#: How long a reader may hold an older version, and a writer files that it has not committed.
GRACE_SECONDS = 7 * 24 * 3600


class Conflict(RuntimeError):
    """Another writer committed this version first."""


class Shards:
    """A table of shards under one folder: `data/` holds Parquet files, `manifest/` a JSON file a version."""

    def __init__(self, spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, width: int = TIER_WIDTH):
        self.spark, self.path, self.target, self.width = ship(spark), path.rstrip("/"), target_bytes, width
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def version(self) -> int:
        """The last committed version; 0 before any."""
        at = self._at("manifest")
        if not self._fs.exists(at):
            return 0
        return max((int(s.getPath().getName()[1:-5]) for s in self._fs.listStatus(at) if s.getPath().getName().startswith("v")), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "schema": None, "shards": []}
        return json.loads("\n".join(r[0] for r in self.spark.read.text(f"{self.path}/manifest/v{version}.json").collect()))

    def _commit(self, version: int, schema, shards: list[dict]) -> None:
        """Writes the manifest aside and gives it the name of its version, unless there is one of that name."""
        text = json.dumps({"version": version, "schema": schema, "shards": shards}, sort_keys=True)
        aside, final = self._at(f"manifest/.{uuid.uuid4().hex}"), self._at(f"manifest/v{version}.json")
        self._fs.mkdirs(self._at("manifest"))
        out = self._fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            self._name(aside, final)
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            raise Conflict(f"version {version} of {self.path}") from None
        finally:
            self._fs.delete(aside, False)

    def _name(self, aside, final) -> None:
        aside, final = self._fs.resolvePath(aside), self._fs.resolvePath(final.getParent()).suffix(f"/{final.getName()}")
        if aside.toUri().getScheme() == "file":
            at = lambda p: self._jvm.java.nio.file.Paths.get(self._jvm.java.net.URI("file://" + p.toUri().getRawPath()))
            self._jvm.java.nio.file.Files.createLink(at(final), at(aside))
            return
        none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(aside, final, options)

    def _write(self, df: DataFrame, batch: str) -> list[dict]:
        """df's partitions as shards of one new folder, with their rows and bytes."""
        name = f"data/{batch}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        files = [(s.getPath().getName(), s.getLen()) for s in self._fs.listStatus(self._at(name)) if s.getPath().getName().endswith(".parquet")]
        return [{"file": f"{name}/{f}", "bytes": n} for f, n in sorted(files)]

    def append(self, df: DataFrame) -> int:
        """Commits df's partitions as new shards, as small as they come; returns the version. Columns are those of the table, in any order."""
        m = self.manifest()
        if m["schema"] is not None:
            has = self._schema(m)
            kinds = lambda schema: {f.name: f.dataType.simpleString() for f in schema}
            if kinds(has) != kinds(df.schema) or len(has) != len(df.schema):
                raise ValueError(f"{df.schema.simpleString()} is not the table's {has.simpleString()}")
            df = df.select(*(column(f.name) for f in has))
        shards = self._write(df, "arrival")
        self._commit(m["version"] + 1, m["schema"] or json.loads(df.schema.json()), m["shards"] + shards)
        return m["version"] + 1

    def tier(self, size: int) -> int:
        """0 up to SMALLEST bytes, and one more for each factor of TIER_FACTOR."""
        t = 0
        while size > SMALLEST * TIER_FACTOR**t:
            t += 1
        return t

    def plan(self, shards: list[dict]) -> list[list[dict]]:
        """The tiers to merge: those of at least `width` shards. A shard of half the target is done, so any two others fit in one."""
        tiers: dict[int, list[dict]] = {}
        for s in shards:
            if 2 * s["bytes"] < self.target:
                tiers.setdefault(self.tier(s["bytes"]), []).append(s)
        return [same for _, same in sorted(tiers.items()) if len(same) >= self.width]

    def compact(self) -> int:
        """Merges tier by tier, until no tier has enough similar shards; one commit a pass. Returns the version.

        A tier is one read and one write without a shuffle, in as many tasks as it fills files of the target size.
        """
        while tiers := self.plan((m := self.manifest())["shards"]):
            gone, new = {s["file"] for same in tiers for s in same}, []
            for same in tiers:
                files = max(1, -(-sum(s["bytes"] for s in same) // self.target))
                df = self.spark.read.schema(self._schema(m)).parquet(*(f"{self.path}/{s['file']}" for s in same))
                new += self._write(df.coalesce(files), "merged")
            self._commit(m["version"] + 1, m["schema"], [s for s in m["shards"] if s["file"] not in gone] + new)
        return self.version()

    def _schema(self, m: dict):
        from pyspark.sql.types import StructType

        return StructType.fromJson(m["schema"])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, with the shard of each in `shard` (`_shard` if the table has such a column, and so on); a table
        never written to cannot be read."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError(f"nothing was committed to {self.path}")
        schema = self._schema(m)
        name = "shard"
        while name in schema.names:
            name = "_" + name
        if not m["shards"]:
            return self.spark.createDataFrame([], schema).withColumn(name, F.lit(None).cast("string"))
        df = self.spark.read.schema(schema).parquet(*(f"{self.path}/{s['file']}" for s in m["shards"]))
        return df.withColumn(name, F.regexp_extract(F.input_file_name(), r"(data/[^/]+/[^/]+)$", 1))

    def vacuum(self, grace_seconds: float = GRACE_SECONDS) -> int:
        """Deletes the data folders that no version needs which is the last, or was at any time in the last `grace_seconds`, and that
        were last written before; returns how many. So readers of older versions and writers that have yet to commit have that time."""
        if not self.version():
            return 0
        since = time.time() - grace_seconds
        made = {int(s.getPath().getName()[1:-5]): s.getModificationTime() / 1000 for s in self._fs.listStatus(self._at("manifest")) if s.getPath().getName().startswith("v")}
        last, held = max(made), {v for v, t in made.items() if t >= since}
        before = max((v for v in made if v not in held), default=None)  # the last one when that time began
        live = {s["file"].split("/")[1] for v in {last, *held, *([before] if before and held else [])} for s in self.manifest(v)["shards"]}
        old = []
        for s in self._fs.listStatus(self._at("data")):
            if s.getPath().getName() not in live:
                written = max([s.getModificationTime(), *(f.getModificationTime() for f in self._fs.listStatus(s.getPath()))]) / 1000
                if written < since:
                    old.append(s.getPath())
        for p in old:
            self._fs.delete(p, True)
        return len(old)


def column(name: str):
    """The column of this name, whatever is in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def _hashed(kind) -> bool:
    """Whether a type can be hashed: not if there is a map in it."""
    return "map<" not in kind.simpleString() and "variant" not in kind.simpleString()


def shard_table(df: DataFrame, path: str, arrivals: int = 2, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """df stored as shards under `path` in so many arrivals, compacted, and read back from the committed manifest, with `shard`.

    Arrivals are dealt by a hash of the row (but maps); a row is in one shard, repeated rows each, nulls, texts of any length and any column names
    are kept (the result's own column is then `_shard`), and an empty table is one without rows. Older versions are vacuumed once nobody can hold them.
    """
    t = Shards(df.sparkSession, path, target_bytes)
    keys = [column(f.name) for f in df.schema if _hashed(f.dataType)]
    deal = F.pmod(F.xxhash64(*keys), F.lit(arrivals)) if keys else F.lit(0)
    for k in range(arrivals):
        t.append(df.where(deal == k))
    t.compact()
    t.vacuum()
    return t.read()


def op3_sharding(spark, sf_dir):
    """Each document's id, characters and MD5 of its text as the compacted table holds them."""
    docs = table(spark, sf_dir, "documents")
    out = shard_table(docs, new_dir(spark, "shards"))
    return out.select("doc_id", F.length("text").cast("long").alias("n_text"), F.md5(F.encode("text", "UTF-8")).alias("text_md5"), "lang", "source", "n_chars", (F.col("shard") != "").alias("sharded"))



ORACLE = """
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_text, lang, source, n_chars, md5(text) AS text_md5, true AS sharded FROM documents
"""
