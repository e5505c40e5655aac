"""The catalog: a folder of versioned Parquet tables with keys.

A version of a table is a file `<root>/<name>/current-<n>`, which names the folders of Parquet that make it up; readers see the one
with the greatest n. It is written last, by a create that fails if another writer has made that version, so a reader sees one
version whole, and a run that dies leaves the last. An append adds a folder. A large table is kept in buckets by a hash of its
key, and an upsert rewrites only those that its batch touches.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Folders that appends add to a table before they are put together, and rows a bucket from which a table has more than one.
MOST_APPENDS, BUCKET_ROWS = 64, 2_000_000
_CHARS = "array<struct<ch:string,start_sec:double,end_sec:double>>"
_PLAN = "array<struct<offset:int,mark:string,kind:string,delta_t:double,verdict:string>>"


@dataclass(frozen=True)
class Table:
    schema: str
    keys: tuple[str, ...]


def _t(keys: str, schema: str) -> Table:
    return Table(schema, tuple(keys.split()))


TABLES: dict[str, Table] = {
    "catalog_meta": _t("key", "key string, value string, updated_at timestamp"),
    "sources": _t("source_key", "source_key string, kind string, program string, domain string, style string, config string"),
    "raw_files": _t("raw_id", "raw_id string, wav_path string, source string, source_url string, title string, pub_date string, program string, domain string, style string, language string, duration_sec double, sample_rate int, downloaded_at date"),
    "segments": _t("id", "id string, audio_path string, source string, source_url string, program string, domain string, duration_sec double, sample_rate int, speaker_id string, gender string, style string, created_at date, raw_id string"),
    "asr_results": _t("id model", "id string, model string, text string, confidence double, metadata string"),
    "asr_agreement": _t("id", "id string, agreement double, best_text string, text_verified boolean, model_count int, canto_ft_confidence double"),
    "filters_text": _t("id", "id string, english_ratio double, mandarin_ratio double, detected_language string, language_confidence double, pass boolean, fail_reason string, asr_model_count int"),
    "filters_acoustic": _t("id", "id string, snr_db double, dnsmos_sig double, dnsmos_ovrl double, pass boolean, fail_reason string"),
    "filters": _t("id", "id string, snr_db double, dnsmos double, english_ratio double, mandarin_ratio double, dnsmos_ovrl double, detected_language string, language_confidence double, pass boolean, fail_reason string, provenance string, text_model_count int, lang_label_checked boolean, mandarin_audio_prob double, audio_lang_prob double"),
    "g2p": _t("id", "id string, jyutping string, valid_fraction double, provenance string, jyutping_cs string"),
    "tiers": _t("id", "id string, tier string, provenance string, asr_model_count int"),
    "quality_tiers": _t("id", "id string, quality_tier string, provenance string"),
    "calibration_review": _t("id", "id string, decision string, reviewed_text string, sample_batch string, queued_at timestamp, reviewed_at timestamp, flag_reason string, original_best_text string"),
    "labels_lang": _t("id", "id string, source string, duration_sec double, lang string, lang_prob double, yue_prob double, cmn_prob double, top3 string"),
    "labels_overlap": _t("id", "id string, source string, duration_sec double, overlap_ratio double, overlap_sec double, speech_ratio double"),
    "labels_music": _t("id", "id string, source string, duration_sec double, music_prob double, music_tags string, provenance string"),
    "labels_prosody": _t("id", "id string, rate_raw double, f0_median_hz double, f0_z double, gaps array<struct<start_sec:double,end_sec:double,dur:double>>, voiced_sec double"),
    "labels_emotion": _t("id", "id string, top string, conf double, probs string"),
    "raw_probe": _t("raw_id", "raw_id string, channels int, codec string, sample_rate int, duration_sec double, lr_correlation double, probed_at timestamp"),
    "diarization_turns": _t("raw_id turn_idx", "raw_id string, turn_idx int, start_sec double, end_sec double, speaker_tag string"),
    "raw_segments": _t("raw_id", "raw_id string, n_segments int, provenance string, segmented_at timestamp"),
    "pregate": _t("id", "id string, snr_db double, dnsmos double, pass boolean, fail_reason string, provenance string"),
    "alignments": _t("id", f"id string, chars {_CHARS}, model string, provenance string"),
    "pause_plan": _t("id", f"id string, plan {_PLAN}, n_punct int, n_no_pause int, n_short int, n_long int, unalignable boolean, calibration_version string, provenance string"),
    "pause_qc_review": _t("id punct_offset", "id string, punct_offset int, mark string, plan_verdict string, perceived_verdict string, position_ok boolean, note string, reviewed_at timestamp, provenance string"),
    "speaker_embeddings": _t("id", "id string, source string, embedding_ref string, provenance string, embedding array<float>"),
    "speakers": _t("id", "id string, speaker_id string, embedding_ref string, cluster_id int, gender string, provenance string"),
    "verified": _t("id", "id string, text string, verified_by string, verified_at timestamp"),
    "task_runs": _t("run_id node item_id", "run_id string, node string, item_id string, status string, started timestamp, finished timestamp, error string, metrics string"),
    "lang_screen": _t("raw_id", "raw_id string, decision string, cantonese_ratio_raw double, mandarin_ratio_raw double, n_windows int, window_starts array<double>, needs_review boolean, human_decision string, reviewed_by string, reviewed_at timestamp, screened_at timestamp, provenance string"),
    "raw_flac": _t("raw_id", "raw_id string, flac_path string, duration_sec double, verified boolean, wav_deleted_at timestamp, transcoded_at timestamp, provenance string"),
    "orphan_segments": _t("audio_path", "audio_path string, source string, bucket string, bytes bigint, status string, recovered_id string, classified_at timestamp"),
    "segment_shard_migrations": _t("id", "id string, old_path string, new_path string, target_shard int, verified boolean, migrated_at timestamp, copied_at timestamp, provenance string"),
}


def dedup_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key by `order`; ties by all columns, so the result is one and the same each time."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in df.columns if c not in (*keys, order)))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """target with the batch's rows in place of those of equal keys. Columns that the batch lacks become null in its rows.

    A key that is repeated in the batch is refused, as it would be by a primary key.
    """
    unknown = set(batch.columns) - set(target.columns)
    if unknown:
        raise ValueError(f"columns {sorted(unknown)} are not in the table")
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True).select(target.columns)


class Catalog:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Table] | None = None):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables or TABLES
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def schema(self, name: str) -> StructType:
        return StructType.fromDDL(self.tables[name].schema)

    def _names(self, name: str) -> list[str]:
        at = self._path(f"{self.root}/{name}")
        return [x.getPath().getName() for x in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def version(self, name: str) -> int | None:
        return max((int(x[8:]) for x in self._names(name) if x.startswith("current-") and x[8:].isdigit()), default=None)

    def parts(self, name: str, version: int | None = None) -> dict:
        """What a version is: the number of its buckets, and its folders as [bucket, path]; a bucket of -1 has rows of any."""
        v = self.version(name) if version is None else version
        if v is None:
            raise FileNotFoundError(f"no table {name} in {self.root}")
        return json.loads("".join(r[0] for r in self.spark.read.text(f"{self.root}/{name}/current-{v}").collect()))

    def ensure(self) -> None:
        """An empty first version of each table that is not there. Data without a version is left alone, and an error."""
        for name in self.tables:
            if self.version(name) is None:
                if any(x.startswith("v") for x in self._names(name)):
                    raise ValueError(f"{self.root}/{name} has data but no version: restore its current-<n> file")
                self._commit(name, 1, {"buckets": 1, "parts": []})

    def _frame(self, name: str, folders: list[str]) -> DataFrame:
        schema = self.schema(name)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{name}/{x}" for x in folders))

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """Columns that were added to the schema after a version was written read as null."""
        return self._frame(name, [path for _, path in self.parts(name, version)["parts"]])

    def _commit(self, name: str, version: int, parts: dict) -> None:
        self._fs.mkdirs(self._path(f"{self.root}/{name}"))
        out = self._fs.create(self._path(f"{self.root}/{name}/current-{version}"), False)
        out.write(bytearray(json.dumps(parts).encode()))
        out.close()

    def _write(self, name: str, df: DataFrame, version: int, buckets: int) -> list:
        """df as folders of this version, one a bucket."""
        df = df.select(*(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema(name)))
        folder = f"v{version}-{uuid.uuid4().hex[:8]}"
        if buckets == 1:
            df.write.parquet(f"{self.root}/{name}/{folder}")
            return [[0, folder]]
        df.withColumn("_bucket", self._bucket(name, buckets)).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{name}/{folder}")
        found = [x.getPath().getName() for x in self._fs.listStatus(self._path(f"{self.root}/{name}/{folder}"))]
        return [[int(x[8:]), f"{folder}/{x}"] for x in sorted(found) if x.startswith("_bucket=")]

    def _bucket(self, name: str, buckets: int):
        return F.pmod(F.xxhash64(*self.tables[name].keys), F.lit(buckets)).cast("int")

    def _forget(self, name: str, version: int) -> None:
        """Deletes what neither this version nor the one before has; that one stays for readers that have opened it."""
        live = {path.split("/")[0] for v in (version, version - 1) if v > 0 for _, path in self.parts(name, v)["parts"]}
        for x in self._names(name):
            old = int(x[8:]) < version - 1 if x.startswith("current-") else x.startswith("v") and int(x[1:].split("-")[0]) < version and x not in live
            if old:
                self._fs.delete(self._path(f"{self.root}/{name}/{x}"), True)

    def overwrite(self, name: str, df: DataFrame, buckets: int = 1) -> int:
        new = (self.version(name) or 0) + 1
        self._commit(name, new, {"buckets": buckets, "parts": self._write(name, df, new, buckets)})
        self._forget(name, new)
        return new

    def append(self, name: str, df: DataFrame) -> int:
        """Adds rows whose keys the table does not have, without reading it; every MOST_APPENDS-th time its folders become one again."""
        old = self.version(name)
        now = self.parts(name, old)
        if len(now["parts"]) >= MOST_APPENDS + now["buckets"]:
            return self.overwrite(name, self.read(name, old).unionByName(df, allowMissingColumns=True), now["buckets"])
        self._commit(name, old + 1, {**now, "parts": now["parts"] + [[-1, p] for _, p in self._write(name, df, old + 1, 1)]})
        self._forget(name, old + 1)
        return old + 1

    def upsert(self, name: str, batch: DataFrame) -> int:
        """Puts the batch in, and returns its rows. Of a table in buckets, those that the batch touches are written anew."""
        keys = list(self.tables[name].keys)
        batch = batch.select(*(F.col(c).cast(self.schema(name)[c].dataType) for c in batch.columns)).persist()
        try:
            # a key that repeats shows as a row of two or more, which a combining aggregation finds without a set of all keys
            repeats = batch.groupBy(*keys).count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
            n = repeats[0]
            if repeats[1] > 1:
                raise ValueError(f"the batch repeats a key {keys}")
            if n:
                old = self.version(name)
                now = self.parts(name, old)
                if now["buckets"] == 1 or any(b < 0 for b, _ in now["parts"]):
                    made = upsert(self.read(name, old), batch, keys)
                    rows = n + self.read(name, old).count()
                    self.overwrite(name, made, 1 << max(0, (rows // BUCKET_ROWS).bit_length()))
                else:
                    bucket = self._bucket(name, now["buckets"])
                    touched = {r[0] for r in batch.select(bucket.alias("b")).distinct().collect()}  # as many as buckets at most
                    made = upsert(self._frame(name, [p for b, p in now["parts"] if b in touched]), batch, keys)
                    parts = [x for x in now["parts"] if x[0] not in touched] + self._write(name, made, old + 1, now["buckets"])
                    self._commit(name, old + 1, {**now, "parts": parts})
                    self._forget(name, old + 1)
            return n
        finally:
            batch.unpersist()

    def journal(self, run_id: str, node: str, items: DataFrame, status: str = "ok", error: str | None = None) -> int:
        """A row in task_runs for each item; a run writes its items once, so they are appended."""
        now = F.current_timestamp()
        rows = items.select(F.lit(run_id).alias("run_id"), F.lit(node).alias("node"), F.col(items.columns[0]).cast("string").alias("item_id"), F.lit(status).alias("status"), now.alias("started"), now.alias("finished"), F.lit(error).cast("string").alias("error")).distinct()
        return self.append("task_runs", rows)

    def last_run(self, run_id: str) -> DataFrame:
        """(status, n) of a run's items."""
        return self.read("task_runs").where(F.col("run_id") == run_id).groupBy("status").agg(F.count("*").alias("n"))

    def verify(self, floors: dict[str, int] | None = None, paths: int = 0) -> list[str]:
        """What is wrong: keys that repeat, more rows a segment than segments, fewer rows than `floors` has for a table, and of a sample of
        `paths` audio files those that are not there. Keys are counted by a combining aggregation."""
        found, counts = [], {}
        for name, t in self.tables.items():
            rows, distinct = self.read(name).groupBy(*t.keys).count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
            counts[name] = rows
            if rows != distinct:
                found.append(f"{name}: {rows - distinct} rows repeat a key")
        for name, t in self.tables.items():
            if t.keys == ("id",) and name != "segments" and counts[name] > counts.get("segments", counts[name]):
                found.append(f"{name}: more rows than segments")
        for name, least in (floors or {}).items():
            if counts[name] < least:
                found.append(f"{name}: {counts[name]} rows, {least} expected at least")
        if paths:
            sample = self.read("segments").where("audio_path is not null").select("audio_path").orderBy(F.xxhash64("audio_path")).limit(paths).collect()
            gone = [r[0] for r in sample if not self._path(r[0]).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(self._path(r[0]))]
            if gone:
                found.append(f"segments: {len(gone)} of {len(sample)} sampled audio files are not there, as {gone[0]}")
        return found
