"""What is run by hand over a catalog: exports, the report, calibration and review, imports, and files that may go."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators import labels as B
from corvane.operators import manifest as M
from corvane.operators import report as R
from corvane.operators import review as V
from corvane.sources import files
from corvane.sources.catalog import Catalog


def manifest_rows(c: Catalog, **cuts) -> DataFrame:
    """Eligible segments with all that an entry holds."""
    g2p, filters = c.read("g2p"), c.read("filters")
    rows = M.manifest(c.read("segments"), c.read("asr_agreement"), g2p, filters, c.read("tiers"), c.read("quality_tiers"), **cuts)
    rows = rows.join(g2p.select("id", "jyutping_cs"), "id", "left")
    plans = c.read("pause_plan").select("id", F.struct("plan", "n_punct", "n_no_pause", "n_short", "n_long").alias("pause"))
    said = c.read("asr_results").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("model", "text", "confidence"))).alias("asr_candidates"))
    return rows.join(plans, "id", "left").join(said, "id", "left")


def manifest_export(c: Catalog, out: str, train: DataFrame | None = None, val: DataFrame | None = None, **cuts) -> dict:
    """manifest, train and val as JSON lines under out/<name of the cut>; ids that train or val have stay there."""
    name = files.export_name("manifest", **cuts)
    rows = M.full_entries(manifest_rows(c, **{k: v for k, v in cuts.items() if v is not None}))
    files.export_manifest(rows, f"{out}/{name}", train, val)
    n, speakers, seconds = rows.agg(F.count("*"), F.count_distinct("speaker_id"), F.coalesce(F.sum("duration_sec"), F.lit(0.0))).first()
    return {"path": f"{out}/{name}", "entries": n, "speakers": speakers, "hours": round(seconds / 3600, 3)}


def report_build(c: Catalog, out: str, min_tier: str = "bronze") -> dict:
    """The acceptance report of what a manifest of this tier holds, as Markdown: checks, hours by source, domain and tier."""
    rows = manifest_rows(c, min_tier=min_tier).persist()
    try:
        one = R.summary(rows)
        of = lambda column, name: R.percentiles(rows.where(F.col(column).isNotNull()), [], column, {name: 50})
        bad = rows.agg(F.count(F.when(F.coalesce("audio_path", F.lit("")) == "", 1)).cast("double").alias("bad_paths"))
        one = one.crossJoin(of("dnsmos", "dnsmos_p50")).crossJoin(of("snr_db", "snr_p50")).crossJoin(R.valid_rate(rows).withColumnRenamed("rate", "jyutping_valid_rate")).crossJoin(bad)  # one row each
        checks = R.acceptance(one, tuple(R.ACCEPT)).collect()
        tables = {by: R.breakdown(rows, [by]).orderBy(F.desc("hours")).limit(50).collect() for by in ("source", "domain", "tier")}
    finally:
        rows.unpersist()
    text = R.markdown("Acceptance", checks, tables)
    files.write_text(c.spark, f"{out}/report.md", text)
    return {"path": f"{out}/report.md", "passed": sum(bool(r["passed"]) for r in checks), "checks": len(checks)}


def label_calibrate(c: Catalog, out: str, version: str = "v1") -> dict:
    """Percentiles of the speaking rate, and pitch by speaker and over all: rates as constants in JSON, speakers as a table beside it."""
    rows = c.read("labels_prosody").join(c.read("segments").select("id", "speaker_id"), "id")
    pitch = B.pitch_stats(rows)
    pitch.where("speaker_id is not null").write.mode("overwrite").parquet(f"{out}/pitch_by_speaker")
    one = B.rate_percentiles(rows).crossJoin(pitch.where("speaker_id is null").select("mu", "sigma", "n"))  # one row each
    return files.write_constants(one, f"{out}/calibration.json", version)


def label_store(c: Catalog, out: str, calibration: str) -> dict:
    """labels.jsonl under out, with the constants that label_calibrate wrote, and how many lines have each kind of label."""
    spark = c.spark
    constants = json.loads("".join(r[0] for r in spark.read.text(f"{calibration}/calibration.json").collect()))
    speakers = spark.read.parquet(f"{calibration}/pitch_by_speaker").select("speaker_id", "mu", "sigma")
    lang = c.read("labels_lang").select("id", "lang", "lang_prob", "yue_prob", "cmn_prob")
    rows = c.read("segments").select("id", "speaker_id")
    for part in (lang, c.read("labels_overlap").select("id", "overlap_ratio"), c.read("labels_music").select("id", "music_prob"), c.read("labels_prosody").select("id", "rate_raw", "f0_median_hz", "gaps"), c.read("labels_emotion").select("id", F.col("top").alias("emotion"), F.col("conf").alias("emotion_conf")), c.read("filters").select("id", "english_ratio"), c.read("pause_plan").select("id", "plan", "calibration_version", "unalignable")):
        rows = rows.join(part, "id", "left")
    rows = rows.join(speakers, "speaker_id", "left")
    lines = B.label_lines(rows, constants)
    path = f"{out}/labels.jsonl"
    lines.sort("id").select("line").write.mode("overwrite").text(path)
    counted = lines.agg(F.count("*").alias("lines"), *(F.count(F.when(F.col(k), 1)).alias(k) for k in B.KINDS)).first().asDict()
    return {"path": path, **counted}


def calibrate_sample(c: Catalog, n: int = 300, tier: str | None = None, min_agreement: float | None = None, code_switch: str | None = None, order: str = "random", seed: int = 0) -> dict:
    """Queues n segments for review: of those that pass the gates and were never queued, within a tier, agreement and code-switching."""
    import uuid

    rows = V.candidates(c.read("asr_agreement"), c.read("filters"), c.read("tiers"), tier, min_agreement, code_switch)
    run_id = f"calibrate_sample_{uuid.uuid4().hex[:12]}"
    picked = V.sample_queue(rows, c.read("calibration_review"), n, order, seed)
    picked = picked.select("id", F.lit("pending").alias("decision"), F.lit(run_id).alias("sample_batch"), F.current_timestamp().alias("queued_at"), F.col("best_text").alias("original_best_text")).persist()
    try:
        queued = c.upsert("calibration_review", picked)
        if queued:
            c.journal(run_id, "calibrate.sample", picked.select("id"))
    finally:
        picked.unpersist()
    return {"queued": queued, "run_id": run_id if queued else None}


def record_decisions(c: Catalog, decisions: DataFrame) -> int:
    """Writes review decisions (id, decision, reviewed_text[, flag_reason]) to the queue, the agreement and the tiers; the queue last, so that a
    run that dies is done again. Only ids that are queued count."""
    V.check_decisions(decisions)
    reason = F.col("flag_reason") if "flag_reason" in decisions.columns else F.lit(None).cast("string").alias("flag_reason")
    decisions = decisions.select("id", "decision", "reviewed_text", reason).join(c.read("calibration_review").select("id"), "id", "left_semi").persist()
    try:
        n = decisions.count()
        changed = c.read("asr_agreement").join(decisions.where("decision = 'verified'").select("id", "reviewed_text"), "id")
        agreement = changed.withColumns({"best_text": F.col("reviewed_text"), "text_verified": F.lit(True)}).drop("reviewed_text")
        c.upsert("asr_agreement", agreement)
        c.upsert("tiers", V.decided_tiers(decisions))
        queue = c.read("calibration_review").drop("decision", "reviewed_text", "flag_reason", "reviewed_at").join(decisions, "id")
        c.upsert("calibration_review", queue.withColumn("reviewed_at", F.current_timestamp()))
        return n
    finally:
        decisions.unpersist()


def pause_qc_next(c: Catalog, n: int = 1) -> DataFrame:
    """The next plans to judge: alignable, with marks, of the tiers on top, and without a review; by a hash of the id."""
    plans = c.read("pause_plan").where("not unalignable and n_punct > 0")
    rows = plans.join(c.read("tiers").where(F.col("tier").isin("gold", "auto_gold")).select("id"), "id", "left_semi")
    return rows.join(c.read("pause_qc_review").select("id"), "id", "left_anti").orderBy(F.xxhash64("id"), "id").limit(n)


def pause_qc_preview(c: Catalog, ids: list[str]) -> DataFrame:
    """(id, best_text, events) with the times of each event in the clip."""
    from corvane.functions.pause import preview

    rows = c.read("alignments").where(F.col("id").isin(ids)).join(c.read("asr_agreement").select("id", "best_text"), "id").join(c.read("segments").select("id", "duration_sec"), "id")
    return rows.select("id", "best_text", preview(F.col("best_text"), F.col("chars"), F.col("duration_sec"))["plan"].alias("events"))


def record_pause_qc(c: Catalog, judged: DataFrame) -> int:
    """Reviews of marks (id, punct_offset, perceived_verdict, position_ok, note), with what the plan says of them; an offset of -1 is a plan
    that is skipped. Marks that the plan does not have are refused."""
    plan = c.read("pause_plan").join(judged.select("id").distinct(), "id", "left_semi").select("id", F.explode("plan").alias("e")).select("id", F.col("e.offset").alias("punct_offset"), F.col("e.mark").alias("mark"), F.col("e.verdict").alias("plan_verdict"))
    rows = judged.join(plan, ["id", "punct_offset"], "left")
    if not rows.where("mark is null and punct_offset >= 0").isEmpty():
        raise ValueError("reviews of marks that are in no plan")
    return c.upsert("pause_qc_review", rows.withColumns({"reviewed_at": F.current_timestamp(), "provenance": F.when(F.col("punct_offset") < 0, "skipped").otherwise("human")}))


def import_sources(c: Catalog, folder: str) -> int:
    """The sources table anew from the YAML lists of a folder."""
    from corvane.sources.lists import read_lists

    c.overwrite("sources", read_lists(c.spark, folder).select("source_key", "kind", "program", "domain", "style", "config"))
    return c.read("sources").count()


def import_jsonl(c: Catalog, name: str, path: str) -> int:
    """A table anew from JSON lines; of a key that is repeated the last line by all columns, and lines without a key are left out."""
    from corvane.sources.catalog import dedup_last

    keys = list(c.tables[name].keys)
    rows = files.read_jsonl(c.spark, path, c.schema(name)).where(" and ".join(f"{k} is not null" for k in keys))
    other = [f.name for f in c.schema(name) if f.name not in keys]
    c.overwrite(name, dedup_last(rows, keys, other[0]) if other else rows.dropDuplicates(keys))
    return c.read(name).count()


def ingest_commit(c: Catalog, staging: str, checkpoint: str, name: str = "raw_files") -> int:
    """Commits what downloads have staged as JSON lines, once each; returns the table's rows."""
    from corvane.streaming.staging import drain

    drain(c.spark, staging, c.schema(name), c, name, checkpoint).awaitTermination()
    return c.read(name).count()


def transcode_copies(c: Catalog, copies: DataFrame) -> int:
    """Records verified copies (raw_id, flac_path, duration_sec, verified) of raw files."""
    return c.upsert("raw_flac", copies.withColumns({"transcoded_at": F.current_timestamp(), "provenance": F.lit("raw_flac")}))


def delete_verified(c: Catalog, limit: int = 1000) -> int:
    """Deletes originals whose copy is verified and there, at most `limit` a call: the table names the copy before a file goes, so that a run that
    dies leaves a file too many and never one too few."""
    from corvane.streaming.staging import exists, remove

    old = c.read("raw_flac").where("verified and wav_deleted_at is null").join(c.read("raw_files").select("raw_id", "wav_path"), "raw_id")
    rows = [r for r in old.orderBy("raw_id").limit(limit).collect() if exists(c.spark, r["flac_path"])]
    if not rows:
        return 0
    ids = c.spark.createDataFrame([(r["raw_id"],) for r in rows], "raw_id string")
    moved = c.read("raw_files").join(c.read("raw_flac").select("raw_id", "flac_path"), "raw_id").join(ids, "raw_id")
    c.upsert("raw_files", moved.withColumn("wav_path", F.col("flac_path")).drop("flac_path"))
    for r in rows:
        if r["wav_path"] != r["flac_path"]:
            remove(c.spark, r["wav_path"])
    c.upsert("raw_flac", c.read("raw_flac").join(ids, "raw_id").withColumn("wav_deleted_at", F.current_timestamp()))
    return len(rows)


def prune_logs(folder: str, gzip_days: float = 7, delete_days: float = 60) -> dict:
    """Log files of a local folder: older ones are compressed, the oldest deleted. The times are those of their last change."""
    import gzip
    import os
    import shutil
    import time
    from pathlib import Path

    done, now = {"gzipped": 0, "deleted": 0}, time.time()
    for p in sorted(Path(folder).rglob("*")):
        if not p.is_file() or p.suffix not in (".log", ".gz"):
            continue
        age = (now - p.stat().st_mtime) / 86400
        if age > delete_days:
            p.unlink()
            done["deleted"] += 1
        elif age > gzip_days and p.suffix == ".log":
            with p.open("rb") as a, gzip.open(f"{p}.gz", "wb") as b:
                shutil.copyfileobj(a, b)
            os.utime(f"{p}.gz", (p.stat().st_atime, p.stat().st_mtime))
            p.unlink()
            done["gzipped"] += 1
    return done
