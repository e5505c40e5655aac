"""The training manifest: which segments are eligible, what an entry holds, and how entries are split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.operators.gates import TIERS

SPEAKER_SHARE = 0.05


def at_or_above(order: tuple[str, ...], least: str) -> list[str]:
    if least not in order:
        raise ValueError(f"{least!r} is none of {order}")
    return list(order[: order.index(least) + 1])


def manifest(segments: DataFrame, agreement: DataFrame, g2p: DataFrame, filters: DataFrame, tiers: DataFrame, quality: DataFrame | None = None, min_tier: str = "bronze", min_quality_tier: str | None = None, code_switch: str | None = None, min_agreement: float | None = None) -> DataFrame:
    """Eligible rows with the columns of all tables. Rows from before the filters had provenance or verdicts count as passed.

    code_switch is None, 'only' or 'exclude' (an English ratio above 0 is code-switched)."""
    if code_switch not in (None, "only", "exclude"):
        raise ValueError(f"code_switch is {code_switch!r}")
    f = filters.select("id", F.col("pass").alias("f_pass"), F.col("provenance").alias("f_provenance"), "dnsmos", "snr_db", "english_ratio")
    rows = segments.join(agreement, "id").join(g2p.select("id", "jyutping", "valid_fraction"), "id").join(f, "id").join(tiers.select("id", "tier").where(F.col("tier").isin(at_or_above(TIERS, min_tier))), "id")
    if quality is not None:
        rows = rows.join(quality.select("id", "quality_tier"), "id", "left")
    old = F.col("f_provenance").isNull()
    ok = (F.col("f_pass") | (F.col("f_pass").isNull() & old)) & ((F.col("valid_fraction") >= 0.80) | (F.col("valid_fraction").isNull() & old)) & (F.col("jyutping") != "")
    if min_quality_tier is not None:
        ok = ok & F.col("quality_tier").isin(at_or_above(("B", "A"), min_quality_tier))
    if code_switch is not None:
        ok = ok & ((F.col("english_ratio") > 0) if code_switch == "only" else (F.coalesce("english_ratio", F.lit(0.0)) == 0))
    if min_agreement is not None:
        ok = ok & (F.col("agreement") >= min_agreement)
    return rows.where(ok)


def filled(c: str | Column, default) -> Column:
    """The value, or the default where it is null or empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(c, F.lit("")), default if isinstance(default, Column) else F.lit(default))


def entries(rows: DataFrame) -> DataFrame:
    """The fields of an export line, with their defaults and roundings."""
    return rows.select(
        "id", "audio_path", filled("best_text", "").alias("text"), "source", filled("domain", "other").alias("domain"), filled("speaker_id", F.concat("source", F.lit("_unk"))).alias("speaker_id"),
        filled("gender", "unknown").alias("gender"), F.round("duration_sec", 3).alias("duration_sec"), F.col("sample_rate").cast("int").alias("sample_rate"), F.round(F.coalesce("agreement", F.lit(0.0)), 3).alias("asr_agreement"),
        F.round(F.coalesce("snr_db", F.lit(0.0)), 1).alias("snr_db"), F.round(F.coalesce("dnsmos", F.lit(0.0)), 2).alias("dnsmos"), "jyutping", "tier", F.coalesce("text_verified", F.lit(False)).alias("text_verified"),
    )


def full_entries(rows: DataFrame) -> DataFrame:
    """entries() with the rest of an export line: where the clip is from, style, date, the readings with foreign words, what each model said,
    and, of rows with a pause plan, the text with pause tokens and how many marks have which verdict. rows are those of jobs.manifest_rows."""
    from corvane.functions.pause import text_pause

    text = filled("best_text", "")
    more = rows.select(
        "id", filled("source_url", "").alias("source_url"), filled("program", "").alias("program"), filled("style", "formal").alias("style"), F.round(F.coalesce("english_ratio", F.lit(0.0)), 3).alias("english_ratio"),
        F.coalesce(F.col("created_at"), F.current_date()).cast("string").alias("created_at"), filled("jyutping_cs", "").alias("jyutping_cs"), F.coalesce("asr_candidates", F.array().cast("array<struct<model:string,text:string,confidence:double>>")).alias("asr_candidates"),
        F.when(F.col("pause").isNotNull(), text_pause(text, F.col("pause.plan"))).alias("text_pause"),
        F.when(F.col("pause").isNotNull(), F.struct(*(F.coalesce(f"pause.{k}", F.lit(0)).alias(k) for k in ("n_punct", "n_no_pause", "n_short", "n_long")))).alias("punct_audit"),
    )
    return entries(rows).join(more, "id")


def split(rows: DataFrame, train: DataFrame | None = None, val: DataFrame | None = None, share: float = SPEAKER_SHARE) -> DataFrame:
    """rows (id, source, speaker_id) with `split`. Ids that a side has stay there (train first). Of the rest, the speakers of a
    source stand in order of their first id, and the last of them, one at least, go to val."""
    old = None
    if train is not None:
        old = train.select("id", F.lit("train").alias("_was"))
    if val is not None:
        v = val.select("id", F.lit("val").alias("_was"))
        old = v if old is None else old.unionByName(v.join(train.select("id"), "id", "left_anti"))
    rows = rows.join(old, "id", "left") if old is not None else rows.withColumn("_was", F.lit(None).cast("string"))
    speakers = rows.where("_was is null").groupBy("source", "speaker_id").agg(F.min("id").alias("_first"))
    w = Window.partitionBy("source")  # a row a speaker
    speakers = speakers.withColumn("_rank", F.row_number().over(w.orderBy("_first"))).withColumn("_of", F.count("*").over(w))
    new = F.when(F.col("_rank") > F.col("_of") - F.greatest(F.lit(1), F.floor(F.col("_of") * share)), "val").otherwise("train")
    speakers = speakers.select("source", "speaker_id", new.alias("_new"))
    return rows.join(speakers, ["source", "speaker_id"], "left").withColumn("split", F.coalesce("_was", "_new")).drop("_was", "_new")
