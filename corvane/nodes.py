"""Nodes of ingest, segmentation, models, labels, speakers and recovery. A model node infers with the model registered under its name.

Each gives what is due and what to compute, as those of dag.py; importing this module adds them to dag.NODES.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.dag import NODES, Node
from corvane.functions import models
from corvane.functions.text import short_hash, valid_fraction
from corvane.operators import gates as G
from corvane.operators import segmentation as S
from corvane.operators import speakers as K
from corvane.operators.discover import discover
from corvane.sources import audio
from corvane.sources.catalog import Catalog

CLIP = ("id", "audio_path", "source", "duration_sec")
RATE = 16_000


def _lacking(table: str, key: str = "id", provenance: tuple[str, ...] | None = None, **where: str):
    """Due: rows of segments or raw_files (by the key) without one in `table`."""
    base = "segments" if key == "id" else "raw_files"
    return lambda c: discover(c.read(base).where(where.get("where", "true")), c.read(table), key, provenance)


def _infer(model: str, path: str = "audio_path", *keep: str):
    """Compute: what the model gives for the due rows with their files' content, and the columns `keep` of those."""

    def run(c: Catalog, due: DataFrame) -> DataFrame:
        made = models.infer(audio.attach(due, path), model)
        key = "raw_id" if "raw_id" in made.columns else "id"
        return made.join(due.select(key, *keep), key) if keep else made

    return run


def _probe(c: Catalog, due: DataFrame) -> DataFrame:
    return audio.probe(audio.attach(due.select("raw_id", "wav_path"), "wav_path"), "raw_id").withColumn("probed_at", F.current_timestamp())


def _screen(c: Catalog, due: DataFrame) -> DataFrame:
    """Windows of each file by the model `lang_screen.auto`: kind lid_window, for rows with window_starts."""
    rows = due.select("raw_id", "wav_path", S.window_starts(F.col("duration_sec")).alias("window_starts"))
    heard = models.infer(audio.attach(rows, "wav_path"), "lang_screen.auto").select("raw_id", F.get("top_labels", F.lit(0))["lang"].alias("lang"))
    out = G.screen_languages(heard).join(rows.select("raw_id", "window_starts"), "raw_id")
    return out.withColumns({"needs_review": F.col("decision") == "mixed", "screened_at": F.current_timestamp(), "provenance": F.lit("lang_screen_auto"), "n_windows": F.col("n_windows").cast("int")})


def _diarize_due(c: Catalog) -> DataFrame:
    rows = discover(discover(c.read("raw_files"), c.read("raw_segments"), "raw_id"), c.read("diarization_turns"), "raw_id")
    screened = c.read("lang_screen").select("raw_id", "decision", "human_decision")
    return rows.join(screened, "raw_id", "left").where(F.coalesce("human_decision", "decision", F.lit("pass")) != "reject").drop("decision", "human_decision")


def _cut_due(c: Catalog) -> DataFrame:
    return discover(_commit_due(c), c.read("segments").where("raw_id is not null"), "raw_id")


def _commit_due(c: Catalog) -> DataFrame:
    return discover(c.read("diarization_turns").select("raw_id").distinct(), c.read("raw_segments"), "raw_id")


def _commit(c: Catalog, due: DataFrame) -> DataFrame:
    """How many clips each file that has been cut has, none too, so that it is not cut again."""
    made = c.read("segments").where("raw_id is not null").groupBy("raw_id").agg(F.count("*").cast("int").alias("n"))
    return due.join(made, "raw_id", "left").select("raw_id", F.coalesce("n", F.lit(0)).alias("n_segments"), F.lit("segment_vad_cut").alias("provenance"), F.current_timestamp().alias("segmented_at"))


def _cut(c: Catalog, due: DataFrame) -> DataFrame:
    """Clips of the due files' turns as segments; their audio is at <raw file>#<from>-<to>, which decode() reads by windows."""
    raw = c.read("raw_files").select("raw_id", "wav_path", "source", "source_url", "program", "domain", "style")
    clips = S.cut_clips(c.read("diarization_turns").join(due.select("raw_id"), "raw_id", "left_semi")).join(raw, "raw_id")
    path = F.format_string("%s#%.3f-%.3f", "wav_path", "start_sec", "end_sec")
    return clips.select("id", path.alias("audio_path"), "source", "source_url", "program", "domain", "style", F.round(F.col("end_sec") - F.col("start_sec"), 3).alias("duration_sec"), F.lit(48000).alias("sample_rate"), F.col("speaker_tag").alias("speaker_id"), F.current_date().alias("created_at"), "raw_id")


def _pregate_due(c: Catalog) -> DataFrame:
    return discover(c.read("segments").where("raw_id is not null"), c.read("pregate"))


def _measured(c: Catalog, due: DataFrame, model: str) -> DataFrame:
    """(id, snr_db, dnsmos_sig, dnsmos_ovrl) of due clips: SNR of frames of 25 ms, and scores where a model of this name is registered."""
    rows = audio.attach(due.select("id", "audio_path"))
    one = audio.decode(rows, [RATE], "id").select("id", audio.snr(audio.frames(F.col("samples"), RATE // 40)).alias("snr_db"))
    if model not in models.MODELS:
        return one.withColumns({"dnsmos_sig": F.lit(None).cast("double"), "dnsmos_ovrl": F.lit(None).cast("double")})
    return one.join(models.checked_scores(models.infer(rows, model)), "id", "left")


def _pregate(c: Catalog, due: DataFrame) -> DataFrame:
    rows = _measured(c, due, "pregate.snr")
    return G.pregate(rows).join(rows.select("id", "snr_db", F.col("dnsmos_ovrl").alias("dnsmos")), "id").withColumn("provenance", F.lit("pregate_snr"))


def _acoustic_due(c: Catalog) -> DataFrame:
    return discover(c.read("filters_text").where("pass").select("id").join(c.read("segments").select("id", "audio_path"), "id"), c.read("filters_acoustic"))


def _transcribe_due(c: Catalog) -> DataFrame:
    """Clips that the models in RESOURCES['asr_models'] (or, of none, any) have not read, past the pregate."""
    rows = discover(c.read("segments"), c.read("pregate").where("not pass"))
    wanted = list(models.RESOURCES["asr_models"])
    done = c.read("asr_results")
    return discover(rows, done.where(F.col("model").isin(wanted)) if wanted else done)


def _transcribe(c: Catalog, due: DataFrame) -> DataFrame:
    made = models.infer(audio.attach(due.select(*CLIP)), "asr.transcribe")
    return made if "model" in made.columns else made.withColumn("model", F.lit(next(iter(models.RESOURCES["asr_models"]), "asr.transcribe")))


def _g2p_due(c: Catalog) -> DataFrame:
    rows = c.read("filters").where("pass").select("id").join(c.read("asr_agreement").select("id", "best_text"), "id")
    return discover(rows, c.read("g2p"), provenance=("g2p_node",))


def _g2p(c: Catalog, due: DataFrame) -> DataFrame:
    lexicon = models.RESOURCES["lexicon"]
    read, mixed = models.lexicon_reader(lexicon)(F.col("best_text")), models.lexicon_reader(lexicon, code_switch=True)(F.col("best_text"))
    rows = due.select("id", read.alias("jyutping"), mixed.alias("jyutping_cs"))
    return rows.select("id", F.coalesce("jyutping", F.lit("")).alias("jyutping"), valid_fraction(F.coalesce("jyutping", F.lit(""))).alias("valid_fraction"), F.lit("g2p_node").alias("provenance"), "jyutping_cs")


def _align_due(c: Catalog) -> DataFrame:
    rows = c.read("tiers").where(F.col("tier").isin("gold", "auto_gold", "silver")).select("id").join(c.read("asr_agreement").where("best_text <> ''").select("id", "best_text"), "id")
    return discover(rows.join(c.read("segments").select("id", "audio_path"), "id"), c.read("alignments"), provenance=("align_chars",))


def _align(c: Catalog, due: DataFrame) -> DataFrame:
    return models.infer(audio.attach(due), "align.chars").withColumns({"model": F.lit("align.chars"), "provenance": F.lit("align_chars")})


def _prosody(c: Catalog, due: DataFrame) -> DataFrame:
    from corvane.functions.text import count_syllables
    from corvane.operators.labels import rate_raw

    rows = audio.decode(audio.attach(due.select("id", "audio_path")), [RATE], "id").select("id", "samples")
    made = models.infer(rows, "label.prosody").join(c.read("g2p").select("id", "jyutping"), "id", "left").join(c.read("filters").select("id", "english_ratio"), "id", "left")
    rate = rate_raw(count_syllables(F.col("jyutping")).cast("double"), F.col("voiced_sec"), F.col("english_ratio"))
    return made.select("id", rate.alias("rate_raw"), "f0_median_hz", "gaps", "voiced_sec")


def _embed_due(c: Catalog) -> DataFrame:
    return discover(c.read("segments").select(*CLIP), c.read("speaker_embeddings").where("provenance is not null and (embedding is not null or embedding_ref is not null)"))


def _embed(c: Catalog, due: DataFrame) -> DataFrame:
    return models.infer(audio.attach(due), "speaker.embed").join(due.select("id", "source"), "id").withColumn("provenance", F.lit("speaker_embed"))


def _backfill(c: Catalog, due: DataFrame) -> DataFrame:
    """Embeddings that are kept in files beside the clips, put into the table."""
    return embeddings(due).where("embedding is not null").select("id", "source", "embedding_ref", "embedding", "provenance")


def embeddings(rows: DataFrame) -> DataFrame:
    """rows with `embedding`: that of the table, else that of the .npy file in embedding_ref; only rows that lack one open a file."""
    import io

    import numpy as np

    here = rows.where("embedding is not null or embedding_ref is null")
    there = audio.attach(rows.where("embedding is null and embedding_ref is not null"), "embedding_ref")

    @F.pandas_udf("array<float>")
    def load(content):
        return content.map(lambda x: None if x is None else np.load(io.BytesIO(x), allow_pickle=False).astype(np.float32).ravel())

    return here.unionByName(there.withColumn("embedding", load("content")).select(*rows.columns))


def _cluster_due(c: Catalog) -> DataFrame:
    """All embeddings of sources that have one which is not clustered: a source is clustered as a whole."""
    rows = c.read("speaker_embeddings").where("embedding is not null")
    new = discover(rows, c.read("speakers").where("cluster_id is not null")).select("source").distinct()
    return rows.join(new, "source", "left_semi")


def _cluster(c: Catalog, due: DataFrame) -> DataFrame:
    made = K.cluster(due.select("id", "source", "embedding"))
    return made.join(due.select("id", "embedding_ref"), "id").select("id", "speaker_id", "embedding_ref", "cluster_id", F.lit("speaker_cluster").alias("provenance"))


def _orphans(c: Catalog, due: DataFrame) -> DataFrame:
    gate, agreed = c.read("pregate").select("id", F.col("pass").alias("gate_pass"), F.col("fail_reason").alias("gate_reason")), c.read("asr_agreement").select("id", "agreement")
    rows = due.withColumn("id", short_hash(F.col("audio_path"), 12)).join(gate, "id", "left").join(agreed, "id", "left")
    status = F.when(F.col("bucket") == "recover", "recovered").otherwise("pending_delete")
    return G.classify_orphans(rows).select("audio_path", "source", "bucket", "bytes", status.alias("status"), F.when(F.col("bucket") == "recover", F.col("id")).alias("recovered_id"), F.current_timestamp().alias("classified_at"))


def orphans_of(folder: str, pattern: str = "*.wav"):
    """Due: files on disk that neither segments nor earlier classifications know."""

    def due(c: Catalog) -> DataFrame:
        found = audio.files(c.spark, folder, pattern).select(F.col("path").alias("audio_path"), "bytes").withColumn("source", F.element_at(F.split("audio_path", "/"), -2))
        return discover(discover(found, c.read("segments").where("audio_path is not null"), "audio_path"), c.read("orphan_segments"), "audio_path")

    return due


def _reingest(c: Catalog, due: DataFrame) -> DataFrame:
    """Orphans that wait for deletion, as segments again; later nodes judge them."""
    return due.select(short_hash(F.col("audio_path"), 12).alias("id"), "audio_path", "source", F.lit("").alias("source_url"), F.current_date().alias("created_at"))


def _reingest_due(c: Catalog) -> DataFrame:
    rows = c.read("orphan_segments").where("status = 'pending_delete'")
    return discover(rows.withColumn("id", short_hash(F.col("audio_path"), 12)), c.read("segments"))


NODES |= {
    "ingest.probe": Node("raw_probe", ("raw_files",), _lacking("raw_probe", "raw_id"), _probe),
    "lang_screen.auto": Node("lang_screen", ("raw_files",), _lacking("lang_screen", "raw_id"), _screen),
    "segment.diarize": Node("diarization_turns", ("raw_files", "lang_screen"), _diarize_due, _infer("segment.diarize", "wav_path")),
    "segment.vad_cut": Node("segments", ("diarization_turns", "raw_files"), _cut_due, _cut),
    "segment.commit": Node("raw_segments", ("segments", "diarization_turns"), _commit_due, _commit),
    "pregate.snr": Node("pregate", ("segments",), _pregate_due, _pregate),
    "asr.transcribe": Node("asr_results", ("segments", "pregate"), _transcribe_due, _transcribe),
    "filter.acoustic": Node("filters_acoustic", ("filters_text", "segments"), _acoustic_due, lambda c, due: G.filter_acoustic(_measured(c, due, "filter.acoustic"))),
    "label.lang": Node("labels_lang", ("segments",), _lacking("labels_lang"), _infer("label.lang", "audio_path", "source", "duration_sec")),
    "label.overlap": Node("labels_overlap", ("segments",), _lacking("labels_overlap"), _infer("label.overlap", "audio_path", "source", "duration_sec")),
    "label.music": Node("labels_music", ("segments",), _lacking("labels_music"), _infer("label.music", "audio_path", "source", "duration_sec")),
    "label.prosody": Node("labels_prosody", ("segments", "g2p", "filters"), _lacking("labels_prosody"), _prosody),
    "g2p": Node("g2p", ("filters", "asr_agreement"), _g2p_due, _g2p),
    "align.chars": Node("alignments", ("tiers", "asr_agreement", "segments"), _align_due, _align),
    "speaker.embed": Node("speaker_embeddings", ("segments",), _embed_due, _embed),
    "embed.backfill": Node("speaker_embeddings", ("segments",), lambda c: c.read("speaker_embeddings").where("embedding is null and embedding_ref is not null"), _backfill),
    "speaker.cluster": Node("speakers", ("speaker_embeddings",), _cluster_due, _cluster),
    "recover.reingest_pending": Node("segments", ("orphan_segments",), _reingest_due, _reingest),
}
#: Nodes that need a model registered under their name, and those that are run by hand and not in a chain.
MODEL_NODES = ("lang_screen.auto", "segment.diarize", "asr.transcribe", "label.lang", "label.overlap", "label.music", "label.prosody", "align.chars", "speaker.embed")
BY_HAND = ("embed.backfill", "recover.reingest_pending")


def add_recovery(folder: str, pattern: str = "*.wav") -> None:
    """Adds the node recover.orphans over a folder of clips."""
    NODES["recover.orphans"] = Node("orphan_segments", ("segments", "pregate", "asr_agreement"), orphans_of(folder, pattern), _orphans)
