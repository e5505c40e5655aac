"""Gate cascades: the first gate that fails names the reason. All are CASE expressions over joined columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as T


@dataclass(frozen=True)
class TextGate:
    sample_rate: int = 48000
    min_seconds: float = 3.0
    max_seconds: float = 20.0
    min_cjk: int = 5
    max_chars: int = 150
    max_english: float = 0.30
    max_mandarin: float = 0.15


@dataclass(frozen=True)
class TierCuts:
    auto_gold: float = 0.92
    auto_gold_dnsmos: float = 3.5
    silver: float = 0.85
    bronze: float = 0.70


AUDIO_PROB = 0.8
TIERS = ("gold", "auto_gold", "silver", "bronze")


def first_reason(*gates: tuple[Column, str]) -> Column:
    """The name of the first gate whose condition holds; null if none does. A null condition does not hold."""
    out = F.when(gates[0][0], gates[0][1])
    for condition, name in gates[1:]:
        out = out.when(condition, name)
    return out


def filter_text(rows: DataFrame, gate: TextGate = TextGate()) -> DataFrame:
    """(id, english_ratio, mandarin_ratio, detected_language, language_confidence, pass, fail_reason, asr_model_count)."""
    rows = T.language_features(rows, "best_text")
    blank = F.trim(T.nothing(F.col("best_text"))) == ""
    rows = rows.withColumns(
        {
            "english_ratio": F.col("f_eng"), "mandarin_ratio": T.mandarin_ratio(), "detected_language": F.when(blank, "eng").otherwise(T.detected_language()),
            "language_confidence": F.when(blank, 0.0).otherwise(T.language_confidence()),
        }
    )
    seconds = F.coalesce("duration_sec", F.lit(0.0))
    reason = first_reason(
        (~F.col("sample_rate").eqNullSafe(F.lit(gate.sample_rate)), "sample_rate"), (~seconds.between(gate.min_seconds, gate.max_seconds), "duration"), (F.col("f_cjk") < gate.min_cjk, "text_too_short"),
        (F.length(T.nothing(F.col("best_text"))) > gate.max_chars, "text_too_long"), (F.col("english_ratio") > gate.max_english, "english_ratio"), (F.col("mandarin_ratio") > gate.max_mandarin, "mandarin_ratio"),
    )
    return rows.select("id", "english_ratio", "mandarin_ratio", "detected_language", "language_confidence", reason.isNull().alias("pass"), reason.alias("fail_reason"), F.col("model_count").alias("asr_model_count"))


def filter_acoustic(rows: DataFrame) -> DataFrame:
    """(id, snr_db, dnsmos_sig, dnsmos_ovrl, pass, fail_reason): unreadable audio has no SNR, a failed model no score."""
    reason = first_reason((F.col("snr_db").isNull(), "unreadable_audio"), (F.col("snr_db") < 25.0, "snr"), (F.col("dnsmos_sig").isNull(), "dnsmos_error"), (F.col("dnsmos_sig") < 3.0, "dnsmos"))
    return rows.select("id", "snr_db", "dnsmos_sig", "dnsmos_ovrl", reason.isNull().alias("pass"), reason.alias("fail_reason"))


def pregate(rows: DataFrame) -> DataFrame:
    """(id, pass, fail_reason): a cheap early gate that lets pass what it cannot measure."""
    reason = first_reason((F.col("snr_db") < 20.0, "snr"), (F.col("dnsmos_ovrl") < 2.5, "dnsmos"))
    return rows.select("id", reason.isNull().alias("pass"), reason.alias("fail_reason"))


def filter_decide(text: DataFrame, acoustic: DataFrame, labels: DataFrame) -> DataFrame:
    """One decision a text row: text, then acoustics (pending without a row), then the language heard."""
    a = acoustic.select("id", "snr_db", F.col("dnsmos_sig").alias("dnsmos"), "dnsmos_ovrl", F.col("pass").alias("a_pass"), F.col("fail_reason").alias("a_reason"), F.lit(True).alias("a_there"))
    g = labels.select("id", "lang", "lang_prob", "cmn_prob", F.lit(True).alias("l_there"))
    rows = text.join(a, "id", "left").join(g, "id", "left")
    heard = F.coalesce("lang", F.lit(""))
    reason = (
        F.when(~F.col("pass"), F.col("fail_reason")).when(F.col("a_there").isNull(), "acoustic_pending").when(~F.col("a_pass"), F.col("a_reason"))
        .when((heard == "cmn") & (F.col("cmn_prob") >= AUDIO_PROB), "mandarin_audio").when((heard == "eng") & (F.col("lang_prob") >= AUDIO_PROB), "english_audio")
        .when(~heard.isin("", "yue", "cmn", "eng") & (F.col("lang_prob") >= AUDIO_PROB), "other_language_audio")
    )
    return rows.select(
        "id", "snr_db", "dnsmos", "dnsmos_ovrl", "english_ratio", "mandarin_ratio", reason.isNull().alias("pass"), reason.alias("fail_reason"), F.col("asr_model_count").alias("text_model_count"),
        F.coalesce("l_there", F.lit(False)).alias("lang_label_checked"), F.col("cmn_prob").alias("mandarin_audio_prob"), F.col("lang_prob").alias("audio_lang_prob"),
    )


def tier(cuts: TierCuts = TierCuts()) -> Column:
    """Of text_verified, agreement and dnsmos; what is missing counts as 0."""
    agreement, dnsmos = F.coalesce("agreement", F.lit(0.0)), F.coalesce("dnsmos", F.lit(0.0))
    return (
        F.when(F.coalesce("text_verified", F.lit(False)), "gold").when((agreement >= cuts.auto_gold) & (dnsmos >= cuts.auto_gold_dnsmos), "auto_gold")
        .when(agreement >= cuts.silver, "silver").when(agreement >= cuts.bronze, "bronze").otherwise("excluded")
    )


def quality_tier() -> Column:
    """B if the audio is clean by all three measures, and all are there; else A."""
    return F.when((F.col("dnsmos") >= 3.7) & (F.col("music_prob") < 0.10) & (F.col("overlap_ratio") < 0.05), "B").otherwise("A")


def screen_languages(windows: DataFrame) -> DataFrame:
    """(raw_id, cantonese_ratio_raw, mandarin_ratio_raw, n_windows, decision) of windows (raw_id, lang)."""
    share = lambda lang: F.round(F.avg(F.when(F.col("lang") == lang, 1.0).otherwise(0.0)), 4)
    out = windows.groupBy("raw_id").agg(share("yue").alias("cantonese_ratio_raw"), share("cmn").alias("mandarin_ratio_raw"), F.count("*").alias("n_windows"))
    y, m = F.col("cantonese_ratio_raw"), F.col("mandarin_ratio_raw")
    return out.withColumn("decision", F.when((y >= 0.70) & (m <= 0.20), "pass").when((m > 0.50) | (y < 0.40), "reject").otherwise("mixed"))


def classify_orphans(rows: DataFrame, floor: float = 0.80) -> DataFrame:
    """rows (id, gate_pass, gate_reason, agreement) with `bucket`: what may be recovered, and why not."""
    bucket = (
        F.when(F.col("gate_pass"), "recover").when(~F.col("gate_pass"), F.concat(F.lit("pregate_fail_"), F.coalesce("gate_reason", F.lit("unknown"))))
        .when(F.col("agreement") >= floor, "recover").when(F.col("agreement").isNotNull(), "low_agreement").otherwise("no_signal")
    )
    return rows.withColumn("bucket", bucket)
