"""Calibration statistics and label assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_SAMPLES, MIN_SIGMA = 5, 1.0


def rate_percentiles(rows: DataFrame, column: str = "rate_raw") -> DataFrame:
    """p25 and p75, interpolated."""
    return quantiles(rows, [], column, {"p25": 0.25, "p75": 0.75})


def quantiles(rows: DataFrame, by: list[str], column: str, which: dict[str, float]) -> DataFrame:
    """Interpolated quantiles of a group: at place p (n - 1) in order. Values are counted before they are ranked, so a group meets as its
    distinct values, and no buffer holds them."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*by)
    counts = counts.withColumn("_upto", F.sum("_c").over(w.orderBy(column))).withColumn("_n", F.sum("_c").over(w))
    value = lambda at: F.min(F.when(F.col("_upto") > at, F.col(column)))
    out = []
    for name, p in which.items():
        at = (F.col("_n") - 1) * p
        low, high, part = value(F.floor(at)), value(F.ceil(at)), F.max(at - F.floor(at))
        out.append((low + (high - low) * part).alias(name))
    return counts.groupBy(*by).agg(*out)


def pitch_stats(rows: DataFrame, column: str = "f0_median_hz") -> DataFrame:
    """(speaker_id, mu, sigma, n) of speakers with enough samples, and of all rows under a null speaker."""
    rows = rows.where(F.col(column).isNotNull())
    stats = (F.avg(column).alias("mu"), F.greatest(F.stddev_pop(column), F.lit(MIN_SIGMA)).alias("sigma"), F.count("*").alias("n"))
    one = rows.groupBy("speaker_id").agg(*stats).where(F.col("n") >= MIN_SAMPLES)
    return one.unionByName(rows.agg(*stats).withColumn("speaker_id", F.lit(None).cast("string")))


def bucket_rate(rate: Column, p25: Column, p75: Column) -> Column:
    return F.when(rate.isNull(), None).when(rate < p25, "slow").when(rate > p75, "fast").otherwise("normal")


def pitch_z(value: Column, mu: Column, sigma: Column) -> Column:
    return (value - mu) / F.greatest(sigma, F.lit(MIN_SIGMA))


def bucket_pitch(z: Column) -> Column:
    return F.when(z.isNull(), None).when(z < -0.5, "low").when(z > 0.5, "high").otherwise("normal")


def rate_raw(syllables: Column, voiced: Column, english: Column) -> Column:
    """Syllables a second; null where there is nothing to measure or the text is mostly English."""
    ok = (voiced > 0) & (syllables > 0) & (F.coalesce(english, F.lit(0.0)) <= 0.5)
    return F.when(ok, F.round(syllables / voiced, 3))


def label_store(rows: DataFrame) -> DataFrame:
    """rows (id, lang, cmn_prob, overlap_ratio, music_prob, rate, pitch) as (id, line): JSON without the keys that are missing, and
    only of rows with some quality label."""
    both = F.col("lang").isNotNull() & F.col("cmn_prob").isNotNull()
    quality = F.struct(F.when(both, F.col("lang")).alias("lang"), F.when(both, F.col("cmn_prob")).alias("cmn_prob"), "overlap_ratio", "music_prob")
    some = both | F.col("overlap_ratio").isNotNull() | F.col("music_prob").isNotNull()
    control = F.struct(F.col("rate"), F.col("pitch"))
    return rows.where(some).select("id", F.to_json(F.struct("id", quality.alias("quality"), control.alias("control"))).alias("line"))


#: Kinds of label that a line may have.
KINDS = ("lang", "overlap", "music", "rate", "pitch", "pause", "emotion")


def label_lines(rows: DataFrame, constants: dict) -> DataFrame:
    """(id, line, and for each of KINDS whether the line has it) of rows with some quality label.

    rows: id, lang, lang_prob, yue_prob, cmn_prob, overlap_ratio, music_prob, rate_raw, english_ratio, f0_median_hz, gaps, plan,
    calibration_version, unalignable, emotion, emotion_conf, and mu and sigma of the speaker's pitch, null where that has too few samples.
    constants: p25 and p75 of the rate, mu and sigma of all pitches, version. Keys whose value is missing are left out of the JSON, which says
    where each value is from in `provenance`.
    """
    c = F.col
    lang = c("lang").isNotNull() & c("cmn_prob").isNotNull()
    rate_ok = c("rate_raw").isNotNull() & (F.coalesce("english_ratio", F.lit(0.0)) <= 0.5)
    pitch_ok = c("f0_median_hz").isNotNull()
    quality = F.struct(
        F.when(lang, F.struct(c("lang").alias("top"), "lang_prob", "yue_prob", "cmn_prob")).alias("lang"), F.when(c("overlap_ratio").isNotNull(), F.struct("overlap_ratio")).alias("overlap"),
        F.when(c("music_prob").isNotNull(), F.struct("music_prob")).alias("music"),
    )
    number = lambda k: F.lit(None if constants.get(k) is None else float(constants[k])).cast("double")
    z = F.round(pitch_z(c("f0_median_hz"), F.coalesce("mu", number("mu")), F.coalesce("sigma", number("sigma"))), 4)
    total = F.round(F.aggregate("gaps", F.lit(0.0), lambda s, g: s + g["dur"]), 3)
    has_pause = c("gaps").isNotNull() | c("plan").isNotNull()
    control = F.struct(
        F.when(rate_ok, F.struct(F.round("rate_raw", 4).alias("raw"), bucket_rate(c("rate_raw"), number("p25"), number("p75")).alias("bucket"))).alias("rate"),
        F.when(pitch_ok, F.struct(F.round("f0_median_hz", 3).alias("raw_hz"), z.alias("z"), bucket_pitch(z).alias("bucket"))).alias("pitch"),
        F.when(has_pause, F.struct("gaps", F.when(c("gaps").isNotNull(), total).alias("total_sec"), "plan", F.when(c("plan").isNotNull(), c("calibration_version")).alias("calibration_version"), F.when(c("unalignable"), True).alias("unalignable"))).alias("pause"),
        F.when(c("emotion").isNotNull(), F.struct(c("emotion").alias("top"), c("emotion_conf").alias("conf"))).alias("emotion"),
    )
    source = F.struct(
        F.when(lang, "mms-lid").alias("lang"), F.when(c("overlap_ratio").isNotNull(), "pyannote").alias("overlap"), F.when(c("music_prob").isNotNull(), "panns").alias("music"),
        F.when(rate_ok, "jyutping+silero").alias("rate"), F.when(pitch_ok, "parselmouth").alias("pitch"), F.lit(constants.get("version")).alias("calibration"),
    )
    some = lang | c("overlap_ratio").isNotNull() | c("music_prob").isNotNull()
    flags = {"lang": lang, "overlap": c("overlap_ratio").isNotNull(), "music": c("music_prob").isNotNull(), "rate": rate_ok, "pitch": pitch_ok, "pause": has_pause, "emotion": c("emotion").isNotNull()}
    line = F.to_json(F.struct("id", quality.alias("quality"), control.alias("control"), source.alias("provenance")))
    return rows.where(some).select("id", line.alias("line"), *(F.coalesce(f, F.lit(False)).alias(k) for k, f in flags.items()))
