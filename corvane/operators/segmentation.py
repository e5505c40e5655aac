"""Turns, windows, gaps, and measures of frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import lexicon as L
from corvane.functions.text import short_hash

WINDOWS, WINDOW_SEC, MARGIN = 10, 25.0, 0.05


def window_starts(duration: Column) -> Column:
    """Where windows of 25 s begin: ten spread over the middle 90 %, fewer of a short file, one in the middle of a shorter one."""
    lo, hi = duration * MARGIN, duration * (1 - MARGIN)
    span = hi - lo
    n = F.when(span >= 2 * WINDOW_SEC, F.lit(WINDOWS)).otherwise(F.greatest(F.lit(1), F.floor(span / WINDOW_SEC).cast("int")))
    at = lambda i: F.round(F.greatest(lo, F.least(hi - WINDOW_SEC, lo + (i + 0.5) / n * span - WINDOW_SEC / 2)), 2)
    one = F.array(F.round(F.greatest(F.lit(0.0), (duration - WINDOW_SEC) / 2), 2))
    return F.when(duration.isNull() | (duration <= 0), F.array().cast("array<double>")).when(span <= WINDOW_SEC, one).otherwise(F.transform(F.sequence(F.lit(0), n - 1), at))


def gaps(rows: DataFrame, key: str, least: float = 0.2) -> DataFrame:
    """rows (key, turn_idx, start_sec, end_sec) that are followed by a silence, with its length."""
    w = Window.partitionBy(key).orderBy("start_sec", "turn_idx")
    return rows.withColumn("gap", F.lead("start_sec").over(w) - F.col("end_sec")).where(F.col("gap") >= least)


def inside(windows: DataFrame, turns: DataFrame, slack: Column, bin_sec: float = 60.0) -> DataFrame:
    """Windows (aliased w) that lie in turns (aliased t) of their file, give or take `slack` at the end. Windows meet the turns that reach into
    the bin of time in which they start, so a long file costs its overlaps and not its square."""
    at = lambda c: F.floor(c / bin_sec)
    turns = turns.withColumn("_bin", F.explode(F.sequence(at(F.col("t.start_sec")), F.greatest(at(F.col("t.start_sec")), at(F.col("t.end_sec") + slack)))))
    windows = windows.withColumn("_wbin", at(F.col("w.start_sec")))
    on = (F.col("t.raw_id") == F.col("w.raw_id")) & (F.col("_bin") == F.col("_wbin")) & (F.col("w.start_sec") >= F.col("t.start_sec")) & (F.col("w.end_sec") <= F.col("t.end_sec") + slack)
    return turns.join(windows, on).drop("_bin", "_wbin")


def overlaps_a_later(turns: DataFrame, slack: float = 0.15) -> DataFrame:
    """turns (raw_id, turn_idx, start_sec, end_sec) with `hit`: whether a turn with a greater index comes within `slack` of it."""
    w = Window.partitionBy("raw_id").orderBy("turn_idx").rowsBetween(1, Window.unboundedFollowing)
    first, last = F.min("start_sec").over(w), F.max("end_sec").over(w)
    # the least start and the greatest end of later turns rule most out; what they leave is looked at turn by turn
    rows = turns.withColumn("_may", F.coalesce((first <= F.col("end_sec") + slack) & (last >= F.col("start_sec") - slack), F.lit(False)))
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / 60.0), F.floor(b / 60.0)))
    ask = rows.where("_may").select("raw_id", "turn_idx", (F.col("start_sec") - slack).alias("_from"), (F.col("end_sec") + slack).alias("_to"))
    ask = ask.withColumn("_bin", bins(F.col("_from"), F.col("_to")))
    have = turns.select("raw_id", F.col("turn_idx").alias("_other"), F.col("start_sec").alias("_start"), F.col("end_sec").alias("_end"), bins(F.col("start_sec"), F.greatest("start_sec", "end_sec")).alias("_bin"))
    met = (ask["raw_id"] == have["raw_id"]) & (ask["_bin"] == have["_bin"]) & (F.col("_other") > F.col("turn_idx")) & (F.col("_start") <= F.col("_to")) & (F.col("_end") >= F.col("_from"))
    hit = ask.join(have, met, "left_semi").select("raw_id", "turn_idx").distinct().withColumn("hit", F.lit(True))
    return rows.drop("_may").join(hit, ["raw_id", "turn_idx"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def cut_clips(turns: DataFrame, least: float = 3.0, most: float = 20.0) -> DataFrame:
    """Turns of a usable length as clips, numbered in a file, with the id of the clip's name."""
    w = Window.partitionBy("raw_id").orderBy("start_sec", "turn_idx")
    rows = turns.where((F.col("end_sec") - F.col("start_sec")).between(least, most)).withColumn("seq", (F.row_number().over(w) - 1).cast("long"))
    return rows.withColumn("id", short_hash(F.concat(F.col("raw_id").cast("string"), F.lit("_"), F.col("seq").cast("string")), 12))


def overlap(frames: DataFrame, key: str) -> DataFrame:
    """The shares of frames (key, active speakers) with two or more, and with one or more, of them."""
    share = lambda n: F.avg(F.when(F.col("active") >= n, 1.0).otherwise(0.0))
    return frames.groupBy(key).agg(share(2).alias("overlap"), share(1).alias("speech"))


def is_music(tag: Column) -> Column:
    words = "|".join(w.replace("(", r"\(").replace(")", r"\)") for w in L.MUSIC_WORDS)
    return F.lower(tag).rlike(words) & ~tag.isin(*L.NOT_MUSIC)


def correlation(rows: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Pearson's r by group; null where either does not vary."""
    s = rows.groupBy(*by).agg(F.covar_pop(x, y).alias("_c"), F.stddev_pop(x).alias("_x"), F.stddev_pop(y).alias("_y"))
    return s.select(*by, F.try_divide("_c", F.col("_x") * F.col("_y")).alias("r"))


def snr_of_frames(frames: DataFrame, key: str, order: str) -> DataFrame:
    """10 log10 of the mean energy of the loudest tenth of frames over that of the quietest, to one place."""
    w = Window.partitionBy(key)
    f = frames.withColumn("_k", F.row_number().over(w.orderBy("energy", order))).withColumn("_n", F.count("*").over(w))
    tenth = F.greatest(F.lit(1), F.floor(F.col("_n") / 10))
    top, low = F.avg(F.when(F.col("_k") > F.col("_n") - tenth, F.col("energy"))), F.avg(F.when(F.col("_k") <= tenth, F.col("energy")))
    return f.groupBy(key).agg(F.round(10 * F.log10((top + 1e-10) / (low + 1e-10)), 1).alias("snr"))
