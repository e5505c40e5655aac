"""Discovery: which eligible rows a node has not done yet, or has done from a state that is out of date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def discover(eligible: DataFrame, done: DataFrame, keys: list[str] | str = "id", provenance: tuple[str, ...] | None = None, stale: tuple[str, str] | None = None, protected: tuple[str, ...] = ()) -> DataFrame:
    """Eligible rows without a row in `done`.

    With `provenance` only rows of `done` by these writers count. With stale = (eligible's column, done's column), rows whose
    two versions differ (null-safe) are due as well, unless their row in `done` has a provenance in `protected`. The right
    side is cut down to what the join needs before it, so an outer join keeps its outer rows.
    """
    keys = [keys] if isinstance(keys, str) else keys
    if provenance is not None:
        done = done.where(F.col("provenance").isin(*provenance))
    if stale is None:
        return eligible.join(done.select(*keys), keys, "left_anti")
    mine, theirs = stale
    right = done.select(*keys, F.col(theirs).alias("_version"), (F.col("provenance") if protected else F.lit(None).cast("string")).alias("_provenance"), F.lit(True).alias("_done"))
    rows = eligible.join(right, keys, "left")
    due = F.col("_done").isNull() | ~F.col(mine).eqNullSafe(F.col("_version"))
    if protected:
        due = due & ~F.coalesce(F.col("_provenance").isin(*protected), F.lit(False))
    return rows.where(due).drop("_version", "_provenance", "_done")


def missing_any(eligible: DataFrame, outputs: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """Eligible rows that lack any of the named outputs, with a flag need_<name> for each."""
    for name, done in outputs.items():
        eligible = eligible.join(done.select(key, F.lit(True).alias(f"_{name}")), key, "left").withColumn(f"need_{name}", F.col(f"_{name}").isNull()).drop(f"_{name}")
    any_ = F.lit(False)
    for name in outputs:
        any_ = any_ | F.col(f"need_{name}")
    return eligible.where(any_)


def decide_due(text: DataFrame, acoustic: DataFrame, decided: DataFrame, labels: DataFrame) -> DataFrame:
    """Text rows that can be decided (failed, or with acoustics) and are undecided, stale, or have a label that came later."""
    d = decided.where(F.col("provenance") == "filter_decide").select("id", F.col("text_model_count").alias("_count"), F.col("lang_label_checked").alias("_checked"), F.lit(True).alias("_done"))
    rows = text.join(acoustic.select("id", F.lit(True).alias("_heard")), "id", "left").join(d, "id", "left").join(labels.select("id", F.lit(True).alias("_label")), "id", "left")
    ready = ~F.col("pass") | F.col("_heard").isNotNull()
    due = F.col("_done").isNull() | ~F.col("asr_model_count").eqNullSafe(F.col("_count")) | (F.col("_label").isNotNull() & ~F.coalesce("_checked", F.lit(False)))
    return rows.where(ready & due).select(text.columns)
