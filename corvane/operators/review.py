"""Human review: queue, decisions, and what they change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drawn(key: str, seed: int = 0):
    """A random order that can be repeated, and that any engine has: the digest of the key and a seed."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}")))


def sample_queue(candidates: DataFrame, queued: DataFrame, n: int, order: str = "random", seed: int = 0) -> DataFrame:
    """n candidates that are not queued: the least agreeing, or by a hash of the id, which is a random order that can be repeated."""
    rows = candidates.join(queued.select("id"), "id", "left_anti")
    by = [F.col("agreement").asc(), F.col("id")] if order == "agreement_asc" else [drawn("id", seed), F.col("id")]
    return rows.orderBy(*by).limit(n)


def candidates(agreement: DataFrame, filters: DataFrame, tiers: DataFrame, tier: str | None = None, min_agreement: float | None = None, code_switch: str | None = None) -> DataFrame:
    """(id, best_text, agreement) of what may be reviewed: segments that pass the gates, of a tier, from an agreement on, with ('only') or without
    ('exclude') English in them."""
    if code_switch not in (None, "only", "exclude"):
        raise ValueError(f"code_switch is {code_switch!r}")
    rows = agreement.select("id", "best_text", "agreement").join(filters.where("pass").select("id", "english_ratio"), "id")
    if tier is not None:
        rows = rows.join(tiers.where(F.col("tier") == tier).select("id"), "id", "left_semi")
    if min_agreement is not None:
        rows = rows.where(F.col("agreement") >= min_agreement)
    if code_switch is not None:
        rows = rows.where("english_ratio > 0" if code_switch == "only" else "english_ratio = 0")
    return rows.drop("english_ratio")


DECISIONS = ("verified", "skipped", "rejected", "flagged")


def check_decisions(decisions: DataFrame) -> None:
    """Refuses decisions of another kind, and ids that are decided twice."""
    bad = decisions.where(~F.coalesce(F.col("decision").isin(*DECISIONS), F.lit(False))).limit(1).collect()
    if bad:
        raise ValueError(f"invalid decision {bad[0]['decision']!r} of {bad[0]['id']}")
    twice = decisions.groupBy("id").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two decisions of {twice[0]['id']}")


def decided_tiers(decisions: DataFrame) -> DataFrame:
    """(id, tier, provenance): verified texts are gold, rejected ones excluded; others change nothing."""
    yes = F.col("decision") == "verified"
    return decisions.where("decision in ('verified', 'rejected')").select("id", F.when(yes, "gold").otherwise("excluded").alias("tier"), F.when(yes, "calibrate_verify").otherwise("calibrate_reject").alias("provenance"))


def stratified(rows: DataFrame, strata: list[str], n: int, seed: int = 0) -> DataFrame:
    """About n rows, in each stratum in proportion to its size and one at least."""
    from pyspark.sql import Window

    sizes = rows.groupBy(*strata).agg(F.count("*").alias("_size"))
    total = sizes.agg(F.sum("_size").alias("_total"))
    want = F.least(F.col("_size"), F.greatest(F.lit(1), F.round(n * F.col("_size") / F.col("_total")))).cast("long")
    sizes = sizes.join(F.broadcast(total)).select(*strata, want.alias("_want"), "_size")  # one row
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in strata]
    # only a share of a large stratum is ranked: the rows of least hash, more than are wanted by a sixth and 40
    place = F.conv(F.substring(drawn("id", seed), 1, 7), 16, 10).cast("long")
    share = lambda w: F.ceil((1.2 * F.col(w) + 40) / F.col("_size") * (1 << 28))
    near = rows.withColumn("_at", place).alias("r").join(sizes.select(*strata, "_want", "_size").alias("s"), same).where(F.col("_at") <= share("_want")).select("r.*", "_want", "_size")
    w = Window.partitionBy(*strata).orderBy(drawn("id", seed), "id")
    return near.withColumn("_rank", F.row_number().over(w)).where("_rank <= _want").drop("_rank", "_at", "_want", "_size")


def apply_decisions(decisions: DataFrame, agreement: DataFrame, tiers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The agreement and tier tables after decisions (id, decision, reviewed_text): verified texts are gold and hold the
    reviewed text, rejected ones are excluded, others change nothing."""
    verified = decisions.where("decision = 'verified'").select("id", F.col("reviewed_text").alias("_text"), F.lit(True).alias("_yes"))
    yes = F.coalesce("_yes", F.lit(False))
    out = agreement.join(verified, "id", "left").withColumn("best_text", F.when(yes, F.col("_text")).otherwise(F.col("best_text"))).withColumn("text_verified", F.when(yes, True).otherwise(F.col("text_verified")))
    from corvane.sources.catalog import upsert

    return out.select(agreement.columns), upsert(tiers, decided_tiers(decisions), ["id"])


def overlay(rows: DataFrame, pending: DataFrame) -> DataFrame:
    """rows with the decisions of a buffer that is not flushed yet, the last of each id, over their own."""
    from corvane.sources.catalog import dedup_last

    last = dedup_last(pending, ["id"], "seq").select("id", F.col("decision").alias("_decision"))
    return rows.join(last, "id", "left").withColumn("decision", F.coalesce("_decision", "decision")).drop("_decision")


def recommended_n(population: int, rate: float, least: int, code_switch: bool = False) -> int:
    return max(least, round(population * min(1.0, rate * 10 if code_switch else rate)))
