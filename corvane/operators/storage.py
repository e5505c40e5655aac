"""Keys, budgets, copies and placement of stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def update_by_key(rows: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """rows with the column's new values where there are any."""
    new = changes.select(key, F.col(column).alias("_new"))
    return rows.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def remap_key(results: DataFrame, names: dict[str, str]) -> DataFrame:
    """results (id, model, …) under new names of models; where the new name has a row, that stays and the renamed one goes."""
    m = F.col("model")
    new = F.coalesce(*(F.when(m == a, b) for a, b in names.items()), m)
    w = Window.partitionBy("id", "_model").orderBy((F.col("model") == F.col("_model")).desc(), "model")
    rows = results.withColumn("_model", new).withColumn("_rank", F.row_number().over(w)).where("_rank = 1")
    return rows.withColumn("model", F.col("_model")).drop("_model", "_rank")


def verify_copies(old: DataFrame, new: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, verified): whether both contents have one digest. Contents are digested before they meet, and not shuffled."""
    x, y = old.select(key, F.md5(a).alias("_a")), new.select(key, F.md5(b).alias("_b"))
    return x.join(y, key, "left").select(key, F.coalesce(F.col("_a") == F.col("_b"), F.lit(False)).alias("verified"))


def cap_by_size(rows: DataFrame, by: list[str], order: list[str], size: str, budget: float) -> DataFrame:
    """Rows in order until the budget is used up; the one that passes it is in."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_before", F.coalesce(F.sum(size).over(w), F.lit(0.0))).where(F.col("_before") < budget).drop("_before")


def evict_lru(rows: DataFrame, by: list[str], used_at: str, key: str, size: str, budget: float) -> DataFrame:
    """What goes for the rest, the latest used, to fit the budget."""
    w = Window.partitionBy(*by).orderBy(F.desc(used_at), F.desc(key)).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_kept", F.sum(size).over(w)).where(F.col("_kept") > budget).drop("_kept")


def round_robin(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """Rows dealt to n devices in turn, in order.

    A row's place is its place in its partition of a range partitioning plus the rows of those before, of which a count each
    is known; no task sees all rows."""
    spark = rows.sparkSession
    parts = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    parts = parts.withColumn("_id", F.monotonically_increasing_id())  # partition << 33 | place in it
    before = parts.groupBy(F.shiftright("_id", 33).alias("_part")).agg(F.count("*").alias("_n"))
    before = before.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    out = parts.withColumn("_part", F.shiftright("_id", 33)).join(F.broadcast(before), "_part")  # a row a partition
    return out.withColumn("device", (F.col("_before") + place) % n).drop("_id", "_part", "_n", "_before")


def active_entries(rows: DataFrame) -> DataFrame:
    """Source entries that are not done, skipped or paused, with a real address."""
    off = F.col("status").isin("skip", "done", "paused") | (F.col("priority") == "skip") | F.col("url").rlike("^(PLACEHOLDER|SKIP|SEARCH)")
    return rows.where(~F.coalesce(off, F.lit(False)))


def fan_out(rows: DataFrame, parts: dict[str, list]) -> DataFrame:
    """rows once for each condition of each part that holds, with `part` and `nth`: one scan for all tables that a row makes rows of."""
    each = [F.when(when, F.struct(F.lit(name).alias("part"), F.lit(k).alias("nth"))) for name, conditions in parts.items() for k, when in enumerate(conditions)]
    return rows.select("*", F.inline(F.filter(F.array(*each), lambda x: x.isNotNull())))
