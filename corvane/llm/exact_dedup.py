"""Exact duplicates by progressive refinement, with DataFrame functions only.

Rows are grouped by length, then by a hash of a prefix, then by a hash of the whole normalised text; the last is
computed only for rows whose length and prefix hash occur more than once. Those survivors reach the second scan as a
bitmap of fixed size (`bitmap_bits`, 1 MB by default), so no text is shuffled and the broadcast does not grow with the
data: a full bitmap only means that more rows are hashed, and the last grouping is exact for any bitmap.

Length and prefix hash are refined in one aggregation, because a hash of a short prefix costs less than another
shuffle. Groups of any size are combined before the shuffle, and the join that gives each row its group is one that
adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import WS, Cuts, table, whole

PREFIX_CHARS = 256
BITMAP_BITS = 1 << 23


def normalised(text: Column) -> Column:
    return F.regexp_replace(whole(text), WS, " ")


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, bitmap_bits: int = BITMAP_BITS, digest: bool = False) -> DataFrame:
    """(id, keep_id, group_size, kept[, text_sha256]) for each row of df.

    Null texts are empty texts, and empty texts equal each other. Of equal texts the smallest id stays; a null id is
    never smallest unless all are null, and is then kept. Rows that repeat an id and its text share one verdict.
    An empty table gives an empty result. Other columns are not read. With `digest`, every row's full hash is returned
    and so computed.
    """
    t = normalised(F.col(text_col))
    head = [F.length(t).alias("_n"), F.xxhash64(F.substring(t, 1, prefix_chars)).alias("_p")]
    spot = F.pmod(F.xxhash64("_n", "_p"), F.lit(bitmap_bits))
    again = df.select(*head).groupBy("_n", "_p").agg(F.count("*").alias("_c")).where("_c > 1")
    bits = again.select(spot.alias("_s")).groupBy(F.bitmap_bucket_number("_s").alias("_b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_s")).alias("_map"))
    byte = F.conv(F.hex(F.expr("substring(_map, cast(bitmap_bit_position(_s) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.coalesce(F.expr("shiftright(_byte, cast(bitmap_bit_position(_s) % 8 as int)) & 1") == 1, F.lit(False))
    rows = df.select(F.col(id_col).alias("_id"), t.alias("_t"), *head).withColumn("_s", spot)
    rows = rows.withColumn("_b", F.bitmap_bucket_number("_s")).join(F.broadcast(bits), "_b", "left").withColumn("_byte", byte).withColumn("_hit", hit)
    full = F.unhex(F.sha2(F.col("_t"), 256))
    rows = rows.select("_id", "_hit", (full if digest else F.when(F.col("_hit"), full)).alias("_full"))
    cuts = Cuts(df.sparkSession)
    rows = cuts.cut(rows, "exact-dedup", narrow=True)
    groups = rows.where("_hit").groupBy(F.col("_full").alias("_key")).agg(F.min("_id").alias("_keep"), F.count("*").alias("_size")).where("_size > 1")
    groups = cuts.cut(groups, "exact-groups", narrow=True)  # both sides of the join are then plain exchanges, whose hot keys Spark can split
    # a row without a partner gets a key of its own, so that such rows do not meet in one task
    key = F.when(F.col("_hit"), F.col("_full")).otherwise(F.concat(F.lit("row:"), F.monotonically_increasing_id().cast("string")).cast("binary"))
    out = rows.withColumn("_key", key).join(groups, "_key", "left")
    keep = F.coalesce("_keep", "_id")
    columns = [F.col("_id").alias(id_col), keep.alias("keep_id"), F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"), F.col("_id").eqNullSafe(keep).alias("kept")]
    return out.select(*columns, *([F.lower(F.hex("_full")).alias("text_sha256")] if digest else []))


def op6_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"), digest=True)


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
