"""The corpus pipeline: language ID, exact dedup, near dedup, repeated passages, packing.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, and each is applied to what the
one before has kept. All but the last return the columns of docs, whatever else docs has. Ids may repeat or be null: a row
is known by its id and text, and rows that repeat both share one decision, but for exact dedup, which keeps one of them.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from corvane.llm.common import Cuts, maybe_in, table
from corvane.llm.exact_dedup import exact_duplicates
from corvane.llm.language_id import UNKNOWN, held_out, language_id
from corvane.llm.near_dedup import near_duplicates
from corvane.llm.packing import pack
from corvane.llm.suffix_dedup import cut_out, merged, spans_of, without_repeats


def _key() -> Column:
    return F.xxhash64("doc_id", "text").alias("_key")


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs without the rows of these keys. Only rows whose key may be among them are shuffled."""
    rows = maybe_in(docs.select(F.struct("*").alias("_row"), _key()), "_key", dropped)
    return rows.where("not _maybe").select("_row.*").unionByName(rows.where("_maybe").join(dropped.distinct(), "_key", "left_anti").select("_row.*"))


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those without a letter go."""
    train = docs.where(~held_out()).select(_key(), "text", "lang")
    found = language_id(docs.select(_key(), "text"), train=train, id_col="_key")
    return _without(docs, Cuts(spark).cut(found.where(F.col("lang_pred") == UNKNOWN).select("_key"), "pipeline-no-language", narrow=True))


def _order() -> Column:
    """Smallest ids first, null ids last."""
    return F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), _key().alias("k")).alias("order")


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id, once."""
    cuts = Cuts(spark)
    found = cuts.cut(exact_duplicates(docs.select(_order(), "text"), id_col="order").select(F.col("order.k").alias("_key"), "kept"), "pipeline-exact", narrow=True)
    out = _without(docs, found.where("not kept").select("_key"))
    again = cuts.cut(found.where("kept").groupBy("_key").count().where("count > 1").select("_key"), "pipeline-repeated", narrow=True)
    if again.isEmpty():
        return out
    # rows that repeat an id and its text
    rows = out.select(F.struct("*").alias("_row"), _key())
    return rows.join(again, "_key", "left_anti").select("_row.*").unionByName(rows.join(again, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*"))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 or more: that with the smallest id."""
    found = near_duplicates(docs.select(_order(), "text"), id_col="order")
    return _without(docs, Cuts(spark).cut(found.where("not kept").select(F.col("order.k").alias("_key")), "pipeline-near", narrow=True))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of 200 bytes that also start elsewhere; characters cut in part go. n_chars follows."""
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("_row")
    found = without_repeats(docs.select(others, F.col("text").isNull().alias("_null"), F.col("text").alias("text")))

    def cut(batches):
        for b in batches:
            parts = list(zip(b.column(2).to_pylist(), spans_of(b.column(3))))
            text = [(cut_out(r, merged(s, len(r))) if len(s) else r).decode("utf-8", "ignore") for r, s in parts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(s) > 0 for _, s in parts])], names=["_row", "_null", "_text", "_cut"])

    schema = StructType([found.schema["_row"], found.schema["_null"], StructField("_text", StringType()), StructField("_cut", BooleanType())])
    found = found.select("_row", "_null", "raw", "spans").mapInArrow(cut, schema)
    of = {"text": F.when(~F.col("_null"), F.col("_text")), "n_chars": F.when(F.col("_cut"), F.length("_text").cast("long")).otherwise(F.col("_row.n_chars"))}
    return found.select(*((of[c] if c in of else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 1024 tokens."""
    return pack(docs.select("doc_id", "text"))


STAGES = [("language ID", detect_language), ("exact dedup", drop_exact), ("near dedup", drop_near), ("passages", drop_passages), ("packing", pack_sequences)]

#: No SQL can express the first, third and last stage; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over documents, each stage's result written as Parquet and read again."""
    docs, cuts = table(spark, sf_dir, "documents"), Cuts(spark)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        docs = cuts.cut(out, f"pipeline-stage-{k}")
