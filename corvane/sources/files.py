"""Files beside the catalog: JSON lines in and out, exports, and constants."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines under a schema that is given; lines that do not fit it read as nulls."""
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, order: str = "id") -> None:
    """df as JSON lines in order over the files, without the keys of null fields. Text is written as it is, not escaped."""
    df.sort(order).select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def export_name(base: str, min_tier: str | None = None, min_quality_tier: str | None = None, code_switch: str | None = None, min_agreement: float | None = None) -> str:
    """The file name of a cut, so that cuts never replace the whole export."""
    tags = [min_tier, min_quality_tier and f"quality{min_quality_tier}", code_switch and f"cs_{code_switch}", None if min_agreement is None else f"agree{round(min_agreement * 100):03d}"]
    return "_".join([base, *(t for t in tags if t)])


def export_manifest(entries: DataFrame, path: str, train: DataFrame | None = None, val: DataFrame | None = None) -> None:
    """manifest, train and val under `path`; ids that are in train or val already stay there."""
    from corvane.operators.manifest import split

    rows = entries.persist()
    try:
        sides = split(rows.select("id", "source", "speaker_id"), train, val).select("id", "split").persist()
        write_jsonl(rows, f"{path}/manifest")
        for side in ("train", "val"):
            write_jsonl(rows.join(sides.where(F.col("split") == side).select("id"), "id", "left_semi"), f"{path}/{side}")
        sides.unpersist()
    finally:
        rows.unpersist()


def write_constants(one: DataFrame, path: str, version: str) -> dict:
    """A one-row frame of constants as a JSON file."""
    out = {"version": version, **one.first().asDict(recursive=True)}
    write_text(one.sparkSession, path, json.dumps(out, ensure_ascii=False, sort_keys=True))
    return out


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    f = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    f.write(bytearray(text.encode()))
    f.close()
