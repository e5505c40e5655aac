"""Source lists: YAML files of entries with an address, one table row each."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def entries(text: str) -> list[dict]:
    """The entries of a list file: a list, or what stands under sources, channels or podcasts. A download_config after them is left off,
    and a file that is no YAML has none. Entries without an address are left out."""
    import yaml

    at = re.search(r"^\s*download_config\s*:", text, re.M)
    try:
        doc = yaml.safe_load(text[: at.start()] if at else text)
    except yaml.YAMLError:
        return []
    if isinstance(doc, dict):
        doc = doc.get("sources") or doc.get("channels") or doc.get("podcasts")
    return [e for e in doc or [] if isinstance(e, dict) and e.get("url")] if isinstance(doc, list) else []


def read_lists(spark: SparkSession, folder: str) -> DataFrame:
    """(source_key, kind, program, domain, style, config, status, priority, url): kind is the file's name; of an address that is repeated the
    last entry of the last file stays."""
    found = spark.read.text(folder, wholetext=True, pathGlobFilter="*.yaml").select("value", F.input_file_name().alias("path"))

    def parse(batches):
        for pdf in batches:
            rows = []
            for text, path in zip(pdf.value, pdf.path):
                kind = path.rsplit("/", 1)[-1].removesuffix(".yaml")
                for k, e in enumerate(entries(text)):
                    of = lambda c, e=e: None if e.get(c) is None else str(e[c])
                    rows.append((str(e["url"]), kind, of("name") or "", of("domain") or "", of("style") or "", json.dumps(e, ensure_ascii=False, default=str), of("status"), of("priority"), k))
            yield pd.DataFrame(rows, columns=["source_key", "kind", "program", "domain", "style", "config", "status", "priority", "k"])

    rows = found.mapInPandas(parse, "source_key string, kind string, program string, domain string, style string, config string, status string, priority string, k int")
    last = rows.groupBy("source_key").agg(F.max_by(F.struct("kind", "program", "domain", "style", "config", "status", "priority"), F.struct("kind", "k")).alias("r"))
    return last.select("source_key", "r.*", F.col("source_key").alias("url"))
