"""Nodes over a catalog: each discovers what is due, computes it, puts it in, and journals it.

Nodes stand in rounds; a round needs what the rounds before have written. A run that is repeated finds nothing due.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions import agreement as A
from corvane.functions import pause as P
from corvane.functions.models import RESOURCES
from corvane.operators import gates as G
from corvane.operators.discover import decide_due, discover
from corvane.sources.catalog import Catalog


@dataclass(frozen=True)
class Node:
    writes: str
    reads: tuple[str, ...]
    due: Callable[[Catalog], DataFrame]
    compute: Callable[[Catalog, DataFrame], DataFrame]


def _agreement_due(c: Catalog) -> DataFrame:
    counts = c.read("asr_results").groupBy("id").agg(F.count("*").cast("int").alias("n")).where("n >= 2")
    old = c.read("asr_agreement").select("id", "model_count", "text_verified", F.lit(True).alias("there"))
    # a text that a person has verified is not computed anew
    return counts.join(old, "id", "left").where("there is null or (model_count is not null and n > model_count and not coalesce(text_verified, false))").select("id")


def _agreement(c: Catalog, due: DataFrame) -> DataFrame:
    """Models count as RESOURCES['asr_models'] knows them (a name in results to its key), or all under their own names where it knows none."""
    known = RESOURCES["asr_models"]
    return A.agreement_rows(c.read("asr_results").join(due.select("id"), "id", "left_semi"), models=known or None)


def _text_due(c: Catalog) -> DataFrame:
    rows = c.read("asr_agreement").join(c.read("segments").select("id", "duration_sec", "sample_rate"), "id")
    return discover(rows, c.read("filters_text").withColumn("provenance", F.lit("filter_text")), stale=("model_count", "asr_model_count"))


def _decide(c: Catalog, due: DataFrame) -> DataFrame:
    return G.filter_decide(due, c.read("filters_acoustic"), c.read("labels_lang")).withColumn("provenance", F.lit("filter_decide"))


def _tier_due(c: Catalog) -> DataFrame:
    rows = c.read("asr_agreement").join(c.read("filters").select("id", "dnsmos"), "id", "left")
    return discover(rows, c.read("tiers"), stale=("model_count", "asr_model_count"), protected=("calibrate_verify", "calibrate_reject"))


def _quality_due(c: Catalog) -> DataFrame:
    rows = c.read("tiers").where(F.col("tier").isin("gold", "auto_gold")).select("id").join(c.read("filters").where("pass").select("id", "dnsmos"), "id")
    rows = rows.join(c.read("labels_music").select("id", "music_prob"), "id", "left").join(c.read("labels_overlap").select("id", "overlap_ratio"), "id", "left")
    return discover(rows, c.read("quality_tiers"), provenance=("quality_tier_assign",))


def _pause_due(c: Catalog) -> DataFrame:
    rows = c.read("tiers").where(F.col("tier").isin("gold", "auto_gold", "silver")).select("id").join(c.read("alignments").select("id", "chars"), "id")
    rows = rows.join(c.read("asr_agreement").select("id", "best_text"), "id").join(c.read("segments").select("id", "duration_sec"), "id")
    return discover(rows, c.read("pause_plan"), provenance=("pause_plan",))


def _pause(c: Catalog, due: DataFrame) -> DataFrame:
    rows = due.withColumn("p", P.pause_plan(F.col("best_text"), F.col("chars"), F.col("duration_sec")))
    return rows.select("id", F.col("p.plan").alias("plan"), *(x.alias(k) for k, x in P.counts(F.col("p.plan")).items()), F.col("p.unalignable").alias("unalignable"), F.lit("v2").alias("calibration_version"), F.lit("pause_plan").alias("provenance"))


NODES: dict[str, Node] = {
    "asr.agreement": Node("asr_agreement", ("asr_results",), _agreement_due, _agreement),
    "filter.text": Node("filters_text", ("asr_agreement", "segments"), _text_due, lambda c, due: G.filter_text(due)),
    "filter.decide": Node("filters", ("filters_text", "filters_acoustic", "labels_lang"), lambda c: decide_due(c.read("filters_text"), c.read("filters_acoustic"), c.read("filters"), c.read("labels_lang")), _decide),
    "tier.assign": Node("tiers", ("asr_agreement", "filters"), _tier_due, lambda c, due: due.select("id", G.tier().alias("tier"), F.lit("tier_assign").alias("provenance"), F.col("model_count").alias("asr_model_count"))),
    "quality_tier.assign": Node("quality_tiers", ("tiers", "filters", "labels_music", "labels_overlap"), _quality_due, lambda c, due: due.select("id", G.quality_tier().alias("quality_tier"), F.lit("quality_tier_assign").alias("provenance"))),
    "pause.plan": Node("pause_plan", ("tiers", "alignments", "asr_agreement"), _pause_due, _pause),
}


def in_chain() -> dict[str, Node]:
    """The nodes of a chain: all but those run by hand and those whose model is not registered."""
    from corvane import nodes
    from corvane.functions.models import MODELS

    return {n: x for n, x in NODES.items() if n not in nodes.BY_HAND and (n not in nodes.MODEL_NODES or n in MODELS)}


def rounds(nodes: dict[str, Node] | None = None) -> list[list[str]]:
    """Nodes in an order in which each comes after all that write what it reads; those that write one table come one after another."""
    nodes = dict(nodes or in_chain())
    out = []
    while nodes:
        ready = sorted(n for n, x in nodes.items() if not any(y.writes in x.reads and not (x.writes == y.writes) for m, y in nodes.items() if m != n))
        ready = [n for k, n in enumerate(ready) if nodes[n].writes not in [nodes[m].writes for m in ready[:k]]]
        if not ready:
            raise ValueError(f"nodes wait for each other: {sorted(nodes)}")
        out.append(ready)
        for n in ready:
            del nodes[n]
    return out


def run_node(catalog: Catalog, name: str, limit: int | None = None) -> dict:
    """Runs one node over what is due (the first `limit` ids, if given) and returns what it did."""
    node, run_id = NODES[name], f"{name.replace('.', '_')}_{uuid.uuid4().hex[:12]}"
    due = node.due(catalog)
    if limit is not None:
        due = due.orderBy("id").limit(limit)
    made = node.compute(catalog, due).persist()
    try:
        n = catalog.upsert(node.writes, made)
        if n:
            catalog.journal(run_id, name, items(catalog, name, made))
    except Exception as error:
        due = due.select(next(c for c in ("id", "raw_id", "audio_path", "source") if c in due.columns))
        catalog.journal(run_id, name, due, status="error", error=f"{type(error).__name__}: {error}"[:2000])
        raise
    finally:
        made.unpersist()
    return {"node": name, "run_id": run_id, "rows": n}


def items(catalog: Catalog, name: str, made: DataFrame) -> DataFrame:
    """The item of each computed row: the first key of the node's table."""
    return made.select(catalog.tables[NODES[name].writes].keys[0])


def run_many(catalog: Catalog, names: list[str]) -> list[dict]:
    """Runs nodes that write different tables at the same time; the journal is written by one at a time."""
    written = [NODES[n].writes for n in names]
    if len(set(written)) != len(written):
        raise ValueError(f"{names} write one table")
    runs = {n: f"{n.replace('.', '_')}_{uuid.uuid4().hex[:12]}" for n in names}
    made = {}

    def run(n: str) -> int:
        made[n] = NODES[n].compute(catalog, NODES[n].due(catalog)).persist()
        return catalog.upsert(NODES[n].writes, made[n])

    out, failed = [], None
    try:
        with ThreadPoolExecutor(len(names)) as pool:
            done = {n: pool.submit(run, n) for n in names}
        for n, f in done.items():
            if error := f.exception():
                failed = failed or error
                continue
            if f.result():
                catalog.journal(runs[n], n, items(catalog, n, made[n]))
            out.append({"node": n, "run_id": runs[n], "rows": f.result()})
    finally:
        for m in made.values():
            m.unpersist()
    if failed:
        raise failed
    return out


def run_chain(catalog: Catalog, only: list[str] | None = None, skip: tuple[str, ...] = (), dry_run: bool = False) -> list[dict]:
    """All rounds in order; the first failure ends the chain."""
    out = []
    for names in rounds():
        for n in names:
            if (only is None or n in only) and n not in skip:
                out.append({"node": n, "rows": None} if dry_run else run_node(catalog, n))
    return out
