"""python -m corvane: catalog and node commands."""

from __future__ import annotations

import argparse
import json

from corvane import dag, jobs, nodes  # noqa: F401
from corvane.session import session
from corvane.sources.catalog import Catalog


def other(catalog: Catalog, a: argparse.Namespace) -> dict:
    """Commands that are no nodes."""
    if a.command == "rebuild":
        return {"rows": jobs.import_sources(catalog, a.path) if a.table == "sources" else jobs.import_jsonl(catalog, a.table, a.path)}
    if a.command == "commit":
        return {"rows": jobs.ingest_commit(catalog, a.staging, a.checkpoint)}
    if a.command == "export":
        return jobs.manifest_export(catalog, a.out, min_tier=a.min_tier, min_quality_tier=a.min_quality_tier, code_switch=a.code_switch, min_agreement=a.min_agreement)
    if a.command == "report":
        return jobs.report_build(catalog, a.out, a.min_tier)
    if a.command == "label-calibrate":
        return jobs.label_calibrate(catalog, a.out)
    if a.command == "label-store":
        return jobs.label_store(catalog, a.out, a.calibration)
    if a.command == "delete-verified":
        return {"deleted": jobs.delete_verified(catalog, a.limit)}
    if a.command == "prune-logs":
        return jobs.prune_logs(a.folder)
    if a.review == "sample":
        return jobs.calibrate_sample(catalog, a.n, a.tier, a.min_agreement, a.code_switch, a.order)
    if a.review == "record":
        rows = catalog.spark.read.schema("id string, decision string, reviewed_text string, flag_reason string").json(a.path)
        return {"recorded": jobs.record_decisions(catalog, rows)}
    return {r["decision"]: r["count"] for r in catalog.read("calibration_review").groupBy("decision").count().collect()}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="corvane")
    p.add_argument("--catalog", required=True, help="folder of the catalog")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("build", help="make the tables that are not there")
    verify = sub.add_parser("verify", help="check keys, row counts and audio files")
    verify.add_argument("--floor", nargs="*", default=[], metavar="TABLE=ROWS")
    verify.add_argument("--paths", type=int, default=0, help="audio files to look for")
    rebuild = sub.add_parser("rebuild", help="a table anew from JSON lines, or sources from YAML lists")
    rebuild.add_argument("table")
    rebuild.add_argument("path")
    commit = sub.add_parser("commit", help="commit staged rows once each")
    commit.add_argument("--staging", required=True)
    commit.add_argument("--checkpoint", required=True)
    export, report = sub.add_parser("export", help="manifest, train and val"), sub.add_parser("report", help="the acceptance report")
    export.add_argument("--out", required=True)
    export.add_argument("--min-tier")
    export.add_argument("--min-quality-tier")
    export.add_argument("--code-switch", choices=["only", "exclude"])
    export.add_argument("--min-agreement", type=float)
    report.add_argument("--out", required=True)
    report.add_argument("--min-tier", default="bronze")
    constants, store = sub.add_parser("label-calibrate", help="constants of rate and pitch"), sub.add_parser("label-store", help="labels.jsonl")
    constants.add_argument("--out", required=True)
    store.add_argument("--out", required=True)
    store.add_argument("--calibration", required=True)
    calibrate = sub.add_parser("calibrate", help="review").add_subparsers(dest="review", required=True)
    sample = calibrate.add_parser("sample", help="queue segments")
    sample.add_argument("--n", type=int, default=300)
    sample.add_argument("--tier")
    sample.add_argument("--min-agreement", type=float)
    sample.add_argument("--code-switch", choices=["only", "exclude"])
    sample.add_argument("--order", choices=["random", "agreement_asc"], default="random")
    calibrate.add_parser("stats", help="decisions so far")
    record = calibrate.add_parser("record", help="record decisions of a file of JSON lines")
    record.add_argument("path")
    clean = sub.add_parser("delete-verified", help="delete originals whose copy is verified")
    clean.add_argument("--limit", type=int, default=1000)
    prune = sub.add_parser("prune-logs", help="compress and delete old logs")
    prune.add_argument("folder")
    run = sub.add_parser("run", help="run one node")
    run.add_argument("node", choices=sorted(dag.NODES))
    run.add_argument("--limit", type=int)
    many = sub.add_parser("run-many", help="run nodes at the same time")
    many.add_argument("nodes", nargs="+", choices=sorted(dag.NODES))
    chain = sub.add_parser("chain", help="run all rounds")
    chain.add_argument("--only", nargs="*")
    chain.add_argument("--skip", nargs="*", default=[])
    chain.add_argument("--dry-run", action="store_true")
    a = p.parse_args(argv)
    catalog = Catalog(session(), a.catalog)
    if a.command == "build":
        catalog.ensure()
        out = {"tables": sorted(catalog.tables)}
    elif a.command == "verify":
        out = {"wrong": catalog.verify({t: int(n) for t, n in (f.split("=") for f in a.floor)}, a.paths)}
    elif a.command == "run":
        out = dag.run_node(catalog, a.node, a.limit)
    elif a.command == "run-many":
        out = dag.run_many(catalog, a.nodes)
    elif a.command == "chain":
        out = dag.run_chain(catalog, a.only, tuple(a.skip), a.dry_run)
    else:
        out = other(catalog, a)
    print(json.dumps(out, ensure_ascii=False))
    return int(bool(a.command == "verify" and out["wrong"]))


if __name__ == "__main__":
    raise SystemExit(main())
