"""Exports, the report, calibration, review and clean-up over a small catalog."""

import gzip
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from corvane import __main__ as cli
from corvane import jobs
from corvane.operators import labels as B
from corvane.operators import review as V
from corvane.sources.catalog import TABLES, Catalog
from corvane.streaming.staging import drain_while

PLAN = [{"offset": 2, "mark": "，", "kind": "normal", "delta_t": 0.9, "verdict": "long"}]


@pytest.fixture()
def catalog(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/catalog", TABLES)
    c.ensure()
    put = lambda name, schema, *rows: c.upsert(name, spark.createDataFrame(list(rows), schema))
    put("segments", "id string, audio_path string, source string, domain string, duration_sec double, sample_rate int, speaker_id string, created_at date", *((f"s{i}", f"/a/{i}.flac", "rthk" if i % 2 else "podcast", "news", 5.0 + i, 48000, f"p{i % 3}", __import__("datetime").date(2026, 1, 2)) for i in range(12)))
    put("asr_agreement", "id string, agreement double, best_text string, text_verified boolean, model_count int", *((f"s{i}", 0.5 + i / 25, "你好，嗎", False, 2) for i in range(12)))
    put("asr_results", "id string, model string, text string, confidence double", *((f"s{i}", m, "你好嗎", 0.9) for i in range(12) for m in ("a", "b")))
    put("g2p", "id string, jyutping string, valid_fraction double, provenance string, jyutping_cs string", *((f"s{i}", "nei5 hou2 maa3", 1.0, "g2p_node", "nei5 hou2 maa3") for i in range(12)))
    put("filters", "id string, pass boolean, provenance string, dnsmos double, snr_db double, english_ratio double", *((f"s{i}", i != 11, "filter_decide", 3.5, 40.0, 0.1 if i == 3 else 0.0) for i in range(12)))
    put("tiers", "id string, tier string, provenance string", *((f"s{i}", ["gold", "auto_gold", "silver", "excluded"][i % 4], "tier_assign") for i in range(12)))
    put("pause_plan", TABLES["pause_plan"].schema, *((f"s{i}", PLAN if i else [], int(bool(i)), 0, 0, int(bool(i)), i == 4, "v2", "pause_plan") for i in range(0, 12, 4)))
    put("alignments", "id string, chars array<struct<ch:string,start_sec:double,end_sec:double>>", ("s8", [{"ch": c, "start_sec": t, "end_sec": t + 0.1} for c, t in (("你", 0.0), ("好", 0.2), ("嗎", 1.2))]))
    put("labels_lang", "id string, lang string, lang_prob double, yue_prob double, cmn_prob double", *((f"s{i}", "yue", 0.9, 0.9, 0.05) for i in range(6)))
    put("labels_music", "id string, music_prob double", *((f"s{i}", 0.1) for i in range(3, 8)))
    put("labels_prosody", "id string, rate_raw double, f0_median_hz double, gaps array<struct<start_sec:double,end_sec:double,dur:double>>", *((f"s{i}", 3.0 + i, 100.0 + 10 * i, [{"start_sec": 1.0, "end_sec": 1.5, "dur": 0.5}]) for i in range(10)))
    return c


def lines(spark, path):
    return [json.loads(r[0]) for r in spark.read.text(path).collect()]


def test_manifest_export(spark, catalog, tmp_path):
    got = jobs.manifest_export(catalog, f"file://{tmp_path}/out")
    rows = {r["id"]: r for r in lines(spark, f"{got['path']}/manifest")}
    assert got["entries"] == len(rows) == 9 and "s3" not in rows and "s11" not in rows
    assert rows["s8"]["text_pause"] == "你好，<pause-long>嗎" and rows["s8"]["punct_audit"]["n_long"] == 1
    assert "text_pause" not in rows["s1"] and rows["s1"]["style"] == "formal" and rows["s1"]["created_at"] == "2026-01-02"
    assert [x["model"] for x in rows["s1"]["asr_candidates"]] == ["a", "b"]
    sides = {side: {r["id"] for r in lines(spark, f"{got['path']}/{side}")} for side in ("train", "val")}
    assert sides["train"] | sides["val"] == set(rows) and not sides["train"] & sides["val"]
    cut = jobs.manifest_export(catalog, f"file://{tmp_path}/out", min_tier="gold")
    assert cut["path"].endswith("manifest_gold") and cut["entries"] == 3


def test_report(spark, catalog, tmp_path):
    got = jobs.report_build(catalog, f"file://{tmp_path}/out")
    text = (tmp_path / "out/report.md").read_text()
    assert got["checks"] == 11 and text.count("- [PASS]") == got["passed"] and "## By source" in text and "| rthk | 3 |" in text


def test_label_calibration_and_store(spark, catalog, tmp_path):
    at = f"file://{tmp_path}/labels"
    constants = jobs.label_calibrate(catalog, at)
    assert (constants["p25"], constants["p75"], constants["n"]) == (5.25, 9.75, 10)
    got = jobs.label_store(catalog, at, at)
    rows = {r["id"]: r for r in lines(spark, got["path"])}
    assert got["lines"] == len(rows) == 8 and got["lang"] == 6 and got["music"] == 5 and got["overlap"] == 0
    assert rows["s0"]["control"]["rate"] == {"raw": 3.0, "bucket": "slow"} and "pause" in rows["s0"]["control"]
    assert rows["s4"]["control"]["pause"]["unalignable"] and rows["s4"]["control"]["pause"]["total_sec"] == 0.5
    assert rows["s7"]["quality"] == {"music": {"music_prob": 0.1}} and rows["s7"]["provenance"]["pitch"] == "parselmouth"
    assert rows["s5"]["control"]["pitch"]["z"] == round((150.0 - constants["mu"]) / constants["sigma"], 4)


def test_quantiles_are_interpolated(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 200), rng.integers(0, 20, 200))] + [(5, 1.0), (6, None)]
    got = {r["g"]: (r["a"], r["b"]) for r in B.quantiles(spark.createDataFrame(rows, "g int, v double"), ["g"], "v", {"a": 0.25, "b": 0.9}).collect()}
    for g in (0, 1, 2, 5):
        assert np.allclose(got[g], np.quantile([v for k, v in rows if k == g], [0.25, 0.9]))
    assert 6 not in got


def test_sampling_for_review(spark, catalog):
    got = jobs.calibrate_sample(catalog, n=2, tier="silver")
    assert got["queued"] == 2
    rows = {r["id"]: r for r in catalog.read("calibration_review").collect()}
    assert set(rows) <= {"s2", "s6", "s10"} and all(r["decision"] == "pending" and r["original_best_text"] for r in rows.values())
    assert jobs.calibrate_sample(catalog, n=9, tier="silver")["queued"] == 1 and jobs.calibrate_sample(catalog, n=9, tier="silver") == {"queued": 0, "run_id": None}
    of = lambda **k: {r["id"] for r in V.candidates(catalog.read("asr_agreement"), catalog.read("filters"), catalog.read("tiers"), **k).collect()}
    assert of(code_switch="only") == {"s3"} and "s3" not in of(code_switch="exclude") and "s11" not in of()
    assert of(min_agreement=0.86) == {"s9", "s10"}
    with pytest.raises(ValueError):
        of(code_switch="maybe")


def test_decisions_reach_all_three_tables(spark, catalog):
    jobs.calibrate_sample(catalog, n=100)
    rows = [("s1", "verified", "新", None), ("s2", "rejected", None, "mandarin"), ("s5", "flagged", None, "noise"), ("zz", "verified", "x", None)]
    assert jobs.record_decisions(catalog, spark.createDataFrame(rows, "id string, decision string, reviewed_text string, flag_reason string")) == 3
    one = lambda name, i: catalog.read(name).where(F.col("id") == i).first()
    assert (one("asr_agreement", "s1")["best_text"], one("asr_agreement", "s1")["text_verified"], one("tiers", "s1")["tier"]) == ("新", True, "gold")
    assert (one("tiers", "s2")["tier"], one("tiers", "s2")["provenance"], one("calibration_review", "s2")["flag_reason"]) == ("excluded", "calibrate_reject", "mandarin")
    assert one("tiers", "s5")["tier"] == "auto_gold" and one("calibration_review", "s5")["decision"] == "flagged" and one("calibration_review", "s5")["original_best_text"]
    assert catalog.read("tiers").where("id = 'zz'").isEmpty() and catalog.read("asr_agreement").count() == 12
    for bad in ([("s1", "maybe", None)], [("s1", "verified", "a"), ("s1", "skipped", None)], [("s1", None, None)]):
        with pytest.raises(ValueError):
            jobs.record_decisions(catalog, spark.createDataFrame(bad, "id string, decision string, reviewed_text string"))


def test_pause_reviews(spark, catalog):
    assert [r["id"] for r in jobs.pause_qc_next(catalog, 5).collect()] == ["s8"]
    e = jobs.pause_qc_preview(catalog, ["s8"]).first()["events"][0]
    assert (round(e["t_start"], 2), e["t_end"], e["verdict"]) == (0.3, 1.2, "long")
    judged = spark.createDataFrame([("s8", 2, "short", True, "")], "id string, punct_offset int, perceived_verdict string, position_ok boolean, note string")
    assert jobs.record_pause_qc(catalog, judged) == 1 and jobs.pause_qc_next(catalog).isEmpty()
    assert catalog.read("pause_qc_review").first()["plan_verdict"] == "long"
    with pytest.raises(ValueError):
        jobs.record_pause_qc(catalog, judged.withColumn("punct_offset", F.lit(3)))


def test_stratified_samples_are_whole(spark):
    rows = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") == 1, "one").otherwise("common").alias("s"))
    got = {r["s"]: r["count"] for r in V.stratified(rows, ["s"], 50).groupBy("s").count().collect()}
    assert got == {"common": 49, "rare": 1, "one": 1}


def test_originals_go_after_the_table_names_their_copies(spark, catalog, tmp_path):
    for n in ("a.wav", "a.flac", "b.wav", "c.wav", "c.flac"):
        (tmp_path / n).write_text(n)
    catalog.upsert("raw_files", spark.createDataFrame([(k, f"file://{tmp_path}/{k}.wav") for k in "abc"], "raw_id string, wav_path string"))
    jobs.transcode_copies(catalog, spark.createDataFrame([("a", f"file://{tmp_path}/a.flac", 1.0, True), ("b", f"file://{tmp_path}/b.flac", 1.0, True), ("c", f"file://{tmp_path}/c.flac", 1.0, False)], "raw_id string, flac_path string, duration_sec double, verified boolean"))
    assert jobs.delete_verified(catalog) == 1 and jobs.delete_verified(catalog) == 0
    assert not (tmp_path / "a.wav").exists() and (tmp_path / "b.wav").exists() and (tmp_path / "c.wav").exists()
    assert {r["raw_id"]: r["wav_path"].rsplit("/", 1)[-1] for r in catalog.read("raw_files").collect()} == {"a": "a.flac", "b": "b.wav", "c": "c.wav"}


def test_logs_are_pruned(tmp_path):
    for name, days in (("new.log", 1), ("old.log", 10), ("oldest.log", 90), ("x.gz", 90), ("keep.txt", 90)):
        (tmp_path / name).write_text(name)
        os.utime(tmp_path / name, (time.time() - days * 86400,) * 2)
    assert jobs.prune_logs(str(tmp_path)) == {"gzipped": 1, "deleted": 2}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["keep.txt", "new.log", "old.log.gz"]
    assert gzip.open(tmp_path / "old.log.gz", "rt").read() == "old.log"


def test_imports_and_staged_rows(spark, catalog, tmp_path):
    (tmp_path / "lists").mkdir()
    (tmp_path / "lists/rthk.yaml").write_text("- {url: 'http://a', name: A}\n")
    assert jobs.import_sources(catalog, f"file://{tmp_path}/lists") == 1
    (tmp_path / "tiers.jsonl").write_text('{"id":"n1","tier":"gold"}\n{"id":"n1","tier":"silver"}\n{"tier":"x"}\n')
    assert jobs.import_jsonl(catalog, "tiers", f"file://{tmp_path}/tiers.jsonl") == 1
    (tmp_path / "staged").mkdir()
    (tmp_path / "staged/1.json").write_text('{"raw_id":"r1","wav_path":"/x"}\n')
    assert jobs.ingest_commit(catalog, f"file://{tmp_path}/staged", f"file://{tmp_path}/point") == 1
    left = [True, False]

    def alive():
        (tmp_path / f"staged/{len(left) + 1}.json").write_text(json.dumps({"raw_id": f"q{len(left)}"}))
        return left.pop(0)

    assert drain_while(spark, f"file://{tmp_path}/staged", catalog.schema("raw_files"), catalog, "raw_files", f"file://{tmp_path}/point", alive, seconds=0.1) == 2
    assert catalog.read("raw_files").count() == 3


def test_command_line(spark, catalog, tmp_path, capsys):
    run = lambda *a: (cli.main(["--catalog", catalog.root, *a]), json.loads(capsys.readouterr().out.strip().splitlines()[-1]))
    assert run("verify")[1] == {"wrong": []}
    assert run("verify", "--floor", "segments=100")[0] == 1
    assert run("export", "--out", f"file://{tmp_path}/o", "--min-tier", "auto_gold")[1]["entries"] == 6
    assert run("report", "--out", f"file://{tmp_path}/o")[1]["checks"] == 11
    assert run("calibrate", "sample", "--n", "3")[1]["queued"] == 3
    assert run("calibrate", "stats")[1] == {"pending": 3}
    assert run("label-calibrate", "--out", f"file://{tmp_path}/l")[1]["n"] == 10
    assert run("label-store", "--out", f"file://{tmp_path}/l", "--calibration", f"file://{tmp_path}/l")[1]["lines"] == 8
    assert "tier.assign" in [r["node"] for r in run("chain", "--dry-run")[1]]
