import pytest
from pyspark.sql import functions as F

from corvane import dag, nodes  # noqa: F401
from corvane.sources.catalog import TABLES, Catalog

@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    c = Catalog(spark, f"file://{tmp_path_factory.mktemp('catalog')}", TABLES)
    c.ensure()
    text = "我哋今日去邊度食飯，好唔好呢"
    c.upsert("segments", spark.createDataFrame([("a", 5.0, 48000), ("b", 5.0, 48000), ("c", 1.0, 48000)], "id string, duration_sec double, sample_rate int"))
    c.upsert("asr_results", spark.createDataFrame([(i, m, text, 0.9) for i in "abc" for m in ("x", "y")], "id string, model string, text string, confidence double"))
    c.upsert("filters_acoustic", spark.createDataFrame([("a", 40.0, 3.9, 3.9, True)], "id string, snr_db double, dnsmos_sig double, dnsmos_ovrl double, pass boolean"))
    c.upsert("labels_music", spark.createDataFrame([("a", 0.0)], "id string, music_prob double"))
    c.upsert("labels_overlap", spark.createDataFrame([("a", 0.0)], "id string, overlap_ratio double"))
    return c


def test_rounds():
    order = [n for r in dag.rounds() for n in r]
    assert order.index("asr.agreement") < order.index("filter.text") < order.index("filter.decide") < order.index("tier.assign") < order.index("quality_tier.assign")


def test_chain_converges_and_late_rows_are_due(spark, catalog):
    rows = {r["node"]: r["rows"] for r in dag.run_chain(catalog)}
    assert {n: k for n, k in rows.items() if k} == {"asr.agreement": 3, "filter.text": 3, "filter.acoustic": 1, "filter.decide": 3, "tier.assign": 3, "quality_tier.assign": 1, "g2p": 1}
    assert {(r["id"], r["tier"]) for r in catalog.read("tiers").collect()} == {("a", "auto_gold"), ("b", "silver"), ("c", "silver")}
    assert catalog.read("quality_tiers").first()["quality_tier"] == "B"
    assert catalog.read("task_runs").count() == 15
    assert all(r["rows"] == 0 for r in dag.run_chain(catalog))
    catalog.upsert("filters_acoustic", spark.createDataFrame([("b", 10.0, 3.9, 3.9, False, "snr")], "id string, snr_db double, dnsmos_sig double, dnsmos_ovrl double, pass boolean, fail_reason string"))
    catalog.upsert("labels_lang", spark.createDataFrame([("a", "cmn", 0.9, 0.9)], "id string, lang string, lang_prob double, cmn_prob double"))
    assert dag.run_node(catalog, "filter.decide")["rows"] >= 1
    assert {(r["id"], r["fail_reason"]) for r in catalog.read("filters").collect()} >= {("a", "mandarin_audio"), ("c", "duration")}
    chars = [(c, i * 0.3, i * 0.3 + 0.2) for i, c in enumerate("我哋今日去邊度食飯好唔好呢")]
    catalog.upsert("alignments", spark.createDataFrame([("a", chars)], f"id string, {TABLES['alignments'].schema.split(', ', 1)[1].split(', model')[0]}"))
    assert [r["rows"] for r in dag.run_many(catalog, ["pause.plan", "tier.assign"])] == [1, 0]
    assert catalog.read("pause_plan").select(F.size("plan")).first()[0] == 1


def test_dry_run_and_limits(catalog):
    assert [r["node"] for r in dag.run_chain(catalog, only=["tier.assign"], dry_run=True)] == ["tier.assign"]
    assert dag.run_node(catalog, "tier.assign", limit=1)["rows"] == 0


def test_nodes_that_wait_for_each_other():
    node = lambda w, r: dag.Node(w, (r,), None, None)
    with pytest.raises(ValueError):
        dag.rounds({"a": node("x", "y"), "b": node("y", "x")})


def test_many_are_journaled(spark, catalog):
    catalog.upsert("asr_results", spark.createDataFrame([("d", m, "我哋", 0.9) for m in ("x", "y")], "id string, model string, text string, confidence double"))
    before = catalog.read("task_runs").count()
    ran = {r["node"]: r for r in dag.run_many(catalog, ["asr.agreement", "tier.assign"])}
    assert ran["asr.agreement"]["rows"] == 1
    rows = [(r["run_id"], r["node"], r["item_id"]) for r in catalog.read("task_runs").collect()]
    assert len(rows) == before + sum(r["rows"] for r in ran.values())
    assert (ran["asr.agreement"]["run_id"], "asr.agreement", "d") in rows
