import pytest
from pyspark.sql import functions as F

from corvane.operators.discover import discover
from corvane.sources.catalog import TABLES, Catalog, dedup_last, upsert


@pytest.fixture()
def catalog(spark, tmp_path):
    few = {k: TABLES[k] for k in ("segments", "tiers", "task_runs", "asr_results")}
    c = Catalog(spark, f"file://{tmp_path}/catalog", few)
    c.ensure()
    return c


def test_all_tables_have_keys(spark):
    assert len(TABLES) == 33
    c = Catalog(spark, "/nowhere")
    for name, t in TABLES.items():
        assert set(t.keys) <= set(c.schema(name).names)


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Catalog(spark, f"file://{tmp_path}/none").read("tiers")


def test_upsert_replaces_and_nulls_what_is_not_given(spark, catalog):
    assert catalog.upsert("tiers", spark.createDataFrame([("a", "gold", "x", 2), ("b", "silver", "x", 2)], "id string, tier string, provenance string, asr_model_count int")) == 2
    assert catalog.upsert("tiers", spark.createDataFrame([("b", "bronze"), ("c", None)], "id string, tier string")) == 2
    assert {tuple(r) for r in catalog.read("tiers").collect()} == {("a", "gold", "x", 2), ("b", "bronze", None, None), ("c", None, None, None)}
    assert catalog.upsert("tiers", spark.createDataFrame([], "id string, tier string")) == 0
    with pytest.raises(ValueError):
        catalog.upsert("tiers", spark.createDataFrame([("a", "x"), ("a", "y")], "id string, tier string"))
    assert catalog.verify() == ["tiers: more rows than segments"]


@pytest.mark.parametrize("n", [1999, 2000])
def test_upsert_sizes(spark, n):
    rows = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("n"))
    out = upsert(rows, rows.where("n = 1").withColumn("n", F.lit(2)), ["id"])
    assert out.count() == n and out.where("n = 2").count() == n


def test_a_new_version_does_not_disturb_a_reader(spark, catalog):
    row = lambda k: spark.createDataFrame([(k, "gold")], "id string, tier string")
    catalog.upsert("tiers", row("a"))
    reader = catalog.read("tiers")
    catalog.upsert("tiers", row("b"))
    assert reader.count() == 1 and catalog.read("tiers").count() == 2


def test_journal(spark, catalog):
    catalog.journal("run1", "tier", spark.createDataFrame([("a",), ("b",)], "id string"))
    assert {r["item_id"] for r in catalog.read("task_runs").collect()} == {"a", "b"}


def test_dedup_last(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", None, "z"), ("b", None, "w")], "k string, seq int, v string")
    assert {tuple(r) for r in dedup_last(rows, ["k"], "seq").collect()} == {("a", 2, "y"), ("b", None, "w")}


def test_discovery_converges(spark):
    eligible = spark.createDataFrame([("a", 2), ("b", 3), ("c", None), (None, 1)], "id string, n int")
    done = spark.createDataFrame([("a", 2, "me"), ("b", 2, "me"), ("c", None, "human"), (None, 1, "me")], "id string, v int, provenance string")
    due = lambda **k: sorted(str(r["id"]) for r in discover(eligible, done, **k).collect())
    assert due() == ["None"]  # a null key is never done
    assert due(provenance=("me",)) == ["None", "c"]
    assert due(stale=("n", "v")) == ["None", "b"]
    assert due(stale=("n", "v"), protected=("me",)) == ["None"]
    assert discover(eligible.where("id is not null"), eligible).count() == 0


def test_data_without_a_version_is_not_emptied(spark, catalog, tmp_path):
    catalog.upsert("tiers", spark.createDataFrame([("a", "gold")], "id string, tier string"))
    for f in (tmp_path / "catalog/tiers").glob("*current-*"):
        f.unlink()
    with pytest.raises(ValueError):
        catalog.ensure()


def test_a_write_that_dies_leaves_the_last_version(spark, catalog):
    catalog.upsert("tiers", spark.createDataFrame([("a", "gold")], "id string, tier string"))
    bad = spark.createDataFrame([("b", "x")], "id string, tier string").withColumn("tier", F.raise_error(F.lit("dies")))
    with pytest.raises(Exception, match="dies"):
        catalog.overwrite("tiers", bad)
    assert [r["id"] for r in catalog.read("tiers").collect()] == ["a"]


def test_one_of_two_writers_commits(spark, catalog):
    v = catalog.version("tiers")
    catalog._commit("tiers", v + 1, {"buckets": 1, "parts": []})
    with pytest.raises(Exception, match="[Ee]xists"):
        catalog._commit("tiers", v + 1, {"buckets": 1, "parts": []})


def test_the_journal_is_appended(spark, catalog, monkeypatch):
    monkeypatch.setattr("corvane.sources.catalog.MOST_APPENDS", 3)
    for k in range(6):
        catalog.journal(f"run{k}", "tier", spark.createDataFrame([(f"{k}-{i}",) for i in range(2)], "id string"), status="ok" if k else "error", error=None if k else "no disk")
    assert catalog.read("task_runs").count() == 12
    assert len(catalog.parts("task_runs")["parts"]) <= 4
    assert [tuple(r) for r in catalog.last_run("run0").collect()] == [("error", 2)]


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, catalog, monkeypatch):
    monkeypatch.setattr("corvane.sources.catalog.BUCKET_ROWS", 10)
    rows = spark.range(100).select(F.concat(F.lit("s"), "id").alias("id"), F.lit("gold").alias("tier"))
    assert catalog.upsert("tiers", rows) == 100
    before = catalog.parts("tiers")
    assert before["buckets"] == 16
    assert catalog.upsert("tiers", spark.createDataFrame([("s7", "silver")], "id string, tier string")) == 1
    after = catalog.parts("tiers")
    assert len([x for x in after["parts"] if x not in before["parts"]]) == 1
    got = {r["id"]: r["tier"] for r in catalog.read("tiers").collect()}
    assert len(got) == 100 and got["s7"] == "silver" and got["s8"] == "gold"
    assert catalog.upsert("tiers", spark.createDataFrame([("new", "bronze")], "id string, tier string")) == 1
    assert catalog.read("tiers").count() == 101


def test_verify_floors_and_paths(spark, catalog, tmp_path):
    there = tmp_path / "a.flac"
    there.write_text("x")
    catalog.upsert("segments", spark.createDataFrame([("a", f"file://{there}"), ("b", f"file://{tmp_path}/gone.flac")], "id string, audio_path string"))
    found = catalog.verify(floors={"segments": 3, "tiers": 0}, paths=10)
    assert len(found) == 2 and "3 expected" in found[0] and "1 of 2" in found[1]
