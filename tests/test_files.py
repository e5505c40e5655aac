import json

from corvane.sources import files as S


def test_jsonl_omits_nulls_and_keeps_order(spark, tmp_path):
    df = spark.createDataFrame([("b", "係", None), ("a", None, 1.5)], "id string, text string, x double")
    S.write_jsonl(df, f"file://{tmp_path}/out")
    lines = [line for f in sorted((tmp_path / "out").glob("part-*")) for line in f.read_text(encoding="utf-8").splitlines()]
    assert lines == ['{"id":"a","x":1.5}', '{"id":"b","text":"係"}']
    assert S.read_jsonl(spark, f"file://{tmp_path}/out", df.schema).count() == 2


def test_names_of_cuts():
    assert S.export_name("manifest") == "manifest"
    assert S.export_name("manifest", "silver", "B", "only", 0.9) == "manifest_silver_qualityB_cs_only_agree090"


def test_export_keeps_sides(spark, tmp_path):
    rows = spark.createDataFrame([(f"{i:02d}", "s", f"p{i % 4}") for i in range(12)], "id string, source string, speaker_id string")
    S.export_manifest(rows, f"file://{tmp_path}/one")
    ids = lambda k, side: {r["id"] for r in spark.read.json(f"file://{tmp_path}/{k}/{side}").collect()}
    assert ids("one", "train") | ids("one", "val") == ids("one", "manifest") == {f"{i:02d}" for i in range(12)}
    assert ids("one", "val") == {"03", "07", "11"}
    more = rows.union(spark.createDataFrame([("12", "s", "p3"), ("13", "s", "p9")], rows.schema))
    S.export_manifest(more, f"file://{tmp_path}/two", *(spark.read.json(f"file://{tmp_path}/one/{k}") for k in ("train", "val")))
    assert ids("one", "train") <= ids("two", "train") and ids("one", "val") <= ids("two", "val")


def test_constants(spark, tmp_path):
    S.write_constants(spark.createDataFrame([(1.0, 2.0)], "p25 double, p75 double"), f"file://{tmp_path}/c.json", "v1")
    assert json.loads((tmp_path / "c.json").read_text()) == {"version": "v1", "p25": 1.0, "p75": 2.0}
