import pytest

from corvane.llm.common import new_dir
from corvane.llm.sharding import Conflict, Shards, shard_table


def test_versions_tiers_and_vacuum(spark, docs):
    t = Shards(spark, new_dir(spark, "t"), target_bytes=1 << 20)
    assert t.version() == 0 and t.compact() == 0
    with pytest.raises(ValueError):
        t.read()
    for k in range(3):
        t.append(docs([(k * 10 + i, f"text {i}") for i in range(10)]).repartition(2))
    assert t.version() == 3
    before = sorted(r["doc_id"] for r in t.read().collect())
    t.compact()
    assert sorted(r["doc_id"] for r in t.read().collect()) == before == list(range(30))
    assert len(t.manifest()["shards"]) == 1
    assert sorted(r["doc_id"] for r in t.read(1).collect()) == list(range(10))  # an older version, until it is vacuumed
    assert t.vacuum() == 0 and t.read(1).count() == 10
    assert t.vacuum(grace_seconds=-1) == 3 and t.read().count() == 30
    assert t.plan(t.manifest()["shards"]) == []


def test_a_version_is_committed_once(spark, docs):
    t = Shards(spark, new_dir(spark, "t"))
    t.append(docs([(1, "a")]))
    with pytest.raises(Conflict):
        t._commit(1, None, [])
    assert t.version() == 1 and t.read().count() == 1


def test_one_of_two_writers_at_once_commits(spark):
    from concurrent.futures import ThreadPoolExecutor

    path = new_dir(spark, "t")

    def commit(k):
        try:
            Shards(spark, path)._commit(v, None, [{"file": f"data/{k}/x", "bytes": 1}])
            return k
        except Conflict:
            return None

    for v in range(1, 11):
        with ThreadPoolExecutor(4) as pool:
            won = [k for k in pool.map(commit, range(4)) if k is not None]
        assert len(won) == 1
        assert Shards(spark, path).manifest(v)["shards"][0]["file"] == f"data/{won[0]}/x"


def test_vacuum_spares_what_a_writer_has_yet_to_commit(spark, docs):
    path = new_dir(spark, "t")
    a, b = Shards(spark, path), Shards(spark, path)
    a.append(docs([(1, "a")]))
    written = a._write(docs([(2, "b")]), "arrival")
    m = a.manifest()
    assert b.vacuum() == 0
    a._commit(2, m["schema"], m["shards"] + written)
    assert sorted(r["doc_id"] for r in b.read().collect()) == [1, 2]


def test_another_schema_is_refused(spark, docs):
    t = Shards(spark, new_dir(spark, "t"))
    t.append(docs([(1, "a")]))
    with pytest.raises(ValueError):
        t.append(spark.range(3))
    t.append(docs([(2, "b")]).select("text", "doc_id", "n_chars", "lang", "source", "_id", "spans", "raw"))
    assert sorted((r["doc_id"], r["text"]) for r in t.read().collect()) == [(1, "a"), (2, "b")]


def test_odd_column_names_and_types(spark):
    df = spark.sql("select 1 as `a.b`, map('k', 2) as `m``m`, 'mine' as shard union all select null, null, null")
    got = shard_table(df, new_dir(spark, "s"))
    assert got.columns == ["a.b", "m`m", "shard", "_shard"]
    assert sorted(str(r["shard"]) for r in got.collect()) == ["None", "mine"]


def test_tiers_of_similar_sizes_only(spark):
    t = Shards(spark, new_dir(spark, "t"), target_bytes=1 << 30)
    shards = [{"file": str(i), "bytes": b} for i, b in enumerate([100] * 4 + [1 << 20] * 3 + [1 << 29] * 5)]
    assert [[s["bytes"] for s in run] for run in t.plan(shards)] == [[100] * 4]


def test_shard_table_keeps_rows(spark, docs):
    rows = [(1, None), (None, ""), (2, "x" * 200_000), (3, "a"), (3, "a")]
    got = shard_table(docs(rows), new_dir(spark, "s")).drop("shard")
    assert sorted(map(str, got.collect())) == sorted(map(str, docs(rows).collect()))
    assert shard_table(docs([]), new_dir(spark, "s")).collect() == []
