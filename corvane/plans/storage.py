"""Queries of writes, storage and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corvane.operators import storage as S
from corvane.operators.review import drawn
from corvane.plans.fixtures import fx, load, with_fx
from corvane.plans.registry import query
from corvane.sources.catalog import TABLES, Catalog, dedup_last, upsert
from corvane.sources.files import read_jsonl, write_jsonl
from corvane.streaming.staging import folder


def _catalog(spark, *tables: str) -> Catalog:
    """An empty catalog of these tables in the shared folder."""
    c = Catalog(spark, folder(spark), {t: TABLES[t] for t in tables})
    c.ensure()
    return c


@query("upsert_merge", "select o_orderkey k, o_totalprice price from orders where o_orderkey % 3 <> 0 union all select o_orderkey, 1e0 from orders where o_orderkey % 3 = 0")
def upsert_merge(spark, d):
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"))
    return upsert(o, o.where("k % 3 = 0").withColumn("price", F.lit(1.0)), ["k"])


@query("upsert_partial", "select o_orderkey k, case when o_orderkey % 3 <> 0 then o_custkey end c, 7::bigint n from orders")
def upsert_partial(spark, d):
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.lit(7).cast("long").alias("n"))
    return upsert(o, o.where("k % 3 = 0").select("k", "n"), ["k"])


@query("dedup_last", "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by event_id desc) k from events) where k = 1")
def dedup_last_(spark, d):
    return dedup_last(load(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("dedup_row_number", "select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderkey % 2 = 0 desc, o_orderkey) k from orders) where k = 1")
def dedup_row_number(spark, d):
    w = Window.partitionBy("o_custkey").orderBy((F.col("o_orderkey") % 2 == 0).desc(), "o_orderkey")
    return load(spark, d, "orders").withColumn("k", F.row_number().over(w)).where("k = 1").select("o_custkey", "o_orderkey")


@query("update_by_key", with_fx("select t.id, coalesce(r.decision, t.tier) tier from fx_tiers_old t left join fx_review r on t.id = r.id"))
def update_by_key(spark, d):
    return S.update_by_key(fx(spark, d, "fx_tiers_old"), fx(spark, d, "fx_review").select("id", F.col("decision").alias("tier")), "id", "tier").select("id", "tier")


@query("remap_model_key", with_fx("select id, 'beta' model, coalesce(b, a) text from (select id, max(case when model = 'alpha' then text end) a, max(case when model = 'beta' then text end) b from fx_asr_results where model in ('alpha', 'beta') group by id)"))
def remap_model_key(spark, d):
    return S.remap_key(fx(spark, d, "fx_asr_results").where("model in ('alpha', 'beta')"), {"alpha": "beta"}).select("id", "model", "text")


@query("journal_append", with_fx("select run_id, node, status, count(*) n from fx_task_runs group by all"))
def journal_append(spark, d):
    """The journal of a catalog after a run of each status has been appended to it."""
    c = _catalog(spark, "task_runs")
    rows = fx(spark, d, "fx_task_runs")
    for status in ("ok", "error", "skipped"):
        c.append("task_runs", rows.where(F.col("status") == status))
    return c.read("task_runs").groupBy("run_id", "node", "status").agg(F.count("*").alias("n"))


@query("run_summary", with_fx("select run_id, count(*) filter (where status = 'ok') ok, count(*) filter (where status = 'error') failed, string_agg(distinct node, ',' order by node) nodes from fx_task_runs group by run_id"))
def run_summary(spark, d):
    r = fx(spark, d, "fx_task_runs").groupBy("run_id")
    return r.agg(F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "error").alias("failed"), F.array_join(F.sort_array(F.collect_set("node")), ",").alias("nodes"))


@query("verify_copy", "select doc_id, doc_id % 5 <> 0 verified from documents")
def verify_copy(spark, d):
    docs = load(spark, d, "documents").select("doc_id", F.encode("text", "UTF-8").alias("a"))
    copy = docs.select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.lit(b"other")).otherwise(F.col("a")).alias("b"))
    return S.verify_copies(docs, copy, "doc_id", "a", "b")


BUDGET = "select o_orderkey, coalesce(sum(o_totalprice) over (partition by o_custkey order by o_orderkey rows between unbounded preceding and 1 preceding), 0) before_ from orders"


@query("cap_by_size", f"select o_orderkey from ({BUDGET}) where before_ < 300000")
def cap_by_size(spark, d):
    return S.cap_by_size(load(spark, d, "orders"), ["o_custkey"], ["o_orderkey"], "o_totalprice", 300000).select("o_orderkey")


@query("lru_evict", "select o_orderkey from (select o_orderkey, sum(o_totalprice) over (partition by o_custkey order by o_orderdate desc, o_orderkey desc rows between unbounded preceding and current row) kept from orders) where kept > 500000")
def lru_evict(spark, d):
    return S.evict_lru(load(spark, d, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey", "o_totalprice", 500000).select("o_orderkey")


@query("round_robin", with_fx("select id, (row_number() over (order by duration_sec, id) - 1) % 4 device from fx_segments"))
def round_robin(spark, d):
    return S.round_robin(fx(spark, d, "fx_segments"), ["duration_sec", "id"], 4).select("id", "device")


@query("active_entries", "select page_id from pages where case page_id % 5 when 0 then 'skip' when 1 then 'done' else 'new' end not in ('skip', 'done', 'paused') and case when page_id % 7 = 0 then 'skip' else 'high' end <> 'skip' and not regexp_matches(case when page_id % 11 = 0 then 'PLACEHOLDER' else url end, '^(PLACEHOLDER|SKIP|SEARCH)')")
def active_entries(spark, d):
    p = load(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 5 == 0, "skip").when(F.col("page_id") % 5 == 1, "done").otherwise("new").alias("status"), F.when(F.col("page_id") % 7 == 0, "skip").otherwise("high").alias("priority"), F.when(F.col("page_id") % 11 == 0, "PLACEHOLDER").otherwise(F.col("url")).alias("url"))
    return S.active_entries(p).select("page_id")


@query("rss_select", "select page_id, substr(md5(url), 1, 8) rid from (select *, row_number() over (partition by page_id % 20 order by page_id desc) k from pages where page_id % 3 = 0) where k <= 5")
def rss_select(spark, d):
    w = Window.partitionBy(F.col("page_id") % 20).orderBy(F.desc("page_id"))
    p = load(spark, d, "pages").where("page_id % 3 = 0").withColumn("k", F.row_number().over(w)).where("k <= 5")
    return p.select("page_id", F.substring(F.md5(F.col("url").cast("binary")), 1, 8).alias("rid"))


@query("manifest_fanout", "select 'documents' part, count(*) n from documents union all select 'labels', count(*) from documents where lang is not null union all select 'candidates', 2 * count(*) from documents")
def manifest_fanout(spark, d):
    docs = load(spark, d, "documents")
    made = S.fan_out(docs, {"documents": [F.lit(True)], "labels": [F.col("lang").isNotNull()], "candidates": [F.lit(True), F.lit(True)]})
    return made.groupBy("part").agg(F.count("*").alias("n"))


@query("explode_candidates", with_fx("select id, model, text from fx_asr_results"))
def explode_candidates(spark, d):
    from corvane.functions.agreement import grouped

    return grouped(fx(spark, d, "fx_asr_results")).select("id", F.inline("candidates")).select("id", "model", "text")


@query("orphan_rows", with_fx("select id, 'segment' kind from fx_tiers_old where tier = 'bronze' union all select id, 'result' from fx_asr_results where id in (select id from fx_tiers_old where tier = 'bronze')"))
def orphan_rows(spark, d):
    bad = fx(spark, d, "fx_tiers_old").where("tier = 'bronze'").select("id")
    return bad.withColumn("kind", F.lit("segment")).unionByName(fx(spark, d, "fx_asr_results").join(bad, "id", "left_semi").select("id", F.lit("result").alias("kind")))


@query("staging_commit", "select event_id id, user_id from events")
def staging_commit(spark, d):
    from corvane.streaming.staging import commit_staged

    e = load(spark, d, "events").select(F.col("event_id").alias("id"), "user_id")
    return commit_staged(spark, e, keys=["id"])


@query("json_scan", "select doc_id, lang, md5(text) text_md5 from documents")
def json_scan(spark, d):
    """Files of JSON lines, written and scanned."""
    at = folder(spark)
    write_jsonl(load(spark, d, "documents").select("doc_id", "lang", "text"), at, "doc_id")
    return read_jsonl(spark, at, "doc_id bigint, lang string, text string").select("doc_id", "lang", F.md5("text").alias("text_md5"))


@query("scan_catalog", "select o_orderkey id, cast(o_custkey as varchar) owner from orders")
def scan_catalog(spark, d):
    """A table of a catalog, in a version with buckets and an appended part."""
    c = _catalog(spark, "verified")
    rows = load(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("verified_by"))
    c.overwrite("verified", rows.where("cast(id as bigint) % 5 <> 0"), buckets=4)
    c.append("verified", rows.where("cast(id as bigint) % 5 = 0"))
    return c.read("verified").select(F.col("id").cast("long").alias("id"), F.col("verified_by").alias("owner"))


@query("sample_rows", "select doc_id, lang from documents order by md5(doc_id || '/7'), doc_id limit 50")
def sample_rows(spark, d):
    return load(spark, d, "documents").select("doc_id", "lang").orderBy(drawn("doc_id", 7), "doc_id").limit(50)


@query("row_counts", "select 'documents' t, count(*) n from documents union all select 'labels', count(*) from labels union all select 'events', count(*) from events")
def row_counts(spark, d):
    one = lambda t: load(spark, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("t"), "n")
    return one("documents").union(one("labels")).union(one("events"))


@query("verify_floors", "select 'segments: ' || n || ' rows repeat a key' what from (select count(*) - count(distinct user_id) n from events) union all select 'tiers: more rows than segments' from (select count(*) n from documents) where n > (select count(*) from events) union all select 'tiers: ' || n || ' rows, 1000000 expected at least' from (select count(*) n from documents)")
def verify_floors(spark, d):
    """What a catalog's check finds in tables with repeated keys and too few rows."""
    c = _catalog(spark, "segments", "tiers")
    c.overwrite("segments", load(spark, d, "events").select(F.concat(F.lit("s"), "user_id").alias("id")))
    c.overwrite("tiers", load(spark, d, "documents").select(F.concat(F.lit("s"), "doc_id").alias("id"), F.lit("gold").alias("tier")))
    return spark.createDataFrame([(x,) for x in c.verify({"tiers": 1_000_000})], "what string")
