"""Queries of gates and tiers, and the flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.operators import gates as G
from corvane.plans.fixtures import fx, load, with_fx
from corvane.plans.registry import query
from corvane.plans.texts import CONFIDENCE, FEATURES, LANGUAGE, MANDARIN

SRC = "select s.id, s.duration_sec, s.sample_rate, coalesce(a.best_text, '') t, a.model_count from fx_segments s join fx_agreement a on s.id = a.id"
TEXT = f"select id, cast(eng as double) english_ratio, cast({MANDARIN} as double) mandarin_ratio, case when trim(t) = '' then 'eng' else {LANGUAGE} end detected_language, cast(case when trim(t) = '' then 0 else {CONFIDENCE} end as double) language_confidence, fail_reason is null pass, fail_reason, model_count asr_model_count from (select *, case when sample_rate is distinct from 48000 then 'sample_rate' when not coalesce(duration_sec, 0) between 3 and 20 then 'duration' when cjk < 5 then 'text_too_short' when length(t) > 150 then 'text_too_long' when eng > 0.3 then 'english_ratio' when {MANDARIN} > 0.15 then 'mandarin_ratio' end fail_reason from ft)"
ACOUSTIC = "select *, fail_reason is null pass from (select id, snr_db, dnsmos_sig, dnsmos_ovrl, case when snr_db < 25 then 'snr' when dnsmos_sig < 3 then 'dnsmos' end fail_reason from fx_acoustic)"
DECIDED = "select id, dnsmos_sig dnsmos, fail_reason is null pass, fail_reason, asr_model_count text_model_count, english_ratio, snr_db, there lang_label_checked from (select t.id, t.asr_model_count, t.english_ratio, a.dnsmos_sig, a.snr_db, g.id is not null there, case when not t.pass then t.fail_reason when a.id is null then 'acoustic_pending' when not a.pass then a.fail_reason when g.lang = 'cmn' and g.cmn_prob >= 0.8 then 'mandarin_audio' when g.lang = 'eng' and g.lang_prob >= 0.8 then 'english_audio' when g.lang not in ('', 'yue', 'cmn', 'eng') and g.lang_prob >= 0.8 then 'other_language_audio' end fail_reason from gt t left join ga a on t.id = a.id left join fx_labels_lang g on t.id = g.id)"
TIER = "case when text_verified then 'gold' when agreement >= 0.92 and coalesce(dnsmos, 0) >= 3.5 then 'auto_gold' when agreement >= 0.85 then 'silver' when agreement >= 0.7 then 'bronze' else 'excluded' end"
TIERED = f"select a.id, {TIER} tier, a.model_count asr_model_count from fx_agreement a left join gd d on a.id = d.id"
CTES = {"src": SRC, "ft": FEATURES, "gt": TEXT, "ga": ACOUSTIC, "gd": DECIDED, "gtier": TIERED}


def text_rows(spark, d):
    return G.filter_text(fx(spark, d, "fx_segments").join(fx(spark, d, "fx_agreement"), "id"))


def acoustic_rows(spark, d):
    return G.filter_acoustic(fx(spark, d, "fx_acoustic"))


def decided_rows(spark, d):
    return G.filter_decide(text_rows(spark, d), acoustic_rows(spark, d), fx(spark, d, "fx_labels_lang"))


def tier_rows(spark, d):
    """Tiers need of the decisions only which ids have one, and their scores: the text gate itself is not run for them."""
    known = fx(spark, d, "fx_segments").select("id").join(acoustic_rows(spark, d).select("id", F.col("dnsmos_sig").alias("dnsmos")), "id")
    rows = fx(spark, d, "fx_agreement").join(known, "id", "left")
    return rows.select("id", G.tier().alias("tier"), F.col("model_count").alias("asr_model_count"))


@query("filter_text", with_fx("select * from gt", **CTES))
def filter_text(spark, d):
    return text_rows(spark, d)


@query("filter_acoustic", with_fx("select id, fail_reason, pass from ga", **CTES))
def filter_acoustic(spark, d):
    return acoustic_rows(spark, d).select("id", "fail_reason", "pass")


@query("pregate", with_fx("select id, fail_reason is null pass, fail_reason from (select id, case when snr_db < 20 then 'snr' when dnsmos_ovrl < 2.5 then 'dnsmos' end fail_reason from fx_acoustic)"))
def pregate(spark, d):
    return G.pregate(fx(spark, d, "fx_acoustic"))


@query("filter_decide", with_fx("select id, pass, fail_reason, dnsmos, text_model_count, lang_label_checked from gd", **CTES))
def filter_decide(spark, d):
    return decided_rows(spark, d).select("id", "pass", "fail_reason", "dnsmos", "text_model_count", "lang_label_checked")


@query("tier_assign", with_fx("select * from gtier", **CTES))
def tier_assign(spark, d):
    return tier_rows(spark, d)


@query("quality_tier", with_fx("select a.id, case when a.dnsmos_sig >= 3.7 and m.music_prob < 0.1 and o.overlap_ratio < 0.05 then 'B' else 'A' end quality_tier from fx_acoustic a left join fx_labels_music m on a.id = m.id left join fx_labels_overlap o on a.id = o.id"))
def quality_tier(spark, d):
    rows = fx(spark, d, "fx_acoustic").withColumnRenamed("dnsmos_sig", "dnsmos").join(fx(spark, d, "fx_labels_music"), "id", "left").join(fx(spark, d, "fx_labels_overlap"), "id", "left")
    return rows.select("id", G.quality_tier().alias("quality_tier"))


SCREEN = "select user_id raw_id, case event_type when 'view' then 'yue' when 'click' then 'yue' when 'purchase' then 'cmn' else 'eng' end lang from events"


@query("lang_screen", f"select *, case when cantonese_ratio_raw >= 0.7 and mandarin_ratio_raw <= 0.2 then 'pass' when mandarin_ratio_raw > 0.5 or cantonese_ratio_raw < 0.4 then 'reject' else 'mixed' end decision from (select raw_id, round(avg(case when lang = 'yue' then 1e0 else 0 end), 4) cantonese_ratio_raw, round(avg(case when lang = 'cmn' then 1e0 else 0 end), 4) mandarin_ratio_raw, count(*) n_windows from ({SCREEN}) group by raw_id)")
def lang_screen(spark, d):
    lang = F.when(F.col("event_type").isin("view", "click"), "yue").when(F.col("event_type") == "purchase", "cmn").otherwise("eng")
    return G.screen_languages(load(spark, d, "events").select(F.col("user_id").alias("raw_id"), lang.alias("lang")))


ORPHANS = "select a.id, case when p.num % 3 = 0 then null else p.num % 3 = 1 end gate_pass, case when p.num % 2 = 0 then 'snr' end gate_reason, case when p.num % 5 <> 0 then a.agreement end agreement from fx_agreement a join fx_segments p on a.id = p.id"


@query("orphan_classify", with_fx("select id, case when gate_pass then 'recover' when not gate_pass then 'pregate_fail_' || coalesce(gate_reason, 'unknown') when agreement >= 0.8 then 'recover' when agreement is not null then 'low_agreement' else 'no_signal' end bucket from orphans", orphans=ORPHANS))
def orphan_classify(spark, d):
    rows = spark.sql(ORPHANS.replace("fx_agreement", "{a}", 1).replace("fx_segments", "{p}", 1).replace("{a} a", "{fa} a").replace("{p} p", "{fp} p"), fa=fx(spark, d, "fx_agreement"), fp=fx(spark, d, "fx_segments"))
    return G.classify_orphans(rows).select("id", "bucket")


@query("threshold_sweep", with_fx("select cut, count(*) n, sum(case when a.agreement >= cut then 1 else 0 end)::bigint cleared, sum(case when a.agreement >= cut then s.duration_sec else 0 end) as seconds from fx_agreement a join fx_segments s on a.id = s.id cross join (values (0.7e0), (0.8e0), (0.85e0), (0.92e0)) c(cut) group by cut"))
def threshold_sweep(spark, d):
    cuts = spark.createDataFrame([(0.7,), (0.8,), (0.85,), (0.92,)], "cut double")
    rows = fx(spark, d, "fx_agreement").join(fx(spark, d, "fx_segments").select("id", "duration_sec"), "id").groupBy("agreement").agg(F.count("*").alias("n"), F.sum("duration_sec").alias("s"))
    cleared = F.col("agreement") >= F.col("cut")  # of a hundred values of agreement, not of rows
    return rows.join(F.broadcast(cuts)).groupBy("cut").agg(F.sum("n").alias("n"), F.sum(F.when(cleared, F.col("n")).otherwise(0)).alias("cleared"), F.sum(F.when(cleared, F.col("s")).otherwise(0.0)).alias("seconds"))


FLAGSHIP = "select s.source, t.tier, coalesce(f.fail_reason, 'eligible') decision, count(*) segments, sum(s.duration_sec) / 3600 as hours from fx_segments s join gd f on s.id = f.id join gtier t on s.id = t.id group by all"


def flagship(spark, d):
    """Segments and hours by source, tier, and what the gates decided: eligible for training, or why not."""
    decided = decided_rows(spark, d).select("id", "dnsmos", F.coalesce("fail_reason", F.lit("eligible")).alias("decision"))
    rows = fx(spark, d, "fx_segments").select("id", "source", "duration_sec").join(decided, "id").join(fx(spark, d, "fx_agreement").select("id", "agreement", "text_verified"), "id")
    rows = rows.select("source", "duration_sec", "decision", G.tier().alias("tier"))
    return rows.groupBy("source", "tier", "decision").agg(F.count("*").alias("segments"), (F.sum("duration_sec") / 3600).alias("hours"))


query("eligible_hours", with_fx(FLAGSHIP, **CTES))(flagship)
