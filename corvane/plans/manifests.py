"""Queries of the manifest, its report, and review."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corvane.operators import manifest as M
from corvane.operators import report as R
from corvane.operators import review as V
from corvane.plans.fixtures import fx, load, with_fx
from corvane.plans.gates import CTES, decided_rows, tier_rows
from corvane.plans.registry import query

QUALITY = "select a.id, case when a.dnsmos_sig >= 3.7 and m.music_prob < 0.1 and o.overlap_ratio < 0.05 then 'B' else 'A' end quality_tier from fx_acoustic a left join fx_labels_music m on a.id = m.id left join fx_labels_overlap o on a.id = o.id"
FILTERS = "select id, case when num % 12 = 0 then null else pass end pass, case when num % 12 = 0 then null else 'filter_decide' end provenance, dnsmos, snr_db, english_ratio from (select g.*, s.num from gd g join fx_segments s on g.id = s.id)"
MANIFEST = "select s.*, a.agreement, a.best_text, a.text_verified, g.jyutping, f.dnsmos, f.snr_db, f.english_ratio, t.tier, q.quality_tier from fx_segments s join fx_agreement a on s.id = a.id join fx_g2p g on s.id = g.id join mf f on s.id = f.id join gtier t on s.id = t.id left join mq q on s.id = q.id where (f.pass or (f.pass is null and f.provenance is null)) and (g.valid_fraction >= 0.8 or (g.valid_fraction is null and f.provenance is null)) and g.jyutping <> '' and t.tier in ('gold', 'auto_gold', 'silver', 'bronze')"
ALL = {**CTES, "mq": QUALITY, "mf": FILTERS, "mm": MANIFEST}


def rows(spark, d, **cuts):
    from corvane.plans.gates import quality_tier

    num = F.substring("id", 2, 20).cast("long")
    f = decided_rows(spark, d)
    f = f.select("id", F.when(num % 12 != 0, F.col("pass")).alias("pass"), F.when(num % 12 != 0, "filter_decide").alias("provenance"), "dnsmos", "snr_db", "english_ratio")
    return M.manifest(fx(spark, d, "fx_segments"), fx(spark, d, "fx_agreement"), fx(spark, d, "fx_g2p"), f, tier_rows(spark, d), quality_tier(spark, d), **cuts)


@query("manifest_build", with_fx("select id, tier, agreement, jyutping from mm", **ALL))
def manifest_build(spark, d):
    return rows(spark, d).select("id", "tier", "agreement", "jyutping")


@query("manifest_cut_tier", with_fx("select id from mm where tier in ('gold', 'auto_gold', 'silver')", **ALL))
def manifest_cut_tier(spark, d):
    return rows(spark, d, min_tier="silver").select("id")


@query("manifest_cut_quality", with_fx("select id from mm where quality_tier = 'B'", **ALL))
def manifest_cut_quality(spark, d):
    return rows(spark, d, min_quality_tier="B").select("id")


@query("manifest_cut_code_switch", with_fx("select id from mm where english_ratio > 0", **ALL))
def manifest_cut_code_switch(spark, d):
    return rows(spark, d, code_switch="only").select("id")


@query("manifest_cut_agreement", with_fx("select id from mm where agreement >= 0.9", **ALL))
def manifest_cut_agreement(spark, d):
    return rows(spark, d, min_agreement=0.9).select("id")


ENTRIES = "select id, audio_path, coalesce(nullif(best_text, ''), '') text, source, coalesce(nullif(domain, ''), 'other') domain, coalesce(nullif(speaker_id, ''), source || '_unk') speaker_id, coalesce(nullif(gender, ''), 'unknown') gender, round(duration_sec, 3) duration_sec, sample_rate, round(coalesce(agreement, 0), 3) asr_agreement, round(coalesce(snr_db, 0), 1) snr_db, round(coalesce(dnsmos, 0), 2) dnsmos, jyutping, tier, coalesce(text_verified, false) text_verified from mm"


@query("manifest_entry", with_fx(ENTRIES, **ALL))
def manifest_entry(spark, d):
    return M.entries(rows(spark, d))


@query("export_jsonl", with_fx(f"{ENTRIES}", **ALL))
def export_jsonl(spark, d):
    """The export's lines, written and read again."""
    from corvane.sources.files import read_jsonl, write_jsonl
    from corvane.streaming.staging import folder

    made, at = M.entries(rows(spark, d)), folder(spark)
    write_jsonl(made, at)
    return read_jsonl(spark, at, made.schema)


@query("tier_counts", with_fx("select tier, count(*) n, sum(duration_sec) / 3600 as hours, count(distinct speaker_id) speakers from mm group by tier", **ALL))
def tier_counts(spark, d):
    return rows(spark, d).groupBy("tier").agg(F.count("*").alias("n"), (F.sum("duration_sec") / 3600).alias("hours"), F.count_distinct("speaker_id").alias("speakers"))


SPLIT = "select s.id, s.source, coalesce(case when s.num % 10 = 0 then 'train' when s.num % 10 = 5 then 'val' end, p.new) split from fx_segments s left join (select source, speaker_id, case when k > n - greatest(1, floor(n * 0.05)) then 'val' else 'train' end new from (select *, row_number() over (partition by source order by f) k, count(*) over (partition by source) n from (select source, speaker_id, min(id) f from fx_segments where num % 5 <> 0 group by all))) p on s.source = p.source and s.speaker_id = p.speaker_id"


def split_rows(spark, d):
    s = fx(spark, d, "fx_segments")
    return M.split(s, train=s.where("num % 10 = 0"), val=s.where("num % 10 = 5")).select("id", "source", "split")


@query("train_val_split", with_fx(SPLIT))
def train_val_split(spark, d):
    return split_rows(spark, d)


@query("split_val", with_fx("select source, speaker_id from (select *, row_number() over (partition by source order by f) k, count(*) over (partition by source) n from (select source, speaker_id, min(id) f from fx_segments group by all)) where k > n - greatest(1, floor(n * 0.05))"))
def split_val(spark, d):
    return M.split(fx(spark, d, "fx_segments")).where("split = 'val'").select("source", "speaker_id").distinct()


@query("split_leak_check", with_fx("select source, speaker_id from sp join fx_segments s using (id, source) where split = 'train' intersect select source, speaker_id from sp join fx_segments s using (id, source) where split = 'val'", sp=SPLIT))
def split_leak_check(spark, d):
    """Speakers on both sides: where ids that a side had before hold them there."""
    s = split_rows(spark, d).join(fx(spark, d, "fx_segments").select("id", "speaker_id"), "id")
    side = lambda k: s.where(F.col("split") == k).select("source", "speaker_id")
    return side("train").intersect(side("val"))


@query("report_summary", with_fx("select count(*) n, sum(duration_sec) / 3600 as hours, count(distinct speaker_id) speakers, count(distinct source) sources, count(distinct domain) domains, avg(case when text_verified then 1e0 else 0 end) verified, avg(case when sample_rate = 48000 then 1e0 else 0 end) at_rate, avg(case when duration_sec between 3 and 20 then 1e0 else 0 end) in_range from mm", **ALL))
def report_summary(spark, d):
    return R.summary(rows(spark, d))


@query("report_percentiles", with_fx("select source, max(case when k = least(cast(floor(n * 0.5) as bigint), n - 1) + 1 then snr_db end) p50, max(case when k = least(cast(floor(n * 0.1) as bigint), n - 1) + 1 then snr_db end) p10 from (select source, snr_db, row_number() over (partition by source order by snr_db) k, count(*) over (partition by source) n from mm) group by source", **ALL))
def report_percentiles(spark, d):
    return R.percentiles(rows(spark, d), ["source"], "snr_db", {"p50": 50, "p10": 10})


@query("acceptance", with_fx("select label, value >= least_ passed from (select sum(duration_sec) / 3600 h, count(distinct speaker_id) s, count(distinct source) so, count(distinct domain) dm, avg(case when text_verified then 1e0 else 0 end) v from mm) cross join lateral (values ('total_hours', h, 100e0), ('speakers', s::double, 100e0), ('sources', so::double, 3e0), ('domains', dm::double, 3e0), ('text_verified', v, 1e0)) c(label, value, least_)", **ALL))
def acceptance(spark, d):
    return R.acceptance(R.summary(rows(spark, d)), ("total_hours", "speakers", "sources", "domains", "text_verified")).select("label", "passed")


@query("jyutping_valid_rate", with_fx("select sum(len(list_filter(string_split_regex(jyutping, '\\s+'), lambda x: regexp_full_match(x, '[a-z]+[1-6]')))) / sum(len(string_split_regex(jyutping, '\\s+'))) rate from fx_g2p where jyutping <> ''"))
def jyutping_valid_rate(spark, d):
    return R.valid_rate(fx(spark, d, "fx_g2p"))


@query("breakdown", with_fx("select source, domain, count(*) n, sum(duration_sec) / 3600 as hours, count(*) / sum(count(*)) over () share from fx_segments group by source, domain"))
def breakdown(spark, d):
    return R.breakdown(fx(spark, d, "fx_segments"), ["source", "domain"])


@query("strata_counts", with_fx("select source, case when duration_sec < 5 then 'short' when duration_sec < 10 then 'mid' else 'long' end bucket, coalesce(t.tier, 'none') tier, count(*) n from fx_segments s left join fx_tiers_old t on s.id = t.id group by 1, 2, 3"))
def strata_counts(spark, d):
    rows_ = fx(spark, d, "fx_segments").join(fx(spark, d, "fx_tiers_old").select("id", "tier"), "id", "left")
    b = F.when(F.col("duration_sec") < 5, "short").when(F.col("duration_sec") < 10, "mid").otherwise("long")
    return rows_.groupBy("source", b.alias("bucket"), F.coalesce("tier", F.lit("none")).alias("tier")).agg(F.count("*").alias("n"))


@query("stratified_sample", with_fx("select source, domain, least(n, greatest(1, cast(round(40.0 * n / sum(n) over ()) as bigint))) n from (select source, domain, count(*) n from fx_segments group by all)"))
def stratified_sample(spark, d):
    return V.stratified(fx(spark, d, "fx_segments"), ["source", "domain"], 40).groupBy("source", "domain").agg(F.count("*").alias("n"))


@query("calib_sample", with_fx("select id, agreement from fx_agreement where id not in (select id from fx_review) order by agreement, id limit 25"))
def calib_sample(spark, d):
    return V.sample_queue(fx(spark, d, "fx_agreement"), fx(spark, d, "fx_review"), 25, "agreement_asc").select("id", "agreement")


@query("sample_random", with_fx("select id from fx_agreement where id not in (select id from fx_review) order by md5(id || '/0'), id limit 25"))
def sample_random(spark, d):
    return V.sample_queue(fx(spark, d, "fx_agreement"), fx(spark, d, "fx_review"), 25).select("id")


@query("record_decision_agreement", with_fx("select a.id, case when r.decision = 'verified' then concat('ok', r.queued) else a.best_text end best_text, a.text_verified or coalesce(r.decision = 'verified', false) text_verified from fx_agreement a left join fx_review r on a.id = r.id"))
def record_decision_agreement(spark, d):
    r = fx(spark, d, "fx_review").withColumn("reviewed_text", F.concat(F.lit("ok"), "queued"))
    return V.apply_decisions(r, fx(spark, d, "fx_agreement"), fx(spark, d, "fx_tiers_old"))[0].select("id", "best_text", "text_verified")


@query("record_decision_tiers", with_fx("select id, tier, provenance, asr_model_count from fx_tiers_old where id not in (select id from fx_review where decision in ('verified', 'rejected')) union all select id, case decision when 'verified' then 'gold' else 'excluded' end, case decision when 'verified' then 'calibrate_verify' else 'calibrate_reject' end, null::int from fx_review where decision in ('verified', 'rejected')"))
def record_decision_tiers(spark, d):
    r = fx(spark, d, "fx_review").withColumn("reviewed_text", F.lit(""))
    return V.apply_decisions(r, fx(spark, d, "fx_agreement"), fx(spark, d, "fx_tiers_old"))[1]


@query("overlay", with_fx("select r.id, coalesce(p.decision, r.decision) decision from fx_review r left join (select concat('s', user_id) id, arg_max(event_type, event_id) decision from events group by user_id) p on r.id = p.id"))
def overlay(spark, d):
    pending = load(spark, d, "events").select(F.concat(F.lit("s"), "user_id").alias("id"), F.col("event_type").alias("decision"), F.col("event_id").alias("seq"))
    return V.overlay(fx(spark, d, "fx_review"), pending).select("id", "decision")


@query("queue_stats", with_fx("select v decision, count(r.id) n from (values ('pending'), ('verified'), ('rejected'), ('skipped'), ('flagged')) x(v) left join fx_review r on r.decision = v group by v"))
def queue_stats(spark, d):
    kinds = spark.createDataFrame([(k,) for k in ("pending", "verified", "rejected", "skipped", "flagged")], "decision string")
    n = fx(spark, d, "fx_review").groupBy("decision").agg(F.count("*").alias("n"))
    return F.broadcast(kinds).join(n, "decision", "left").select("decision", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("progress_report", with_fx("select sample_batch, decision, count(*) n from fx_review group by rollup (sample_batch, decision)"))
def progress_report(spark, d):
    return fx(spark, d, "fx_review").rollup("sample_batch", "decision").agg(F.count("*").alias("n"))


@query("avg_agreement", with_fx("select r.decision, avg(a.agreement) agreement from fx_review r join fx_agreement a on r.id = a.id group by r.decision"))
def avg_agreement(spark, d):
    return fx(spark, d, "fx_review").join(fx(spark, d, "fx_agreement"), "id").groupBy("decision").agg(F.avg("agreement").alias("agreement"))


@query("top_reasons", with_fx("select flag_reason, sample_batch, count(*) n from fx_review where flag_reason is not null group by all order by n desc, sample_batch limit 10"))
def top_reasons(spark, d):
    return fx(spark, d, "fx_review").where("flag_reason is not null").groupBy("flag_reason", "sample_batch").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "sample_batch").limit(10)


@query("next_pending", with_fx("select r.id from fx_review r join fx_agreement a on r.id = a.id where decision = 'pending' and sample_batch = 'batch_0' and r.id not in ('s0') order by a.agreement, r.id limit 1"))
def next_pending(spark, d):
    rows_ = fx(spark, d, "fx_review").where("decision = 'pending' and sample_batch = 'batch_0'").join(fx(spark, d, "fx_agreement").select("id", "agreement"), "id")
    return rows_.where(~F.col("id").isin("s0")).orderBy("agreement", "id").limit(1).select("id")


@query("pending_queue", with_fx("select r.id, a.best_text from fx_review r left join fx_agreement a on r.id = a.id where decision = 'pending'"))
def pending_queue(spark, d):
    return fx(spark, d, "fx_review").where("decision = 'pending'").join(fx(spark, d, "fx_agreement"), "id", "left").select("id", "best_text")


@query("list_history", with_fx("select id, decision from fx_review where decision <> 'pending' order by queued desc limit 20"))
def list_history(spark, d):
    return fx(spark, d, "fx_review").where("decision <> 'pending'").orderBy(F.desc("queued")).limit(20).select("id", "decision")


@query("list_batches", with_fx("select distinct sample_batch from fx_review"))
def list_batches(spark, d):
    return fx(spark, d, "fx_review").select("sample_batch").distinct()


@query("prune_excluded", with_fx("select id, decision from fx_review where not (decision = 'pending' and id in (select id from fx_tiers_old where tier = 'excluded'))"))
def prune_excluded(spark, d):
    gone = fx(spark, d, "fx_tiers_old").where("tier = 'excluded'").select("id", F.lit("pending").alias("decision"))
    return fx(spark, d, "fx_review").join(gone, ["id", "decision"], "left_anti").select("id", "decision")


@query("pause_qc_next", with_fx("select id from fx_tiers_old where tier = 'gold' and not exists (select 1 from fx_review r where r.id = fx_tiers_old.id)"))
def pause_qc_next(spark, d):
    return fx(spark, d, "fx_tiers_old").where("tier = 'gold'").join(fx(spark, d, "fx_review").select("id"), "id", "left_anti").select("id")


@query("pause_qc_report", "select plan, count(*) n, avg(case when plan = seen then 1e0 else 0 end) matches, count(distinct user_id) people from (select user_id, case when value < 16 then 'no_pause' when value < 48 then 'short' else 'long' end plan, case when value < 20 then 'no_pause' when value < 40 then 'short' else 'long' end seen from events where event_type <> 'error') group by plan")
def pause_qc_report(spark, d):
    v = F.col("value")
    e = load(spark, d, "events").where("event_type <> 'error'").select("user_id", F.when(v < 16, "no_pause").when(v < 48, "short").otherwise("long").alias("plan"), F.when(v < 20, "no_pause").when(v < 40, "short").otherwise("long").alias("seen"))
    return e.groupBy("plan").agg(F.count("*").alias("n"), F.avg(F.when(F.col("plan") == F.col("seen"), 1.0).otherwise(0.0)).alias("matches"), F.count_distinct("user_id").alias("people"))
