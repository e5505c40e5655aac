"""Queries of discovery: what each node has yet to do."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.operators.discover import decide_due, discover, missing_any
from corvane.plans.fixtures import fx, load, with_fx
from corvane.plans.gates import CTES, acoustic_rows, text_rows, tier_rows
from corvane.plans.registry import query


def _ids(df, *more):
    return df.select("id", *more)


def anti(name: str, eligible: str, done: str, key: str, where: str = "", done_where: str = "", **ctes):
    """A plain discovery: eligible rows of one view without a row in another."""
    e, d_ = f"select e.{key} from {eligible} e", f"select {key} from {done}" + (f" where {done_where}" if done_where else "")

    def run(spark, d):
        rows, other = (fx(spark, d, eligible) if eligible.startswith("fx_") else load(spark, d, eligible)), (fx(spark, d, done) if done.startswith("fx_") else load(spark, d, done))
        rows, other = (rows.where(where) if where else rows), (other.where(done_where) if done_where else other)
        return discover(rows, other.select(key), key).select(key)

    query(name, with_fx(f"{e} where {where or 'true'} and not exists (select 1 from ({d_}) x where x.{key} = e.{key})", **ctes))(run)


anti("disc_music", "fx_segments", "fx_labels_music", "id")
anti("disc_overlap", "fx_segments", "fx_labels_overlap", "id")
anti("disc_transcribe", "fx_segments", "fx_asr_results", "id", done_where="model = 'gamma'")
anti("disc_g2p", "fx_filters_old", "fx_g2p", "id", where="pass", done_where="valid_fraction is not null")
anti("disc_align", "fx_tiers_old", "fx_g2p", "id", where="tier in ('gold', 'silver')")
anti("disc_pregate", "fx_segments", "fx_acoustic", "id", where="raw_id is not null")
anti("disc_rebalance", "fx_segments", "fx_filters_old", "id")


@query("disc_suite", with_fx("select * from (select s.id, l.id is null need_lang, o.id is null need_overlap, m.id is null need_music from fx_segments s left join fx_labels_lang l on s.id = l.id left join fx_labels_overlap o on s.id = o.id left join fx_labels_music m on s.id = m.id) where need_lang or need_overlap or need_music"))
def disc_suite(spark, d):
    return missing_any(_ids(fx(spark, d, "fx_segments")), {"lang": fx(spark, d, "fx_labels_lang"), "overlap": fx(spark, d, "fx_labels_overlap"), "music": fx(spark, d, "fx_labels_music")})


@query("disc_prosody", with_fx("select s.id, g.jyutping, f.snr_db from fx_segments s left join fx_g2p g on s.id = g.id left join fx_acoustic f on s.id = f.id where not exists (select 1 from fx_labels_music m where m.id = s.id)"))
def disc_prosody(spark, d):
    rows = discover(_ids(fx(spark, d, "fx_segments")), fx(spark, d, "fx_labels_music"))
    return rows.join(fx(spark, d, "fx_g2p").select("id", "jyutping"), "id", "left").join(fx(spark, d, "fx_acoustic").select("id", "snr_db"), "id", "left")


@query("disc_agreement", with_fx("select r.id, r.n from (select id, count(*) n from fx_asr_results group by id having count(*) >= 2) r left join fx_agreement a on r.id = a.id where a.id is null or (a.model_count is not null and r.n > a.model_count)"))
def disc_agreement(spark, d):
    counts = fx(spark, d, "fx_asr_results").groupBy("id").agg(F.count("*").alias("n")).where("n >= 2")
    return counts.join(fx(spark, d, "fx_agreement").select("id", "model_count", F.lit(True).alias("there")), "id", "left").where("there is null or (model_count is not null and n > model_count)").select("id", "n")


@query("disc_filter_text", with_fx("select a.id from fx_agreement a left join fx_text_old f on a.id = f.id where f.id is null or f.asr_model_count is distinct from a.model_count"))
def disc_filter_text(spark, d):
    return discover(fx(spark, d, "fx_agreement"), fx(spark, d, "fx_text_old").withColumn("provenance", F.lit("x")), stale=("model_count", "asr_model_count")).select("id")


@query("disc_filter_acoustic", with_fx("select t.id from fx_text_old t where t.pass and not exists (select 1 from fx_acoustic a where a.id = t.id)"))
def disc_filter_acoustic(spark, d):
    return discover(fx(spark, d, "fx_text_old").where("pass"), fx(spark, d, "fx_acoustic")).select("id")


@query("disc_filter_decide", with_fx("select t.id from gt t left join ga a on t.id = a.id left join (select * from fx_filters_old where provenance = 'filter_decide') f on t.id = f.id left join fx_labels_lang l on t.id = l.id where (not t.pass or a.id is not null) and (f.id is null or f.text_model_count is distinct from t.asr_model_count or (l.id is not null and not coalesce(f.lang_label_checked, false)))", **CTES))
def disc_filter_decide(spark, d):
    return decide_due(text_rows(spark, d), acoustic_rows(spark, d), fx(spark, d, "fx_filters_old"), fx(spark, d, "fx_labels_lang")).select("id")


@query("disc_tier", with_fx("select a.id from fx_agreement a left join fx_tiers_old t on a.id = t.id where (t.id is null or t.asr_model_count is distinct from a.model_count) and (t.provenance is null or t.provenance not in ('calibrate_verify', 'calibrate_reject'))"))
def disc_tier(spark, d):
    return discover(fx(spark, d, "fx_agreement"), fx(spark, d, "fx_tiers_old"), stale=("model_count", "asr_model_count"), protected=("calibrate_verify", "calibrate_reject")).select("id")


@query("disc_quality_tier", with_fx("select t.id, m.music_prob, o.overlap_ratio from gtier t join gd f on t.id = f.id left join fx_labels_music m on t.id = m.id left join fx_labels_overlap o on t.id = o.id where t.tier in ('gold', 'auto_gold') and f.pass and not exists (select 1 from fx_tiers_old q where q.id = t.id and q.provenance = 'tier_assign')", **CTES))
def disc_quality_tier(spark, d):
    from corvane.plans.gates import decided_rows

    rows = tier_rows(spark, d).where(F.col("tier").isin("gold", "auto_gold")).join(decided_rows(spark, d).where("pass").select("id"), "id")
    rows = discover(rows, fx(spark, d, "fx_tiers_old"), provenance=("tier_assign",))
    return rows.join(fx(spark, d, "fx_labels_music"), "id", "left").join(fx(spark, d, "fx_labels_overlap"), "id", "left").select("id", "music_prob", "overlap_ratio")


@query("disc_pause_plan", with_fx("select t.id from fx_tiers_old t join fx_g2p g on t.id = g.id where t.tier in ('gold', 'auto_gold', 'silver') and g.jyutping <> '' and not exists (select 1 from fx_filters_old f where f.id = t.id and f.provenance is null)"))
def disc_pause_plan(spark, d):
    rows = fx(spark, d, "fx_tiers_old").where("tier in ('gold', 'auto_gold', 'silver')").select("id").join(fx(spark, d, "fx_g2p").where("jyutping <> ''").select("id"), "id")
    return discover(rows, fx(spark, d, "fx_filters_old").where("provenance is null"))


SCREENED = "select raw_id, case page_id % 4 when 0 then 'pass' when 1 then 'reject' when 2 then 'mixed' end decision, case when page_id % 10 = 1 then 'pass' end human_decision from fx_raw_files where page_id % 5 <> 0"
SEGMENTED = "select raw_id from fx_raw_files where page_id % 7 = 0"
FLACS = "select raw_id, page_id % 2 = 0 verified, case when page_id % 3 = 0 then 'deleted' end gone from fx_raw_files where page_id % 6 = 0"


def _raw(spark, d):
    raw = fx(spark, d, "fx_raw_files")
    return raw, spark.sql(SCREENED.replace("fx_raw_files", "{r}"), r=raw), spark.sql(SEGMENTED.replace("fx_raw_files", "{r}"), r=raw), spark.sql(FLACS.replace("fx_raw_files", "{r}"), r=raw)


RAW = {"screened": SCREENED, "segmented": SEGMENTED, "flacs": FLACS}


@query("disc_lang_screen", with_fx("select raw_id from fx_raw_files r where not exists (select 1 from screened s where s.raw_id = r.raw_id)", **RAW))
def disc_lang_screen(spark, d):
    raw, screened, _, _ = _raw(spark, d)
    return discover(raw, screened, "raw_id").select("raw_id")


@query("disc_probe", with_fx("select raw_id from fx_raw_files r where not exists (select 1 from flacs s where s.raw_id = r.raw_id)", **RAW))
def disc_probe(spark, d):
    raw, _, _, flacs = _raw(spark, d)
    return discover(raw, flacs, "raw_id").select("raw_id")


@query("disc_diarize", with_fx("select r.raw_id from fx_raw_files r left join screened s on r.raw_id = s.raw_id where coalesce(s.human_decision, s.decision, 'pass') <> 'reject' and r.raw_id not in (select raw_id from segmented) and r.raw_id not in (select raw_id from flacs)", **RAW))
def disc_diarize(spark, d):
    raw, screened, segmented, flacs = _raw(spark, d)
    rows = discover(discover(raw, segmented, "raw_id"), flacs, "raw_id").join(screened, "raw_id", "left")
    return rows.where(F.coalesce("human_decision", "decision", F.lit("pass")) != "reject").select("raw_id")


@query("disc_vad_cut", with_fx("select distinct raw_id from fx_turns where raw_id % 3 <> 0"))
def disc_vad_cut(spark, d):
    turns = fx(spark, d, "fx_turns")
    return discover(turns.select("raw_id").distinct(), turns.where("raw_id % 3 = 0"), "raw_id")


@query("disc_raw_flac", with_fx("select raw_id from fx_raw_files where wav_path like '%.wav' and raw_id not in (select raw_id from flacs where verified) and (raw_id in (select raw_id from segmented) or raw_id in (select raw_id from screened where coalesce(human_decision, decision) = 'reject'))", **RAW))
def disc_raw_flac(spark, d):
    raw, screened, segmented, flacs = _raw(spark, d)
    ok = segmented.union(screened.where("coalesce(human_decision, decision) = 'reject'").select("raw_id")).distinct()
    return discover(raw.where("wav_path like '%.wav'"), flacs.where("verified"), "raw_id").join(ok, "raw_id", "left_semi").select("raw_id")


@query("disc_delete_verified", with_fx("select raw_id from flacs where verified and gone is null", **RAW))
def disc_delete_verified(spark, d):
    return _raw(spark, d)[3].where("verified and gone is null").select("raw_id")


@query("disc_embed", with_fx("select id, 'new' why from fx_segments where id not in (select id from fx_tiers_old) union all select id, 'stale' from fx_tiers_old where provenance is null"))
def disc_embed(spark, d):
    old = fx(spark, d, "fx_tiers_old")
    return discover(fx(spark, d, "fx_segments"), old).select("id", F.lit("new").alias("why")).unionByName(old.where("provenance is null").select("id", F.lit("stale").alias("why")))


@query("disc_backfill", "select vec_id from embeddings where label % 2 = 0 and vec_id % 3 = 0")
def disc_backfill(spark, d):
    rows = load(spark, d, "embeddings").select("vec_id", F.when(F.col("label") % 2 == 0, "ref").alias("ref"), F.when(F.col("vec_id") % 3 != 0, F.col("embedding")).alias("embedding"))
    return rows.where("ref is not null and embedding is null").select("vec_id")


@query("disc_cluster", "select distinct label from embeddings")
def disc_cluster(spark, d):
    return load(spark, d, "embeddings").select("label").distinct()


@query("orphan_discover", with_fx("select concat('/disk/', page_id % 400) path from fx_raw_files where concat('/disk/', page_id % 400) not in (select concat('/disk/', num) from fx_segments where num % 2 = 0) and concat('/disk/', page_id % 400) not in (select concat('/disk/', doc_id) from labels)"))
def orphan_discover(spark, d):
    disk = fx(spark, d, "fx_raw_files").select(F.concat(F.lit("/disk/"), F.col("page_id") % 400).alias("path"))
    known = fx(spark, d, "fx_segments").where("num % 2 = 0").select(F.concat(F.lit("/disk/"), "num").alias("path"))
    classified = load(spark, d, "labels").select(F.concat(F.lit("/disk/"), "doc_id").alias("path"))
    return discover(discover(disk, known, "path"), classified, "path")


@query("dedup_known", with_fx("select id from fx_segments where id not in (select id from fx_tiers_old union select id from fx_labels_music)"))
def dedup_known(spark, d):
    known = fx(spark, d, "fx_tiers_old").select("id").union(fx(spark, d, "fx_labels_music").select("id")).distinct()
    return discover(fx(spark, d, "fx_segments"), known).select("id")
