"""Queries of calibration, labels, segmentation and embeddings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from corvane.functions import lexicon as L
from corvane.operators import labels as B
from corvane.operators import segmentation as S
from corvane.operators import speakers as K
from corvane.plans.fixtures import fx, load, with_fx
from corvane.plans.registry import query

STATS = "select speaker_id, avg(f0_median_hz) mu, greatest(stddev_pop(f0_median_hz), 1e0) sigma, count(*) n from fx_prosody where f0_median_hz is not null group by speaker_id having count(*) >= 5"


@query("rate_percentiles", with_fx("select quantile_cont(rate_raw, 0.25) p25, quantile_cont(rate_raw, 0.75) p75 from fx_prosody"))
def rate_percentiles(spark, d):
    return B.rate_percentiles(fx(spark, d, "fx_prosody"))


@query("pitch_stats", with_fx("select speaker_id, round(mu, 6) mu, round(sigma, 6) sigma, n from (" + STATS + " union all select null, avg(f0_median_hz), greatest(stddev_pop(f0_median_hz), 1e0), count(f0_median_hz) from fx_prosody)"))
def pitch_stats(spark, d):
    return B.pitch_stats(fx(spark, d, "fx_prosody")).select("speaker_id", F.round("mu", 6).alias("mu"), F.round("sigma", 6).alias("sigma"), "n")


@query("bucket_rate", with_fx("select id, case when rate_raw is null then null when rate_raw < p25 then 'slow' when rate_raw > p75 then 'fast' else 'normal' end rate from fx_prosody, (select quantile_cont(rate_raw, 0.25) p25, quantile_cont(rate_raw, 0.75) p75 from fx_prosody)"))
def bucket_rate(spark, d):
    p = fx(spark, d, "fx_prosody")
    return p.join(F.broadcast(B.rate_percentiles(p))).select("id", B.bucket_rate(F.col("rate_raw"), F.col("p25"), F.col("p75")).alias("rate"))  # one row


@query("bucket_pitch", with_fx(f"select id, case when f0_median_hz is null then null when (f0_median_hz - mu) / sigma < -0.5 then 'low' when (f0_median_hz - mu) / sigma > 0.5 then 'high' else 'normal' end pitch from fx_prosody p join ({STATS}) s on p.speaker_id = s.speaker_id"))
def bucket_pitch(spark, d):
    p = fx(spark, d, "fx_prosody")
    return p.join(B.pitch_stats(p).where("speaker_id is not null"), "speaker_id").select("id", B.bucket_pitch(B.pitch_z(F.col("f0_median_hz"), F.col("mu"), F.col("sigma"))).alias("pitch"))


@query("rate_raw", with_fx("select g.id, case when s.duration_sec > 0 and n > 0 and coalesce(e, 0) <= 0.5 then round(n / s.duration_sec, 3) end rate_raw from (select id, len(list_filter(string_split_regex(jyutping, '\\s+'), lambda x: regexp_full_match(x, '[a-z]+[1-6]'))) n from fx_g2p) g join (select *, case when num % 3 = 0 then 0.7 else 0.1 end e from fx_segments) s on g.id = s.id"))
def rate_raw(spark, d):
    from corvane.functions.text import count_syllables

    rows = fx(spark, d, "fx_g2p").join(fx(spark, d, "fx_segments"), "id")
    e = F.when(F.col("num") % 3 == 0, 0.7).otherwise(0.1)
    return rows.select("id", B.rate_raw(count_syllables(F.col("jyutping")), F.col("duration_sec"), e).alias("rate_raw"))


STORE = "select s.id, l.lang, l.cmn_prob, o.overlap_ratio, m.music_prob from fx_segments s left join fx_labels_lang l on s.id = l.id left join fx_labels_overlap o on s.id = o.id left join fx_labels_music m on s.id = m.id"


@query("label_store", with_fx(f"select id, lang, overlap_ratio is not null o, music_prob is not null m from ({STORE}) where (lang is not null and cmn_prob is not null) or overlap_ratio is not null or music_prob is not null"))
def label_store(spark, d):
    rows = fx(spark, d, "fx_segments").select("id").join(fx(spark, d, "fx_labels_lang"), "id", "left").join(fx(spark, d, "fx_labels_overlap"), "id", "left").join(fx(spark, d, "fx_labels_music"), "id", "left")
    out = B.label_store(rows.withColumns({"rate": F.lit(None).cast("string"), "pitch": F.lit("normal")}))
    of = lambda k: F.get_json_object("line", f"$.quality.{k}")
    return out.select("id", of("lang").alias("lang"), of("overlap_ratio").isNotNull().alias("o"), of("music_prob").isNotNull().alias("m"))


@query("json_tolerant", "select doc_id, case when doc_id % 3 <> 0 then doc_id end n from documents")
def json_tolerant(spark, d):
    line = F.when(F.col("doc_id") % 3 == 0, '{"n": broken').otherwise(F.format_string('{"n": %d}', "doc_id"))
    return load(spark, d, "documents").select("doc_id", F.from_json(line, "n bigint")["n"].alias("n"))


@query("cast_date", "select o_orderkey, try_cast(case when o_orderkey % 5 = 0 then 'soon' else cast(o_orderdate as varchar)[1:10] end as date) as day from orders")
def cast_date(spark, d):
    s = F.when(F.col("o_orderkey") % 5 == 0, "soon").otherwise(F.substring(F.col("o_orderdate").cast("string"), 1, 10))
    return load(spark, d, "orders").select("o_orderkey", F.try_to_date(s, "yyyy-MM-dd").alias("day") if hasattr(F, "try_to_date") else s.try_cast("date").alias("day"))


@query("age_days", "select o_orderkey, cast(date_diff('day', cast(o_orderdate as date), date '2020-01-01') as bigint) age from orders")
def age_days(spark, d):
    return load(spark, d, "orders").select("o_orderkey", F.datediff(F.lit("2020-01-01").cast("date"), F.col("o_orderdate").cast("date")).cast("long").alias("age"))


@query("f0_median", with_fx("select speaker_id, median(f0_median_hz) f0 from fx_prosody where f0_median_hz > 90 group by speaker_id"))
def f0_median(spark, d):
    return B.quantiles(fx(spark, d, "fx_prosody").where("f0_median_hz > 90"), ["speaker_id"], "f0_median_hz", {"f0": 0.5})


@query("window_starts", with_fx("select raw_id, page_id, duration_sec, cast(case when duration_sec <= 0 then 0 when duration_sec * 0.9 <= 25 then 1 when duration_sec * 0.9 >= 50 then 10 else greatest(1, cast(floor(duration_sec * 0.9 / 25) as int)) end as bigint) n from fx_raw_files"))
def window_starts(spark, d):
    starts = S.window_starts(F.col("duration_sec"))
    return fx(spark, d, "fx_raw_files").select("raw_id", "page_id", "duration_sec", F.size(starts).cast("long").alias("n"))


@query("vad_gaps", with_fx("select raw_id, turn_idx, next_ - end_sec gap from (select *, lead(start_sec) over (partition by raw_id order by start_sec, turn_idx) next_ from (select raw_id, turn_idx, start_sec + turn_idx % 3 start_sec, end_sec from fx_turns)) where next_ - end_sec >= 0.2"))
def vad_gaps(spark, d):
    return S.gaps(fx(spark, d, "fx_turns").withColumn("start_sec", F.col("start_sec") + F.col("turn_idx") % 3), "raw_id").select("raw_id", "turn_idx", "gap")


@query("turn_window_range_join", with_fx("select t.raw_id, t.turn_idx, w.turn_idx w from fx_turns t join fx_turns w on t.raw_id = w.raw_id and w.start_sec >= t.start_sec and w.end_sec <= t.end_sec + 2"))
def turn_window_range_join(spark, d):
    t, w = fx(spark, d, "fx_turns").alias("t"), fx(spark, d, "fx_turns").alias("w")
    return S.inside(w, t, F.lit(2)).select("t.raw_id", "t.turn_idx", F.col("w.turn_idx").alias("w"))


@query("vad_cut", with_fx("select raw_id, turn_idx, row_number() over (partition by raw_id order by start_sec, turn_idx) - 1 seq, substr(md5(raw_id || '_' || (row_number() over (partition by raw_id order by start_sec, turn_idx) - 1)), 1, 12) id from fx_turns where end_sec - start_sec between 3 and 20"))
def vad_cut(spark, d):
    return S.cut_clips(fx(spark, d, "fx_turns")).select("raw_id", "turn_idx", "seq", "id")


@query("turns_explode", "select conv_id, turn, coalesce(nullif(role, 'user'), 'SPEAKER_UNKNOWN') tag from conversations")
def turns_explode(spark, d):
    rows = load(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    return rows.select("conv_id", F.explode("turns").alias("x")).select("conv_id", "x.turn", F.coalesce(F.nullif(F.col("x.role"), F.lit("user")), F.lit("SPEAKER_UNKNOWN")).alias("tag"))


@query("gap_overlap", with_fx("select raw_id, turn_idx, exists (select 1 from fx_turns b where a.raw_id = b.raw_id and b.turn_idx > a.turn_idx and b.start_sec <= a.end_sec + 0.15 and b.end_sec >= a.start_sec - 0.15) hit from fx_turns a"))
def gap_overlap(spark, d):
    return S.overlaps_a_later(fx(spark, d, "fx_turns")).select("raw_id", "turn_idx", "hit")


@query("pause_total", with_fx("select raw_id, round(sum(end_sec - start_sec), 3) total from fx_turns group by raw_id"))
def pause_total(spark, d):
    g = fx(spark, d, "fx_turns").groupBy("raw_id").agg(F.sort_array(F.collect_list(F.col("end_sec") - F.col("start_sec"))).alias("gaps"))
    return g.select("raw_id", F.round(F.aggregate("gaps", F.lit(0.0), lambda a, x: a + x), 3).alias("total"))


@query("pause_distribution", "select event_type, quantile_cont(value, 0.25) p25, median(value) p50, quantile_cont(value, 0.75) p75, avg(case when value < 16 then 1e0 else 0 end) no_pause from events group by event_type")
def pause_distribution(spark, d):
    events = load(spark, d, "events")
    share = events.groupBy("event_type").agg(F.avg(F.when(F.col("value") < 16, 1.0).otherwise(0.0)).alias("no_pause"))
    return B.quantiles(events, ["event_type"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}).join(share, "event_type")


@query("overlap_ratio", with_fx("select conv_id, avg(case when n >= 2 then 1e0 else 0 end) overlap, avg(case when n >= 1 then 1e0 else 0 end) speech from (select conv_id, turn, (length(text) % 3 > 0)::int + (length(text) % 5 > 2)::int n from conversations) group by conv_id"))
def overlap_ratio(spark, d):
    n = (F.length("text") % 3 > 0).cast("int") + (F.length("text") % 5 > 2).cast("int")
    return S.overlap(load(spark, d, "conversations").select(F.col("conv_id"), n.alias("active")), "conv_id")


TAGS = ["Music", "Piano", "Speech", "Bird vocalization, bird call, bird song", "Speech synthesizer", "Wind instrument, woodwind instrument", "Engine"]


@query("music_taxonomy", f"select t tag from (select unnest({TAGS}) t) where regexp_matches(lower(t), '" + "|".join(w.replace("(", "\\(").replace(")", "\\)") for w in L.MUSIC_WORDS) + "') and t not in ('Speech synthesizer', 'Bird vocalization, bird call, bird song')")
def music_taxonomy(spark, d):
    tags = spark.createDataFrame([(t,) for t in TAGS], "tag string")
    return tags.where(S.is_music(F.col("tag")))


@query("music_prob", "select vec_id, list_max([embedding[1], embedding[3], embedding[5]]) prob from embeddings")
def music_prob(spark, d):
    e = F.col("embedding")
    return load(spark, d, "embeddings").select("vec_id", F.array_max(F.array(e[0], e[2], e[4])).alias("prob"))


@query("top3", "select vec_id, list_reverse_sort(embedding)[1] a, list_reverse_sort(embedding)[2] b, list_reverse_sort(embedding)[3] c from embeddings")
def top3(spark, d):
    top = F.slice(F.sort_array("embedding", False), 1, 3)
    return load(spark, d, "embeddings").withColumn("t", top).select("vec_id", F.col("t")[0].alias("a"), F.col("t")[1].alias("b"), F.col("t")[2].alias("c"))


@query("lr_corr", "select user_id, case when stddev_pop(value) > 0 and stddev_pop(event_id) > 0 then round(corr(value, event_id), 9) end r from events group by user_id")
def lr_corr(spark, d):
    return S.correlation(load(spark, d, "events"), ["user_id"], "value", "event_id").select("user_id", F.round("r", 9).alias("r"))


FRAMES = "select user_id, value e, row_number() over (partition by user_id order by value, event_id) k, count(*) over (partition by user_id) n from events"


@query("snr_frames", f"select user_id, round(10 * log10((avg(case when k > n - greatest(1, n // 10) then e end) + 1e-10) / (avg(case when k <= greatest(1, n // 10) then e end) + 1e-10)), 1) snr from ({FRAMES}) group by user_id")
def snr_frames(spark, d):
    return S.snr_of_frames(load(spark, d, "events").select("user_id", "event_id", F.col("value").alias("energy")), "user_id", "event_id")


@query("snr_pregate", "select user_id, round(10 * log10((quantile_cont(value, 0.9) + 1e-10) / (quantile_cont(value, 0.1) + 1e-10)), 2) snr from events group by user_id")
def snr_pregate(spark, d):
    q = B.quantiles(load(spark, d, "events"), ["user_id"], "value", {"high": 0.9, "low": 0.1})
    return q.select("user_id", F.round(10 * F.log10((F.col("high") + 1e-10) / (F.col("low") + 1e-10)), 2).alias("snr"))


@query("cosine_sim", "select a.vec_id, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) sim from embeddings a join embeddings b on b.vec_id = a.vec_id + 1")
def cosine_sim(spark, d):
    e = load(spark, d, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(b, "vec_id").select("vec_id", F.round(K.cosine(F.col("embedding"), F.col("other")), 6).alias("sim"))


def _vectors(spark, d):
    return load(spark, d, "embeddings").select(F.concat(F.lit("v"), "vec_id").alias("id"), F.concat(F.lit("src"), "label").alias("source"), "embedding")


@query("nearest_centroid", "select concat('v', e.vec_id) id, arg_max(c.vec_id % 4, list_cosine_similarity(e.embedding::double[], c.embedding::double[])) cluster_id from embeddings e join (select * from (select *, row_number() over (partition by label order by vec_id) k from embeddings) where k <= 1) c on e.label = c.label group by e.vec_id")
def nearest_centroid(spark, d):
    w = Window.partitionBy("label").orderBy("vec_id")
    c = load(spark, d, "embeddings").withColumn("k", F.row_number().over(w)).where("k <= 1")
    c = c.select(F.concat(F.lit("src"), "label").alias("source"), (F.col("vec_id") % 4).cast("int").alias("cluster_id"), F.col("embedding").alias("centroid"))
    return K.assign(_vectors(spark, d), c).select("id", F.col("cluster_id").cast("long").alias("cluster_id"))


@query("speaker_cluster")
def speaker_cluster(spark, d):
    return K.cluster(_vectors(spark, d))


@query("speaker_id_fmt", "select vec_id, printf('%s_%03d', concat('src', label), vec_id % 50) speaker_id from embeddings")
def speaker_id_fmt(spark, d):
    return load(spark, d, "embeddings").select("vec_id", F.format_string("%s_%03d", F.concat(F.lit("src"), "label"), F.col("vec_id") % 50).alias("speaker_id"))


@query("decode_stub")
def decode_stub(spark, d):
    from corvane.functions.models import run_model

    rows = load(spark, d, "events").select(F.concat(F.lit("s"), "event_id").alias("id"), F.col("value").alias("x"))
    return run_model(rows, lambda pdf: pd.DataFrame({"id": pdf.id, "rms": np.sqrt(pdf.x**2)}), "id string, rms double", batch=256)


@query("g2p_stub")
def g2p_stub(spark, d):
    from corvane.functions.models import lexicon_reader

    return load(spark, d, "documents").select("doc_id", lexicon_reader({"th": "t6", "er": "o1", "the": "di1"})(F.col("text")).alias("reading"))
