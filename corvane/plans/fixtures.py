"""Corpus-shaped views over the driver's tables, as SQL that both engines read alike."""

from __future__ import annotations

import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

FX = {
    "fx_segments": "select concat('s', doc_id) id, doc_id num, concat('/data/segments/', source, '/', doc_id, '.flac') audio_path, case doc_id % 3 when 0 then 'rthk' when 1 then 'podcast' else 'youtube' end source, case doc_id % 3 when 0 then 'rthk' when 1 then 'podcast' else 'youtube' end program, case lang when 'en' then 'news' when 'de' then 'drama' when 'fr' then 'podcast' else 'documentary' end domain, cast((doc_id * 7) % 230 as double) / 10 duration_sec, case when doc_id % 17 = 0 then 44100 else 48000 end sample_rate, concat('spk_', doc_id % 23) speaker_id, case when doc_id % 5 = 0 then '' when doc_id % 2 = 0 then 'female' else 'male' end gender, case when doc_id % 4 = 0 then concat('r', doc_id % 50) end raw_id from documents",
    "fx_agreement": "select concat('s', d.doc_id) id, cast((d.doc_id * 37) % 101 as double) / 100 agreement, translate(substr(d.text, 1, cast(3 + d.doc_id % 190 as int)), 'etaoinshr', '係冇佢的是我們說喺') best_text, coalesce(l.quality = 1 and d.doc_id % 50 = 1, false) text_verified, cast(2 + (case when d.doc_id % 4 = 0 then 1 else 0 end) as int) model_count from documents d left join labels l on d.doc_id = l.doc_id where d.doc_id % 13 <> 5",
    "fx_acoustic": "select concat('s', doc_id) id, 15 + cast((doc_id * 13) % 300 as double) / 10 snr_db, 2.5e0 + cast((doc_id * 29) % 200 as double) / 100 dnsmos_sig, 2.4e0 + cast((doc_id * 31) % 200 as double) / 100 dnsmos_ovrl from documents where doc_id % 11 <> 3",
    "fx_labels_lang": "select concat('s', doc_id) id, case lang when 'en' then 'yue' when 'de' then 'cmn' when 'fr' then 'eng' else 'vie' end lang, cast((doc_id * 31) % 101 as double) / 100 lang_prob, case when lang = 'de' then cast((doc_id * 31) % 101 as double) / 100 else 0e0 end cmn_prob from documents where doc_id % 6 <> 0",
    "fx_labels_music": "select concat('s', doc_id) id, cast((doc_id * 11) % 50 as double) / 100 music_prob from documents where doc_id % 20 <> 0",
    "fx_labels_overlap": "select concat('s', doc_id) id, cast((doc_id * 3) % 40 as double) / 400 overlap_ratio from documents where doc_id % 19 <> 0",
    "fx_asr_results": "select concat('s', doc_id) id, 'alpha' model, substr(text, 1, 40) text, cast((doc_id * 17) % 100 as double) / 100 confidence from documents union all select concat('s', doc_id), 'beta', case when doc_id % 9 = 0 then '' else substr(text, 2, 40) end, cast((doc_id * 19) % 100 as double) / 100 from documents where doc_id % 10 <> 1 union all select concat('s', doc_id), 'gamma', substr(text, 1, 38), 1e0 from documents where doc_id % 4 = 0",
    "fx_task_runs": "select concat('run', event_id % 7) run_id, case when event_id % 2 = 0 then 'filter' else 'tier' end node, concat('s', event_id) item_id, case event_type when 'error' then 'error' when 'signup' then 'skipped' else 'ok' end status from events",
    "fx_turns": "select conv_id raw_id, turn turn_idx, role speaker_tag, cast(coalesce(sum(length(text)) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as double) / 16 start_sec, cast(sum(length(text)) over (partition by conv_id order by turn rows between unbounded preceding and current row) as double) / 16 end_sec from conversations",
    "fx_review": "select concat('s', doc_id) id, case when toxic = 1 then 'rejected' when doc_id % 5 = 0 then 'pending' when quality = 1 then 'verified' else 'skipped' end decision, concat('batch_', doc_id % 3) sample_batch, case when toxic = 1 then 'mandarin' end flag_reason, doc_id queued from labels",
    "fx_raw_files": "select substr(md5(url), 1, 8) raw_id, page_id, concat('/raw/', page_id, case when page_id % 3 = 0 then '.wav' else '.webm' end) wav_path, url source_url, cast((page_id * 97) % 4000 as double) duration_sec from pages",
    "fx_prosody": "select concat('s', event_id) id, concat('spk_', user_id % 23) speaker_id, case when event_type <> 'error' then value / 50 end rate_raw, case when event_type <> 'signup' then 80 + value end f0_median_hz from events",
    "fx_g2p": "select concat('s', doc_id) id, case when doc_id % 8 = 0 then '' when doc_id % 3 = 0 then 'nei5 hou2 hello3 xx9' else 'ngo5 hai6 hoeng1 gong2 jan4' end jyutping, case when doc_id % 9 = 0 then null when doc_id % 3 = 0 then 0.5e0 else 1e0 end valid_fraction from documents where doc_id % 7 <> 2",
    "fx_tiers_old": "select concat('s', doc_id) id, case doc_id % 4 when 0 then 'gold' when 1 then 'silver' when 2 then 'bronze' else 'excluded' end tier, case doc_id % 10 when 0 then 'calibrate_verify' when 2 then 'calibrate_reject' when 4 then null else 'tier_assign' end provenance, cast(2 + doc_id % 2 as int) asr_model_count from documents where doc_id % 2 = 0",
    "fx_filters_old": "select concat('s', doc_id) id, doc_id % 3 <> 0 pass, case when doc_id % 3 = 0 then 'snr' end fail_reason, case when doc_id % 12 = 0 then null else 'filter_decide' end provenance, cast(2 + doc_id % 2 as int) text_model_count, doc_id % 5 <> 0 lang_label_checked from documents where doc_id % 2 = 0",
    "fx_text_old": "select concat('s', doc_id) id, doc_id % 3 <> 0 pass, cast(2 + doc_id % 3 as int) asr_model_count from documents where doc_id % 4 <> 3",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame; only the tables that it names are opened."""
    sql = FX[name]
    used = [t for t in TABLES if re.search(rf"\b(?:from|join) {t}\b", sql)]
    for t in used:
        sql = re.sub(rf"\b(from|join) {t}\b", rf"\1 {{{t}}}", sql)
    return spark.sql(sql, **{t: load(spark, sf_dir, t) for t in used})


def with_fx(sql: str, **more: str) -> str:
    """The SQL with the views it names before it."""
    ctes = {**FX, **more}
    need, todo = [], [sql]
    while todo:
        text = todo.pop()
        for n in ctes:
            if n not in need and re.search(rf"\b{n}\b", text):
                need.append(n)
                todo.append(ctes[n])
    order = [n for n in ctes if n in need]
    return ("with " + ", ".join(f"{n} as ({ctes[n]})" for n in order) + " " if order else "") + sql


#: All bytes but those of letters.
NO_LETTER = bytes(set(range(256)) - set(string.ascii_letters.encode()))


def aligned(texts: pa.Array, doc_ids: pa.Array) -> pa.Array:
    """The letters of texts as aligned characters; of some, one letter more than the text has, which no text can meet."""
    n = doc_ids.to_numpy()
    letters = [t.encode("utf-8", "surrogatepass").translate(None, NO_LETTER) + b"x" * (k == 4) for t, k in zip(texts.to_pylist(), np.fmod(n, 11).tolist())]
    sizes = np.array([len(c) for c in letters], np.int64)
    upto = np.concatenate([[0], np.cumsum(sizes)])
    i = np.arange(upto[-1]) - np.repeat(upto[:-1], sizes)
    start = i * 0.3 + (i % 4) * 0.15 + np.repeat(np.fmod(n, 3) * 0.2, sizes) * i
    ch = pa.StringArray.from_buffers(len(i), pa.py_buffer(np.arange(len(i) + 1, dtype=np.int32)), pa.py_buffer(b"".join(letters)))
    chars = pa.StructArray.from_arrays([ch, pa.array(start), pa.array(start + 0.2)], names=["ch", "start_sec", "end_sec"])
    return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), chars)
