"""Nodes over real files, with models that stand in for the trained ones."""

import io
import wave

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corvane import dag, nodes
from corvane.functions import models
from corvane.functions import text as T
from corvane.operators import speakers as K
from corvane.sources import audio
from corvane.sources.catalog import TABLES, Catalog
from corvane.sources.lists import read_lists


def wav(seconds, rate=16000, channels=1, width=2, hz=440.0, gap=None):
    t = np.arange(int(seconds * rate)) / rate
    y = np.stack([0.5 * np.sin(2 * np.pi * hz * t) * (0.8**c) for c in range(channels)], 1)
    if gap:
        y[int(gap[0] * rate) : int(gap[1] * rate)] = 0
    raw = {1: lambda: ((y * 127) + 128).astype(np.uint8).tobytes(), 2: lambda: (y * 32767).astype("<i2").tobytes(), 4: lambda: (y * (2**31 - 1)).astype("<i4").tobytes(), 3: lambda: b"".join(int(v * (2**23 - 1)).to_bytes(3, "little", signed=True) for v in y.ravel())}[width]()
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(raw)
    return out.getvalue()


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_wav_of_each_width(width):
    y, rate = audio.read_wav(wav(0.1, 8000, 2, width))
    assert rate == 8000 and y.shape == (800, 2)
    assert abs(y[:, 0].max() - 0.5) < 0.02 and abs(y[:, 1].max() - 0.4) < 0.02
    assert audio.read_wav(b"no wave") is None and audio.read_wav(b"") is None


@pytest.mark.parametrize("rate,target", [(48000, 16000), (44100, 16000), (16000, 48000), (16000, 16000)])
def test_resampling_keeps_a_tone(rate, target):
    y = audio.read_wav(wav(0.5, rate))[0][:, 0]
    got = audio.resample(y, rate, target)
    want = 0.5 * np.sin(2 * np.pi * 440 * np.arange(len(got)) / target)
    assert len(got) == -(-len(y) * target // rate)
    assert np.abs(got[200:-200] - want[200:-200]).max() < 0.01
    high = 0.5 * np.sin(2 * np.pi * 11000 * np.arange(rate) / rate).astype(np.float32)
    if target < rate:
        assert np.abs(audio.resample(high, rate, target)[200:-200]).max() < 0.02


def test_scan_decode_probe_and_windows(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.wav").write_bytes(wav(1.0, 16000, 2))
    (tmp_path / "deep/b.wav").write_bytes(wav(0.5, 8000))
    (tmp_path / "deep/bad.wav").write_bytes(b"RIFF no")
    (tmp_path / "c.txt").write_text("x")
    found = audio.files(spark, f"file://{tmp_path}")
    name = lambda p: p.rsplit("/", 1)[-1]
    assert sorted(name(r["path"]) for r in found.select("path").collect()) == ["a.wav", "b.wav", "bad.wav"]
    got = {(name(r["path"]), r["sample_rate"]): None if r["samples"] is None else len(r["samples"]) for r in audio.decode(found, [16000, 8000, 16000]).collect()}
    assert got == {("a.wav", 16000): 16000, ("a.wav", 8000): 8000, ("b.wav", 16000): 8000, ("b.wav", 8000): 4000, ("bad.wav", 16000): None, ("bad.wav", 8000): None}
    probed = {name(r["path"]): (r["channels"], r["sample_rate"], r["duration_sec"], r["lr_correlation"] and round(r["lr_correlation"], 4)) for r in audio.probe(found).collect()}
    assert probed == {"a.wav": (2, 16000, 1.0, 1.0), "b.wav": (1, 8000, 0.5, None), "bad.wav": (None, None, None, None)}
    rows = found.where("path like '%a.wav'").withColumn("w", F.expr("array(struct(0D as start, 0.25D as length), struct(0.9D as start, 0.25D as length))"))
    assert [(r["start_sec"], len(r["samples"])) for r in audio.decode(rows, [16000], windows="w").orderBy("start_sec").collect()] == [(0.0, 4000), (0.9, 1600)]


def test_frames_snr_and_speech(spark):
    x = [0.001] * 100 + [0.5] * 100 + [0.3] * 7
    r = spark.createDataFrame([(x,), ([],), (None,)], "x array<float>").select(audio.frames(F.col("x"), 10).alias("e")).select("e", audio.snr(F.col("e")).alias("s")).collect()
    assert len(r[0]["e"]) == 20 and r[0]["s"] == round(10 * np.log10((0.25 + 1e-10) / (1e-6 + 1e-10)), 1)
    assert r[1]["s"] is None
    p = [0.1, 0.6, 0.9, 0.4, 0.2, 0.9] + [0.1] * 8 + [0.9] * 2 + [0.1] * 9 + [0.8] * 5
    spans = spark.createDataFrame([(p,)], "p array<double>").select(audio.speech_spans(F.col("p"), 0.05).alias("s")).first()["s"]
    assert [(round(s["start_sec"], 2), round(s["end_sec"], 2)) for s in spans] == [(0.05, 0.3), (1.25, 1.5)]


def test_source_lists(spark, tmp_path):
    (tmp_path / "rthk.yaml").write_text("- name: 節目\n  url: http://a\n  domain: news\n- name: none\n- url: http://b\n  status: done\ndownload_config:\n  x: 1\n")
    (tmp_path / "youtube.yaml").write_text("channels:\n  - url: http://c\n    priority: skip\n  - url: http://a\n    name: again\n")
    (tmp_path / "zz.yaml").write_text("a: [")
    got = {r["source_key"]: (r["kind"], r["program"], r["status"], r["priority"]) for r in read_lists(spark, f"file://{tmp_path}").collect()}
    assert got == {"http://a": ("youtube", "again", None, None), "http://b": ("rthk", "", "done", None), "http://c": ("youtube", "", None, "skip")}


def test_traditional_characters(spark):
    df = spark.createDataFrame([("头发发展",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(T.traditional(F.col("t"), {"发": "發", "头": "頭"}, {"头发": "頭髮"})).collect()] == ["頭髮發展", "", None]


def test_unregistered_models_are_refused(spark):
    with pytest.raises(KeyError):
        models.infer(spark.range(1), "none such")


def test_scores_out_of_range_are_no_scores(spark):
    df = spark.createDataFrame([("a", 3.14159, 0.5), ("b", None, 5.0)], "id string, dnsmos_sig double, dnsmos_ovrl double")
    assert [tuple(r)[1:] for r in models.checked_scores(df).orderBy("id").collect()] == [(3.14, None), (None, 5.0)]


@pytest.fixture(scope="module")
def stood_in():
    """Models that need no weights."""
    say = "我哋今日去邊度食飯，好唔好呢"
    frame = lambda f: lambda: lambda b: pd.DataFrame(f(b))
    made = {
        "lang_screen.auto": ("lid_window", lambda b: {"raw_id": np.repeat(b.raw_id, 2), "start_sec": 0.0, "top_labels": [[{"lang": "yue" if i != "r3" else "cmn", "prob": 0.9}] for i in np.repeat(b.raw_id, 2)]}),
        "segment.diarize": ("diarization", lambda b: {"raw_id": np.repeat(b.raw_id, 2), "turn_idx": [0, 1] * len(b), "start_sec": [0.0, 6.0] * len(b), "end_sec": [5.0, 6.5] * len(b), "speaker_tag": "SPEAKER_00"}),
        "asr.transcribe": ("id string, model string, text string, confidence double, metadata string", lambda b: {"id": np.repeat(b.id, 2), "model": ["x", "y"] * len(b), "text": say, "confidence": 0.9, "metadata": None}),
        "label.lang": ("lid", lambda b: {"id": b.id, "lang": "yue", "lang_prob": 0.99, "yue_prob": 0.99, "cmn_prob": 0.0, "top3": "[]"}),
        "label.overlap": ("overlap", lambda b: {"id": b.id, "overlap_ratio": 0.0, "overlap_sec": 0.0, "speech_ratio": 0.9}),
        "label.music": ("tagging", lambda b: {"id": b.id, "music_prob": 0.01, "music_tags": "[]"}),
        "filter.acoustic": ("dnsmos", lambda b: {"id": b.id, "dnsmos_sig": 3.9, "dnsmos_ovrl": 3.8}),
        "align.chars": ("aligner", lambda b: {"id": b.id, "chars": [[{"ch": c, "start_sec": 0.3 * k, "end_sec": 0.3 * k + 0.2} for k, c in enumerate(say.replace("，", ""))] for _ in b.id]}),
        "speaker.embed": ("encoder", lambda b: {"id": b.id, "embedding": [[1.0, 0.0, 0.0]] * len(b)}),
    }
    was, lexicon = dict(models.MODELS), dict(models.RESOURCES)
    for name, (kind, f) in made.items():
        models.register(name, frame(f), kind)
    models.register("label.prosody", models.energy_model(16000), "vad")
    models.RESOURCES["lexicon"] = {"我哋": "ngo5 dei6", "食飯": "sik6 faan6"}
    yield
    models.MODELS.clear()
    models.MODELS.update(was)
    models.RESOURCES.update(lexicon)


def test_a_chain_from_files_to_tiers(spark, tmp_path, stood_in):
    c = Catalog(spark, f"file://{tmp_path}/catalog", TABLES)
    c.ensure()
    rows = []
    for i in range(1, 4):
        (tmp_path / f"r{i}.wav").write_bytes(wav(8.0, 16000, hz=300.0, gap=(2.0, 2.5)))
        rows.append((f"r{i}", f"file://{tmp_path}/r{i}.wav", "rthk", 8.0))
    c.upsert("raw_files", spark.createDataFrame(rows, "raw_id string, wav_path string, source string, duration_sec double"))
    ran = {r["node"]: r["rows"] for r in dag.run_chain(c)}
    assert ran["ingest.probe"] == 3 and ran["lang_screen.auto"] == 3
    assert {r["raw_id"]: r["decision"] for r in c.read("lang_screen").collect()} == {"r1": "pass", "r2": "pass", "r3": "reject"}
    assert ran["segment.diarize"] == 4 and ran["segment.vad_cut"] == 2  # turns of 5 s; those of half a second are no clips
    assert {r["raw_id"] for r in c.read("segments").collect()} == {"r1", "r2"}
    assert c.read("asr_results").count() == 4 and c.read("pregate").count() == 2
    assert {r["tier"] for r in c.read("tiers").collect()} == {"auto_gold"} or ran["filter.acoustic"] == 2
    assert ran["g2p"] == c.read("filters").where("pass").count()
    assert {r["cluster_id"] for r in c.read("speakers").collect()} == {0}
    again = {r["node"]: r["rows"] for r in dag.run_chain(c)}
    assert {n: k for n, k in again.items() if k} == {}
    assert c.verify() == []


def test_a_failed_node_is_journaled(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/catalog", TABLES)
    c.ensure()
    c.upsert("segments", spark.createDataFrame([("a", "file:/none.wav")], "id string, audio_path string"))

    def fails(b):
        raise RuntimeError("no device")

    models.register("label.lang", lambda: fails, "lid")
    try:
        with pytest.raises(Exception, match="no device"):
            dag.run_node(c, "label.lang")
    finally:
        del models.MODELS["label.lang"]
    r = c.read("task_runs").first()
    assert (r["item_id"], r["status"]) == ("a", "error") and "no device" in r["error"]


def test_orphans_and_reingest(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/catalog", TABLES)
    c.ensure()
    (tmp_path / "disk/rthk").mkdir(parents=True)
    for n in ("x", "y"):
        (tmp_path / f"disk/rthk/{n}.wav").write_bytes(wav(0.1))
    nodes.add_recovery(f"file://{tmp_path}/disk")
    try:
        assert dag.run_node(c, "recover.orphans")["rows"] == 2 and dag.run_node(c, "recover.orphans")["rows"] == 0
        assert {(r["source"], r["status"], r["bucket"]) for r in c.read("orphan_segments").collect()} == {("rthk", "pending_delete", "no_signal")}
        assert dag.run_node(c, "recover.reingest_pending")["rows"] == 2 and dag.run_node(c, "recover.reingest_pending")["rows"] == 0
    finally:
        del dag.NODES["recover.orphans"]


def test_embeddings_of_the_table_come_before_files(spark, tmp_path):
    np.save(tmp_path / "e.npy", np.array([0.0, 1.0], np.float32))
    rows = [("a", [1.0, 0.0], f"{tmp_path}/e.npy"), ("b", None, f"{tmp_path}/e.npy"), ("c", None, None), ("d", None, f"{tmp_path}/none.npy")]
    got = {r["id"]: r["embedding"] for r in nodes.embeddings(spark.createDataFrame(rows, "id string, embedding array<float>, embedding_ref string")).collect()}
    assert got == {"a": [1.0, 0.0], "b": [0.0, 1.0], "c": None, "d": None}


def test_assignment_is_to_the_nearest_centroid(spark):
    rng = np.random.default_rng(3)
    rows = [(f"i{k}", f"s{k % 2}", [float(v) for v in rng.normal(size=4)]) for k in range(60)]
    centroids = [(s, k, [float(v) for v in rng.normal(size=4)]) for s in ("s0", "s1") for k in range(5)]
    got = {r["id"]: r["cluster_id"] for r in K.assign(spark.createDataFrame(rows, "id string, source string, embedding array<float>"), spark.createDataFrame(centroids, "source string, cluster_id int, centroid array<float>")).collect()}
    for i, s, x in rows:
        best = max((k for src, k, _ in centroids if src == s), key=lambda k: np.dot(K.unit(np.array([x], np.float32).astype(float)), K.unit(np.array([next(c for src, j, c in centroids if src == s and j == k)], np.float32).astype(float)).T).item())
        assert got[i] == best
