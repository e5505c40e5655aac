import random
from difflib import SequenceMatcher
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvane.functions import agreement as A
from corvane.functions import pause as P
from corvane.functions import text as T
from corvane.functions.models import halving
from corvane.functions.rounding import py_round
from corvane.operators import gates as G
from corvane.operators import manifest as M
from corvane.operators import review as R
from corvane.operators import segmentation as S
from corvane.operators import speakers as K


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items())).select(column).first()[0]


@pytest.mark.parametrize("text,ratio,lang", [("", 0.0, "eng"), ("我哋今日去邊度食飯好呢", 0.0, "yue"), ("hello world", 1.0, "eng"), ("我哋 go 喇", 0.25, "yue"), ("这们说时会", 0.0, "cmn"), ("don't 係", 0.5, "mixed")])
def test_text_features(spark, text, ratio, lang):
    r = T.language_features(spark.createDataFrame([(text,)], "t string"), "t").select("f_eng", T.detected_language().alias("lang"), T.mandarin_ratio().alias("m")).first()
    assert (r["f_eng"], r["lang"]) == (ratio, lang)
    assert (r["m"] > 0.15) == (lang == "cmn")


def test_gates_in_order(spark):
    rows = [("rate", None, 5.0, "係" * 6), ("long", 48000, 20.1, "係" * 6), ("edge", 48000, 20.0, "係" * 6), ("short", 48000, 3.0, "係" * 4), ("chars", 48000, 5.0, "係" * 151), ("none", 48000, None, "係" * 6), ("null", 48000, 5.0, None), ("english", 48000, 5.0, "係" * 6 + " a b c")]
    df = spark.createDataFrame(rows, "id string, sample_rate int, duration_sec double, best_text string").withColumn("model_count", F.lit(2))
    got = {r["id"]: r["fail_reason"] for r in G.filter_text(df).collect()}
    assert got == {"rate": "sample_rate", "long": "duration", "edge": None, "short": "text_too_short", "chars": "text_too_long", "none": "duration", "null": "text_too_short", "english": "english_ratio"}


@pytest.mark.parametrize("verified,agreement,dnsmos,tier", [(True, 0.0, None, "gold"), (False, 0.92, 3.5, "auto_gold"), (False, 0.92, None, "silver"), (False, 0.85, 1.0, "silver"), (False, 0.70, 1.0, "bronze"), (False, 0.69, 5.0, "excluded"), (None, None, 5.0, "excluded")])
def test_tiers(spark, verified, agreement, dnsmos, tier):
    df = spark.createDataFrame([(verified, agreement, dnsmos)], "text_verified boolean, agreement double, dnsmos double")
    assert df.select(G.tier()).first()[0] == tier


def test_agreement_is_difflib(spark):
    rng = random.Random(0)
    texts = [["".join(rng.choice("係冇佢ab，12") for _ in range(rng.choice([5, 250]))) for _ in range(rng.choice([1, 2, 3, 4]))] for _ in range(30)]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t array<string>").orderBy("i").select(A.char_agreement(F.col("t"))).collect()]
    for t, g in zip(texts, got):
        r = [SequenceMatcher(None, a, b).ratio() for a, b in combinations(t, 2)]
        assert g == (round(sum(r) / len(r), 3) if r else 1.0)


def test_agreement_rows(spark):
    rows = [("a", "m1", "一二", 0.5), ("a", "m2", "12", 0.5), ("b", "m1", "", 0.9), ("b", "m2", "x", 0.1), ("c", "m1", "x", 0.1), ("d", "m1", "x", 0.2), ("d", "old", "y", 0.9)]
    got = {r["id"]: (r["agreement"], r["best_text"], r["model_count"]) for r in A.agreement_rows(spark.createDataFrame(rows, "id string, model string, text string, confidence double"), retired=("old",)).collect()}
    assert got == {"a": (1.0, "一二", 2), "b": (0.0, "x", 2), "d": (0.0, "x", 2)}


def test_agreement_counts_texts_as_they_came(spark):
    """Three texts that are not empty, of which one has nothing but a mark: it agrees with none."""
    rows = [("e", f"m{k}", t, 0.5) for k, t in enumerate(["。", "你好", "你好"])] + [("f", "m0", "。", 0.9), ("f", "m1", "", 0.99), ("g", "m0", None, None), ("g", "m1", "x", None)]
    got = {r["id"]: (r["agreement"], r["best_text"]) for r in A.agreement_rows(spark.createDataFrame(rows, "id string, model string, text string, confidence double")).collect()}
    assert got == {"e": (0.333, "。"), "f": (0.0, "。"), "g": (0.0, "x")}


def test_models_are_resolved(spark):
    rows = [("a", "/new/ft+zh", "一二", None), ("a", "/old/ft+zh", "三", 0.99), ("a", "sv", "一二", 0.4), ("a", "who knows", "x", 1.0), ("a", "retired", "y", 1.0), ("b", "/old/ft+zh", "三", 0.9), ("b", "who knows", "四", 0.9)]
    models = {"/new/ft+zh": "ft", "/old/ft+zh": "ft", "sv": "sv", "retired": "v3"}
    df = A.agreement_rows(spark.createDataFrame(rows, "id string, model string, text string, confidence double"), retired=("v3",), models=models, current={"ft": "/new/ft+zh"}, primary="ft")
    got = {r["id"]: (r["agreement"], r["best_text"], r["model_count"], r["canto_ft_confidence"]) for r in df.collect()}
    assert got == {"a": (1.0, "一二", 5, 0.0), "b": (0.0, "", 2, None)}


CHARS = ("你好嗎", (0.0, 0.3, 1.0), (0.2, 0.5, 1.2))


@pytest.mark.parametrize("text,kinds", [("你好嗎", []), ("，你好嗎", ["leading_tail"]), ("你,好嗎。", ["normal", "trailing_tail"]), ("你好。嗎.", ["normal"]), ("你好…嗎", []), ("你好", None), ("", None)])
def test_pause_walk(text, kinds):
    events, bad = P.walk(text, *CHARS, 2.0)
    assert bad == (kinds is None) and [e["kind"] for e in events] == (kinds or [])


def one_by_one(text, chars, starts, ends, duration):
    """The walk, a character at a time."""
    at, out = 0, []
    for offset, c in enumerate(text):
        if at < len(chars) and c == chars[at]:
            at += 1
        elif c in ",?!;:，。、；：？！":
            kind = "leading_tail" if at == 0 else "trailing_tail" if at >= len(chars) else "normal"
            delta = {"leading_tail": None, "trailing_tail": round(duration - ends[-1], 4) if len(ends) else None, "normal": round(starts[at] - ends[at - 1], 4) if 0 < at < len(chars) else None}[kind]
            out.append((offset, kind, delta))
    return ([], True) if at != len(chars) else (out, False)


@settings(max_examples=400, deadline=None)
@given(st.text("ab,。 x:", max_size=25), st.text("ab,x", max_size=8), st.booleans())
def test_pause_walk_is_the_walk_by_characters(text, chars, own):
    chars = "".join(c for c in text if c in "abx") if own else chars
    starts = [0.5 * k + 0.1 * (k % 3) for k in range(len(chars))]
    ends = [s + 0.2 for s in starts]
    events, bad = P.walk(text, chars, starts, ends, 30.0)
    assert ([(e["offset"], e["kind"], e["delta_t"]) for e in events], bad) == one_by_one(text, chars, starts, ends, 30.0)


def test_pause_plan_and_preview(spark):
    df = spark.createDataFrame([("，你，好嗎。", [("你", 0.0, 0.2), ("好", 0.3, 0.5), ("嗎", 1.0, 1.2)], 2.0), (None, None, None), ("。", [], None)], "t string, c array<struct<ch:string,start_sec:double,end_sec:double>>, d double")
    rows = df.select(P.pause_plan(F.col("t"), F.col("c"), F.col("d")).alias("p"), P.preview(F.col("t"), F.col("c"), F.col("d")).alias("q")).collect()
    assert [(e["kind"], e["delta_t"], e["verdict"]) for e in rows[0]["p"]["plan"]] == [("leading_tail", None, None), ("normal", 0.1, "no_pause"), ("trailing_tail", 0.8, None)]
    assert [(e["t_start"], e["t_end"]) for e in rows[0]["q"]["plan"]] == [(0.0, 0.0), (0.2, 0.3), (1.2, 2.0)]
    assert rows[1]["p"]["plan"] == [] and not rows[1]["p"]["unalignable"] and rows[2]["p"]["plan"][0]["kind"] == "leading_tail"


def test_pause_verdicts_and_tokens(spark):
    events, _ = P.walk("你，好。嗎！", *CHARS, 2.0)
    assert [(e["delta_t"], e["verdict"]) for e in events] == [(0.1, "no_pause"), (0.5, "long"), (0.8, None)]
    keep = ("offset", "mark", "kind", "delta_t", "verdict")
    df = spark.createDataFrame([("你，好。嗎！", [tuple(e[k] for k in keep) for e in events])], f"t string, plan {P.PLAN}")
    assert df.select(P.text_pause(F.col("t"), F.col("plan"))).first()[0] == "你好。<pause-long>嗎！"
    assert df.select(P.text_pause(F.lit("你x好"), F.col("plan"))).first()[0] == "你x好"


def test_slugs_keep_every_script(spark):
    titles = ["香港電台 節目一", "  Été - À_la  carte!", "a" * 60, "", None, "第\u3000二 (2)", "...", "İstanbul №5"]
    import re

    slow = lambda t: re.sub(r"[\s_-]+", "_", re.sub(r"[^\w\s-]", "", t.lower())).strip("_")[:40]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, t string").orderBy("i").select(T.slugify(F.col("t")))
    got = [r[0] for r in df.collect()]
    assert got[:7] == [slow(t or "") for t in titles[:7]]


def test_python_rounding(spark):
    values = [2.675, 0.125, 1.005, -0.5, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i")
    assert [r[0] for r in df.select(py_round(F.col("v"), 2)).collect()] == [None if v is None else round(v, 2) for v in values]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=40))
def test_split_has_no_leak(spark, pairs):
    rows = [(f"{i:03d}", f"s{a % 2}", f"p{b}") for i, (a, b) in enumerate(pairs)]
    got = M.split(spark.createDataFrame(rows, "id string, source string, speaker_id string"), share=0.3).collect()
    side = {}
    for r in got:
        side.setdefault((r["source"], r["speaker_id"]), set()).add(r["split"])
    assert len(got) == len(rows) and all(len(v) == 1 for v in side.values())
    for s in {r[1] for r in rows}:
        order = list(dict.fromkeys(p for _, src, p in sorted(rows) if src == s))
        val = order[-max(1, int(len(order) * 0.3)) :]
        assert {p for (src, p), v in side.items() if src == s and v == {"val"}} == set(val)


def test_clusters_are_average_linkage():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 8)) + np.repeat(np.eye(8)[:4] * 4, 10, axis=0)

    def slow(x):
        d = 1 - K.unit(x) @ K.unit(x).T
        groups = [[i] for i in range(len(x))]
        while len(groups) > 1:
            best = min((np.mean([d[i, j] for i in a for j in b]), k, m) for k, a in enumerate(groups) for m, b in enumerate(groups) if k < m)
            if not best[0] < 0.25:
                break
            groups[best[1]] += groups.pop(best[2])
        return {frozenset(g) for g in groups}

    label = K.average_linkage(x)
    assert {frozenset(np.flatnonzero(label == k)) for k in set(label)} == slow(x)


def test_window_starts(spark):
    got = spark.createDataFrame([(d,) for d in (None, 0.0, 10.0, 40.0, 1000.0)], "d double").select(S.window_starts(F.col("d"))).collect()
    assert [len(r[0]) for r in got] == [0, 0, 1, 1, 10]
    assert got[3][0] == [7.5] and got[4][0][0] == 82.5 and got[4][0] == sorted(got[4][0])


def test_halving():
    import pandas as pd

    def forward(b):
        if len(b) > 3:
            raise MemoryError
        return b * 2

    assert halving(forward, pd.DataFrame({"x": range(10)})).x.tolist() == [2 * i for i in range(10)]


def test_recommended_n():
    assert (R.recommended_n(1000, 0.05, 30), R.recommended_n(100, 0.05, 30), R.recommended_n(1000, 0.05, 30, True), R.recommended_n(100, 0.2, 30, True)) == (50, 30, 500, 100)


def test_cuts_are_refused(spark):
    with pytest.raises(ValueError):
        M.at_or_above(G.TIERS, "excluded")
