"""Queries without SQL go over whole texts: against brute force on a fixture of long ones."""

import unicodedata
from difflib import SequenceMatcher
from itertools import combinations

import pytest

from corvane.plans import registry

WORDS = "the other weather thunder father é 7, either\nearth".split(" ")
TEXTS = [None, "", "the", "x" * 70, *(" ".join(WORDS[(i * k + k) % len(WORDS)] for k in range(20 * i)) for i in range(1, 12))]


@pytest.fixture(scope="module")
def long_texts(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("long"))
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    return d


def read(t, lexicon):
    out, at = [], 0
    while at < len(t):
        found = next((n for n in range(3, 0, -1) if t[at : at + n] in lexicon), 0)
        out += [lexicon[t[at : at + found]]] if found else []
        at += found or 1
    return " ".join(out)


def test_g2p_stub(spark, long_texts):
    got = {r["doc_id"]: r["reading"] for r in registry.QUERIES["g2p_stub"](spark, long_texts).collect()}
    lexicon = {"th": "t6", "er": "o1", "the": "di1"}
    assert got == {i: None if t is None else read(t, lexicon) for i, t in enumerate(TEXTS)}


def results(i, t):
    """The model, text and confidence of each result of a document."""
    out = [("alpha", t, i * 17 % 100 / 100)]
    out += [("beta", "" if i % 9 == 0 else t and t.replace("th", "d"), i * 19 % 100 / 100)] if i % 10 != 1 else []
    return out + ([("gamma", t and t.replace("en", "em"), 1.0)] if i % 4 == 0 else [])


def bare(t):
    return "".join(c for c in (t or "").translate(str.maketrans("0123456789", "零一二三四五六七八九")) if unicodedata.category(c)[0] != "P")


def ratio(texts):
    r = [SequenceMatcher(None, a, b).ratio() for a, b in combinations(texts, 2)]
    return round(sum(r) / len(r), 3) if r else 1.0


def test_char_agreement(spark, long_texts):
    got = {r["id"]: r["agreement"] for r in registry.QUERIES["char_agreement"](spark, long_texts).collect()}
    assert got == {f"s{i}": ratio([bare(x) for _, x, _ in results(i, t)]) for i, t in enumerate(TEXTS)}


def test_agreement_row(spark, long_texts):
    want = {}
    for i, t in enumerate(TEXTS):
        if len(results(i, t)) >= 2:
            kept = [r for r in results(i, t) if r[0] != "gamma"]
            said = [b for _, x, _ in kept if (b := bare(x))]
            best = max((r for r in kept if r[1]), key=lambda r: r[2], default=("", "", 0))[1]
            want[f"s{i}"] = (ratio(said) if len(said) >= 2 else 0.0, best, len(results(i, t)))
    rows = registry.QUERIES["agreement_row"](spark, long_texts).collect()
    assert {r["id"]: (r["agreement"], r["best_text"], r["model_count"]) for r in rows} == want
    assert max(len(r["best_text"]) for r in rows) > 200
