import random
import re
from collections import Counter

import pytest

from corvane.llm.quality_rules import quality_rules
from tests.conftest import DATA


def brute(text):
    x = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", x)
    c = Counter(zip(w, w[1:], w[2:]))
    rep = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in x.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(rep)


def test_base_counts(docs):
    texts = [None, "", " \n\t ", "a", "a b c a b c", "a a a a a", "x\nx\n\n\nx ", "one two three", "🙂 é # $ | <>", "a b c\x1cd", "\n".join(["same line here"] * 30), "word " * 3000 + "end"]
    got = {r["doc_id"]: r for r in quality_rules(docs(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        e = brute(t)
        assert tuple(got[i][k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == e, t
        assert got[i]["base_failed"] == (e[0] < 50 or 100 * e[4] > 50 * e[0])
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_outliers_go_and_clean_texts_stay(spark):
    d = DATA.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = [r for r in quality_rules(docs).collect() if not r["base_failed"] and r["doc_id"] in labels]
    kept = {q: [r["kept"] for r in got if labels[r["doc_id"]] == q] for q in (0, 1)}
    assert sum(kept[1]) >= 0.99 * len(kept[1])
    assert sum(kept[0]) <= 0.3 * len(kept[0])


def test_small_and_null_groups_have_a_result(docs):
    text = " ".join(f"w{i}" for i in range(60))
    got = quality_rules(docs([(1, text, "en", None), (2, text, None, None), (3, text, None, "s"), (3, text, None, "s")])).collect()
    assert [r["kept"] for r in got] == [True] * 4


def test_few_rows_are_judged_by_a_wider_estimate(docs):
    draw = random.Random(5)
    plain = lambda: " ".join("".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9))) for _ in range(80)) + "."
    odd = lambda: plain().replace(" ", " #%*& ")
    rows = [(k, plain(), "en", "large") for k in range(250)]
    few = [(lang, source) for lang in ("en", "fr", None) for source in ("a", None)]
    rows += [(1000 + 10 * i + k, odd() if k == 0 else plain(), *g) for i, g in enumerate(few) for k in range(4)]
    got = {r["doc_id"]: r for r in quality_rules(docs(rows)).collect()}
    assert len(got) == len(rows) and all(r["distance"] is not None for r in got.values())
    assert [got[1000 + 10 * i]["kept"] for i in range(len(few))] == [False] * len(few)
    assert all(got[1000 + 10 * i + k]["kept"] for i in range(len(few)) for k in (1, 2, 3))


def test_empty_table(docs):
    assert quality_rules(docs([])).collect() == []


@pytest.mark.parametrize("n", [4, 5, 6, 7, 8, 63, 64, 65, 1000])
def test_positions_have_room(docs, n):
    text = " ".join(f"w{i % (n - 1)}" for i in range(n))
    r = quality_rules(docs([(1, text + " " + text)])).first()
    assert r["n_repeat_words"] == brute(text + " " + text)[4]
