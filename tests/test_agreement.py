"""The ratio of two texts is difflib's, and takes the time of their differences."""

import random
import time
from difflib import SequenceMatcher

import pytest

from corvane.functions import agreement as A
from corvane.plans import registry

SIGNS = ["ab", "abcdefgh ", "etaoin shrdlu cmfw" * 3 + "0123456789éüß中文字,.", "".join(chr(0x4E00 + i) for i in range(300))]


def variants(pick, signs, n):
    weights = [pick.random() ** 3 + 0.001 for _ in signs]
    drawn = lambda k: "".join(pick.choices(signs, weights, k=pick.randrange(k + 1)))
    a = b = drawn(n)
    for _ in range(pick.randrange(12)):
        i = pick.randrange(len(b) + 1)
        b = b[:i] + drawn(8) + b[i + pick.randrange(9) :]
    return a, pick.choice([b, b, drawn(n), b[len(b) // 3 :] + b[: len(b) // 3]])


@pytest.mark.parametrize("signs", SIGNS)
def test_ratio(signs):
    pick = random.Random(len(signs))
    for n in (5, 30, 199, 210, 400, 900):
        for _ in range(40):
            a, b = variants(pick, signs, n)
            assert A.ratio(a, b) == SequenceMatcher(None, a, b).ratio()


def test_ratio_of_a_long_text():
    """A change at every hundredth character of 60,000."""
    pick = random.Random(3)
    words = ["".join(pick.choices("etaoinshrldcu", k=pick.randrange(2, 9))) for _ in range(400)] + ["quiz", "jinx"]
    a = " ".join(pick.choices(words, [50] * 400 + [1] * 2, k=12_000))
    b = "".join("#" if k % 100 == 50 else c for k, c in enumerate(a))
    begin = time.monotonic()
    got = A.ratio(a, b)
    took = time.monotonic() - begin
    begin = time.monotonic()
    assert got == SequenceMatcher(None, a, b).ratio()
    assert took < (time.monotonic() - begin) / 4


def test_agreement_row_of_long_texts(spark, tmp_path):
    """Eight texts of some 200,000 characters, with a "th" in every sixty or so, which a result has otherwise."""
    pick = random.Random(4)
    words = ["".join(pick.choices("aeoinsrldcu", k=pick.randrange(2, 9))) for _ in range(400)] + ["quiz", "jinx"]
    docs = [(i, " ".join(pick.choices([*words, "the"], [1] * 402 + [45], k=34_000)), "en", "s", 0) for i in (2, 3, 5, 6, 7, 10, 13, 14)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    begin = time.monotonic()
    rows = registry.QUERIES["agreement_row"](spark, str(tmp_path)).collect()
    assert len(rows) == 8 and all(0 < r["agreement"] < 1 for r in rows)
    assert time.monotonic() - begin < 40
