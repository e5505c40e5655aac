"""The edit distance of whole texts against brute force, and in time on long ones."""

import random
import time

from corvane.functions import distance as D
from corvane.plans import registry


def brute(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_distance():
    pick, wide = random.Random(1), "".join(chr(0x4E00 + i) for i in range(400))
    for _ in range(600):
        signs = pick.choice(["ab", "abcde", "é🙂中a", wide])
        a = b = "".join(pick.choices(signs, k=pick.randrange(60)))
        if pick.random() < 0.3:
            b = "".join(pick.choices(signs, k=pick.randrange(60)))
        for _ in range(pick.randrange(8)):
            i = pick.randrange(len(b) + 1)
            b = b[:i] + "".join(pick.choices(signs, k=pick.randrange(3))) + b[i + pick.randrange(3) :]
        want = brute(a, b)
        assert D.distance(a, b) == D.any_distance(a, b) == want
        assert [D.near_distance(a, b, k) for k in (want, want + 3)] == [want, want]
        assert not want or D.near_distance(a, b, want - 1) is None
    long = "".join(pick.choices(wide, k=600))
    assert D.distance(long, long[:100] + long[110:300] + "x" + long[300:]) == 11


def test_edit_distance_of_long_texts(spark, tmp_path):
    """Each text of 200,000 characters has 50 times "th", which becomes a letter that it has nowhere: 2 edits each."""
    pick, docs = random.Random(2), []
    for i in range(1, 5):
        part = lambda: "".join(pick.choices("abcefg \n", k=4000))
        docs.append((i, "th".join(part() for _ in range(51)), "en", "s", 0))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(1, 5)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    begin = time.monotonic()
    assert [tuple(r) for r in registry.QUERIES["edit_distance"](spark, str(tmp_path)).collect()] == [(4, 100.0)]
    assert time.monotonic() - begin < 30
