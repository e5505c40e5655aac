import numpy as np

from corvane.llm import language_id as L
from corvane.llm import quality_classifier as Q
from tests.conftest import DATA


def test_kernel_is_presence_of_ngrams():
    x = np.zeros(L.BUCKETS, np.uint8)
    assert L.presence("Ab, ab!", x)
    y = np.zeros(L.BUCKETS, np.uint8)
    L.presence("ab ab", y)
    assert (x == y).all() and x.sum() == len({s[i : i + n] for s in [" ab ab "] for n in (1, 2, 3, 4) for i in range(len(s) - n + 1)})


def test_long_texts_in_parts(monkeypatch):
    text = "é quick brown fox, " * 30_000
    x, y = np.zeros(L.BUCKETS, np.uint8), np.zeros(L.BUCKETS, np.uint8)
    L.presence(text, x)
    L.presence("é quick brown fox, " * 3, y)
    assert (x == y).all()


def test_weights_are_the_nystrom_model():
    """The weights per bucket give the same scores as kernels to landmarks and ridge regression written out."""
    rng = np.random.default_rng(1)
    x = (rng.random((40, L.BUCKETS)) < 0.002).astype(np.uint8)
    y = np.arange(40) % 2
    unit = x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    k = unit @ unit.T
    w = L.fit(x, y, 2)
    turn = np.argsort(np.arange(40) // 2 * 2 + y, kind="stable")
    marks = k[np.ix_(turn, turn)]
    e, v = np.linalg.eigh(marks)
    phi = k[:, turn] @ (v * (1 / np.sqrt(e))) @ v.T
    target = np.eye(2)[y]
    ridge = np.linalg.solve(phi.T @ phi + L.RIDGE * np.eye(40), phi.T @ target)
    assert np.allclose(unit @ w, phi @ ridge, atol=1e-3)


def test_language_edges(docs):
    train = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog of it", "en"), ("der hund und die katze ist", "de"), (None, "en"), ("ohne", None)] * 5)]
    rows = [(100, None), (101, ""), (102, "123 !!"), (103, "the dog and the cat"), (104, "die katze und der hund"), (104, "die katze und der hund")]
    got = {r["doc_id"]: r for r in L.language_id(docs(rows), train=docs(train)).collect()}
    assert [got[k]["lang_pred"] for k in (100, 101, 102, 103, 104)] == ["und", "und", "und", "en", "de"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert L.language_id(docs([])).collect() == []
    assert L.language_id(docs(rows)).first()["lang_pred"] == "und"  # nothing to learn from


def test_held_out_accuracy(spark):
    d = DATA.replace("0.001", "0.01")
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = [r for r in L.op1_language_id(spark, d).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in got) >= 0.98 * len(got)


def many_languages(n):
    """Two rows to learn and one to tell of each of n languages; each has its own words of 3 of 20 letters."""
    rng = np.random.default_rng(3)
    train, rows = [], []
    for k in range(n):
        words = ["".join(rng.choice(list("abcdefghijklmnoprstu"), 3)) for _ in range(12)]
        say = lambda: " ".join(rng.choice(words, 40))  # noqa: E731, B023
        train += [(f"{k}-{i}", say(), f"l{k:03}") for i in range(2 + (k < 70))]
        rows.append((k, say(), f"l{k:03}"))
    return train, rows


def test_every_language_is_learned(spark):
    train, rows = many_languages(90)
    table = spark.createDataFrame([(i, t, lang) for i, (_, t, lang) in enumerate(train)], "doc_id long, text string, lang string")
    got = L.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string"), train=table).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {k: lang for k, _, lang in rows}


def test_each_language_has_a_landmark(monkeypatch):
    monkeypatch.setattr(L, "MOST_LANDMARKS", 8)
    train, rows = many_languages(40)
    x = np.zeros((len(train) + len(rows), L.BUCKETS), np.uint8)
    for (_, t, _), into in zip(train + rows, x):
        L.presence(t, into)
    y = np.array([int(lang[1:]) for _, _, lang in train])
    for learned in (x[: len(train)], np.packbits(x[: len(train)], axis=1)):
        assert (x[len(train) :].astype(np.float32) @ L.fit(learned, y, 40)).argmax(1).tolist() == list(range(40))


def test_sum_of_squares_is_all_pairs():
    rng = np.random.default_rng(2)
    w, v = rng.random(Q.WIDTH), rng.random((Q.WIDTH, Q.FACTORS))
    at, x = Q.features("some words and some more of them", 30)
    pairs = sum(v[a] @ v[b] * xa * xb for i, (a, xa) in enumerate(zip(at, x)) for b, xb in zip(at[i + 1 :], x[i + 1 :]))
    assert np.isclose(Q.pair_score(at, x, np.array([0]), 0.5, w, v)[0], 0.5 + w[at] @ x + pairs)


def test_quality_edges(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    rows = [(1, "good words here"), (2, "bad bad bad"), (4, None), (5, ""), (5, "")]
    got = Q.quality_scores(docs(rows), labels).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert {r["score"] for r in Q.quality_scores(docs(rows), labels.where("false")).collect()} == {0.5}
    assert Q.quality_scores(docs([]), labels).collect() == []


def test_held_out_quality(spark):
    d = DATA.replace("0.001", "0.01")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = [r for r in Q.op4_quality_classifier(spark, d).collect() if r["held_out"] and r["doc_id"] in labels]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in got) >= 0.95 * len(got)
