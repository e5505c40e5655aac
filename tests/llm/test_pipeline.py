import corpus_pipeline as C
from tests.llm.test_near_dedup import brute as near
from tests.llm.test_suffix_dedup import brute as passages

TEXT = " ".join(f"word{i % 97} and{i}" for i in range(100))


def rows():
    head = lambda k: " ".join(f"h{k}x{i}" for i in range(60))
    passage = " ".join(f"p{i}" for i in range(70))
    return [(1, TEXT, "en", "s"), (2, TEXT.replace(" ", "  "), "en", "s"), (3, TEXT + " end", "en", "s"), (4, "123 456", "en", "s"), (5, None, None, None), (6, f"{head(6)} {passage} Some tail.", "de", "s"),
            (7, f"{head(7)} é start {passage}", "de", "s"), (8, "a clean text", "fr", "s"), (8, "a clean text", "fr", "s"), (None, "a text without an id", "fr", "s")]


def test_stages(spark, docs):
    df = docs(rows())
    (_, lang), (_, exact), (_, near_), (_, cut), (_, pack) = C.STAGES
    ids = lambda d: sorted((r["doc_id"] or 0) for r in d.collect())
    one = lang(spark, df, "")
    assert one.columns == df.columns and ids(one) == [0, 1, 2, 3, 6, 7, 8, 8]
    two = exact(spark, one, "")
    assert two.columns == df.columns and ids(two) == [0, 1, 3, 6, 7, 8]
    three = near_(spark, two, "")
    want = near([(r["doc_id"] or 0, r["text"]) for r in two.collect()], 5, 80)
    assert three.columns == df.columns and ids(three) == sorted(i for i, (_, c) in want.items() if i == c) == [0, 1, 6, 7, 8]
    four = cut(spark, three, "")
    assert four.columns == df.columns and four.schema == df.schema
    before = {r["doc_id"]: r["text"] for r in three.collect()}
    removed = {i: p[1] for i, p in zip(before, passages(list(before.values()), 200))}
    for r in four.collect():
        assert len(before[r["doc_id"]].encode()) - len(r["text"].encode()) >= removed[r["doc_id"]] > -1
        assert r["n_chars"] == len(r["text"])
    assert removed[6] > 200 and removed[8] == 0
    assert {r["doc_id"] for r in pack(spark, four, "").collect()} == {None, 1, 6, 7, 8}


def test_empty_table(spark, docs):
    df = docs([])
    for _, stage in C.STAGES:
        df = stage(spark, df, "")
    assert df.collect() == []


def test_run(spark, sf_dir):
    assert C.run(spark, sf_dir).count() > 100
