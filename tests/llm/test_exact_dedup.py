import hashlib
import re

from corvane.llm.exact_dedup import exact_duplicates


def brute(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in rows}
    groups = {}
    for i, t in norm.items():
        groups.setdefault(t, []).append(i)
    return {i: (min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm.items()}


def run(df, **k):
    return {r["doc_id"]: tuple(r)[1:] for r in exact_duplicates(df, digest=True, **k).collect()}


def test_white_space_nulls_and_long_texts(docs):
    long = "word " * 50_000
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (1, None), (2, ""), (4, long), (8, long + " "), (7, " a b"), (6, long[:-1] + "x"), (10, "é b"), (11, "é b")]
    assert run(docs(rows)) == brute(rows)


def test_any_bitmap_gives_the_same(docs):
    rows = [(i, "t" * (i % 7)) for i in range(60)]
    assert run(docs(rows), bitmap_bits=1 << 15) == run(docs(rows), prefix_chars=1) == brute(rows)


def test_empty_table_and_repeated_rows(docs):
    assert run(docs([])) == {}
    got = exact_duplicates(docs([(1, "x"), (1, "x"), (2, "x"), (None, "y")])).collect()
    assert sorted((r["doc_id"] or 0, r["kept"], r["group_size"]) for r in got) == [(0, True, 1), (1, True, 3), (1, True, 3), (2, False, 3)]
