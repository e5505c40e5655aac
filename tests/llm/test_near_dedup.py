import random
from itertools import combinations

import numpy as np
import pytest

from corvane.llm import near_dedup as N

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text, width):
    w = (text or "").encode().translate(LOWER).split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def run(df, **k):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(df, **k).collect()}


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_stars_chains_and_clean_texts(docs, width, percent):
    """A group around one text whose members are mostly not similar to each other, copies of copies, and texts of their own."""
    rng = random.Random(width)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, edited(base, rng.randrange(0, 9), rng)) for i in range(60)]
    chain = [f"c{i}" for i in range(120)]
    for i in range(60, 75):
        rows.append((i, " ".join(chain)))
        chain = edited(chain, 2, rng).split()
    rows += [(i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(80))) for i in range(75, 95)]
    rows += [(200, rows[3][1].upper()), (201, None), (202, ""), (203, " \n "), (204, "one two"), (205, "ONE  two"), (206, "one")]
    assert run(docs(rows), width=width, percent=percent) == brute(rows, width, percent)


def test_empty_table_and_repeated_rows(docs):
    assert run(docs([])) == {}
    got = N.near_duplicates(docs([(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (None, "x y z")])).collect()
    assert sorted((r["doc_id"] or 0, r["kept"]) for r in got) == [(0, True), (1, True), (1, True), (2, False)]


def test_signatures_estimate_similarity():
    a = np.unique(N._mix(np.arange(3000, dtype=np.uint64)))
    b = np.unique(N._mix(np.arange(300, 3300, dtype=np.uint64)))
    rows = 2
    same = np.mean([N.signature(a, rows) == N.signature(b, rows)])
    assert abs(same - (2700 / 3300) ** 2) < 0.25


def test_components(spark):
    from corvane.llm.common import Cuts

    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (-5, 100), (7, 7)]
    got = {r["node"]: r["label"] for r in N.components(spark.createDataFrame(edges, "u long, v long"), Cuts(spark), "t").collect()}
    assert {got[k] for k in range(1, 41)} == {1} and {got[k] for k in (100, 101, -5)} == {-5}


def test_inside_is_what_arithmetic_allows(spark):
    """Pairs of one path are asked for exactly where the bound allows the similarity."""
    rng = random.Random(4)
    members = [(1, c, n, rng.randrange(n // 2, n + 1), c % 5, 0, [n], [1]) for c, n in ((c, rng.randrange(5, 60)) for c in range(80))]
    df = spark.createDataFrame(members, "path long, c long, n long, both long, label long, label_l long, h array<int>, first array<long>")
    got = {(r["a"], r["b"]) for r in N._inside(df, 80).collect()}
    for x, y in combinations(members, 2):
        able = x[4] != y[4] and min(x[3], y[3]) >= 0.8 / 1.8 * (x[2] + y[2]) - 1e-6 and 100 * min(x[2], y[2]) >= 80 * max(x[2], y[2])
        assert ((max(x[1], y[1]), min(x[1], y[1])) in got) == able, (x, y)


def excerpts(spark, many):
    """Sets inside one much larger pivot: every window of 40 of its shingles at steps of 5, each a component of its own."""
    pivot = np.sort(N._mix(np.arange(5 * many + 60, dtype=np.uint64)))
    order = np.random.default_rng(1).permutation(len(pivot))
    sets = {k: np.sort(pivot[order[5 * k : 5 * k + 40]]) for k in range(many)}
    h = lambda x: np.bincount((x & np.uint64(N.PARTS - 1)).astype(int), minlength=N.PARTS).tolist()
    full = spark.createDataFrame([(k, x.tobytes(), h(x)) for k, x in {**sets, -1: pivot}.items()], "c long, s binary, h array<int>")
    members = spark.createDataFrame([(0, k, 40, -1, k, -1, x.tobytes(), b"") for k, x in sets.items()], "path long, c long, n long, l long, label long, label_l long, own binary, inn binary")
    return sets, full, N._outside(members, full, 80).join(full.select("c", "h"), "c")


def test_inside_finds_all_similar_excerpts(spark):
    sets, _, members = excerpts(spark, 100)
    want = {(max(a, b), min(a, b)) for a, b in combinations(sets, 2) if 100 * len(set(sets[a]) & set(sets[b])) >= 75 * len(set(sets[a]) | set(sets[b]))}
    got = {(r["a"], r["b"]) for r in N._inside(members, 75).collect()}
    assert want and want <= got and got == got & {(max(a, b), min(a, b)) for a, b in combinations(sets, 2) if abs(a - b) < 8}


def test_pairs_inside_a_pivot_grow_with_the_members(spark):
    counts = [N._inside(excerpts(spark, n)[2], 80).count() for n in (100, 200, 400)]
    assert counts[2] < 2.3 * counts[1] < 5 * counts[0] + 50


def test_excerpts_of_one_long_text(docs):
    rng = random.Random(7)
    words = [f"w{rng.randrange(10**6)}" for _ in range(900)]
    rows = [(0, " ".join(words))] + [(k, " ".join(words[4 * k : 4 * k + 80])) for k in range(1, 200)]
    assert run(docs(rows)) == brute(rows, 5, 80)


def test_recall_at_lower_similarities():
    """Share of pairs that meet in a band, at the least similarity of each setting."""
    rng = np.random.default_rng(5)
    for percent in (50, 60, 70, 80, 85, 90):
        rows, met = N.rows_of(percent), 0
        for _ in range(60):
            x = np.unique(rng.integers(0, 1 << 63, 600, dtype=np.uint64))
            both = int(len(x) * 2 * percent / (100 + percent))
            y = np.unique(np.concatenate([x[:both], rng.integers(0, 1 << 63, len(x) - both, dtype=np.uint64)]))
            met += bool((N.signature(np.sort(N._mix(x)), rows) == N.signature(np.sort(N._mix(y)), rows)).any())
        assert met >= 58, (percent, met)
    with pytest.raises(ValueError):
        N.rows_of(30)


def test_sets_that_share_one_hash_are_kept_apart(spark):
    signed = [(1, 1, 5, 7, 1, [1]), (2, 2, 5, 7, 2, [2]), (3, 3, 5, 9, 3, [3])]
    got = N._classes(spark.createDataFrame(signed, "id long, row long, n long, c long, d long, bands array<long>")).collect()
    assert {(r["c"], r["k"], r["d"] != r["d_hi"]) for r in got} == {(7, 2, True), (9, 1, False)}
