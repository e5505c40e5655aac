"""Near duplicates by min-max hashing, confirmed on full shingle sets, and their connected components.

Each permutation of the shingle hashes gives its minimum and its maximum, so a signature takes half the evaluations of
one of minima alone; both match with the probability of the similarity. Bands of signature values make buckets.

Texts with one shingle set are one class. Classes that share a bucket are compared with its pivot, the class of its surroundings
that shares the most buckets with others, in pairs that grow with the members and not with their square. In a bucket
that then still holds more than one component, two members can be similar in two ways only:

- they share a shingle outside the pivot's set: members go into a new, much smaller bucket for each such shingle, and
  those are treated in the same way (with a member as pivot, and what is outside all pivots so far), level after level,
  until no bucket of several components is left;
- they share shingles of the pivots only, so no more than the smaller of the two numbers that each has of these. Members that are
  not of the pivot's component are compared with those that this allows: of a fitting size, and sharing one of the shingles of the
  pivots that come first in each (a pair that is similar must).

A bucket of at most SMALL members has its pairs of two components compared at once. So no pair of a bucket is passed over, and none of a large one is
compared that need not be. A level compares all its pairs in one pass. Only counts come to the driver.

Sets are computed again from the text, and kept, for classes that share a bucket with another only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import Cuts, keeps, maybe_in, ship, table, whole

WIDTH, PERCENT = 5, 80
BANDS = 32
#: In a bucket of so many members each is compared with each; larger ones go by pivots.
#: After the first level buckets hold what pivots have left, and so many are compared.
SMALL, SMALL_LATER = 8, 64
#: Counts of a set's shingles by parts of their hashes bound how many two sets share.
PARTS = 64
CACHE_WORDS = 300_000
_words: dict[bytes, int] = {}
_ALL = (1 << 64) - 1
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_rng = np.random.default_rng(8)
_XOR = _rng.integers(0, 1 << 63, 4096, dtype=np.uint64)
_MULTIPLY = _rng.integers(0, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h):
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def rows_of(percent: int) -> int:
    """Signature values a band, an even number: a pair at the least similarity is missed about once in a million times with 32 bands.

    At 59 % and below there are two, the least, and the chance grows: one in 10,000 at 50 %, one in 200 at 40 %.
    """
    if not 40 <= percent <= 100:
        raise ValueError(f"{percent} hundredths: {BANDS} bands find pairs from 40 on")
    return max(2, min(16, 2 * int(np.log(1 - 1e-6 ** (1 / BANDS)) / np.log(min(percent, 99) / 100) / 2)))


def release() -> None:
    _words.clear()


def shingles(text: str, width: int) -> np.ndarray:
    """The distinct hashes, in order, of the runs of `width` words; of fewer words, the one of all; none without words."""
    words = text.encode().translate(_LOWER).split()  # of bytes: at space and tab to carriage return
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    try:
        h = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    except KeyError:
        if len(_words) > CACHE_WORDS:
            _words.clear()
        for w in words:
            if w not in _words:
                _words[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    k = min(width, n)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = _mix(out) + h[i : n - k + 1 + i]
    out = np.sort(_mix(out))
    return out[np.r_[True, out[1:] != out[:-1]]]


def signature(s: np.ndarray, rows: int) -> np.ndarray:
    """A key for each band, of the minima and maxima under rows / 2 permutations."""
    k = BANDS * rows // 2
    low, high = np.full(k, ~np.uint64(0)), np.zeros(k, np.uint64)
    for i in range(0, len(s), 1024):
        x = (s[i : i + 1024, None] ^ _XOR[:k]) * _MULTIPLY[:k]
        low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
    x = np.concatenate([low.reshape(BANDS, -1), high.reshape(BANDS, -1)], axis=1)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(x.shape[1]):
        key = _mix(key) + x[:, j]
    return _mix(key)


def components(edges: DataFrame, cuts: Cuts, name: str) -> DataFrame:
    """(node, label) of each node of the edges (u, v): the least node of its component, by alternating large and small stars."""
    pair = lambda df: df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, k = cuts.cut(pair(edges), f"{name}-0", narrow=True), 0
    # done when each node has one edge to a node that has none of its own
    while not edges.groupBy("u").count().where("count > 1").select("u").union(edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")).isEmpty():
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = pair(both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        small = large.join(least, F.col("u") == F.col("w"))
        small = pair(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))))
        k += 1
        edges = cuts.cut(small, f"{name}-{k}", narrow=True)
        cuts.drop(f"{name}-{k - 1}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of which `percent` hundredths of the union are in both."""
    x = pairs.join(sets.select(F.col("c").alias("a"), F.col("s").alias("s_a")), "a").join(sets.select(F.col("c").alias("b"), F.col("s").alias("s_b")), "b")

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    return x.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _outside(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """members (path, c, n, l, label, label_l, own, inn) after their pivot l: `own`, the shingles of c outside the pivots so far,
    which the new path names, `inn`, those inside, and of these the `first` that a similar set inside must share one of."""
    x = members.join(sets.select(F.col("c").alias("l"), F.col("s").alias("s_l")), "l")

    def run(batches):
        for b in batches:
            own, inn, first = [], [], []
            for n, x, i, y in zip(b.column(2).to_pylist(), b.column(6), b.column(7), b.column(8)):
                x, i, y = (np.frombuffer(k.as_buffer(), np.uint64) for k in (x, i, y))
                hit = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
                own.append(x[~hit].tobytes())
                i = np.sort(np.concatenate([i, x[hit]]))
                inn.append(i.tobytes())
                first.append(i[: max(0, len(i) + (-percent * n) // 100 + 1)].view(np.int64))
            path = _mix(_mix(b.column(0).to_numpy().view(np.uint64)) + b.column(3).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), *(b.column(k) for k in range(1, 6)), pa.array([len(i) // 8 for i in inn], pa.int64()), pa.array(own, pa.binary()), pa.array(inn, pa.binary()), pa.array(first, pa.list_(pa.int64()))], names=["path", "c", "n", "l", "label", "label_l", "both", "own", "inn", "first"])

    return x.select("path", "c", "n", "l", "label", "label_l", "own", "inn", "s_l").mapInArrow(run, "path long, c long, n long, l long, label long, label_l long, both long, own binary, inn binary, first array<long>")


def _by_shingle(members: DataFrame, of: str) -> DataFrame:
    """(path, c, band): a bucket for each shingle in the column `of`, in batches of bounded size."""

    def run(batches):
        for b in batches:
            found = [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column(2)]
            row = np.repeat(np.arange(len(found)), [len(o) for o in found])
            if not len(row):
                continue
            flat = np.concatenate(found)
            for k in range(0, len(row), 1 << 16):
                at = pa.array(row[k : k + (1 << 16)], pa.int64())
                path = b.column(0).take(at)
                band = _mix(flat[k : k + (1 << 16)] + _mix(path.to_numpy().view(np.uint64)))
                yield pa.RecordBatch.from_arrays([path, b.column(1).take(at), pa.array(band.view(np.int64))], names=["path", "c", "band"])

    return members.select("path", "c", of).mapInArrow(run, "path long, c long, band long")


def _able(percent: int):
    """Whether two sets of n and n2 shingles can be similar by how many of them are in each of PARTS parts of the hashes."""
    both = F.aggregate(F.zip_with("h", "h2", lambda a, b: F.least(a, b)), F.lit(0), lambda s, x: s + x)
    fits = 100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")
    return fits & ((100 + percent) * both >= percent * (F.col("n") + F.col("n2")))


def _inside(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one path and two components that could be similar by shingles of its pivots only.

    `both` is how many of its shingles are in pivots. With x shingles in both, similarity asks for percent / (100 + percent)
    of n + n2, and x is at most the smaller `both`. A member outside its pivot's component meets members by size, in bins of about three
    per cent; a pair is made of two only if they share one of the shingles in `first`.
    """
    share = percent / (100 + percent)
    bin_of = lambda c: F.floor(F.log(c.cast("double")) * 33)
    most = F.floor(F.col("both") / share - F.col("n") + 1e-6)
    least = F.ceil(F.col("n") * percent / 100 - 1e-6)
    able = members.where(F.col("both") >= F.ceil(share * (F.col("n") + F.col("n") * percent / 100) - 1e-6))
    ask = able.where((F.col("label") != F.col("label_l")) & (most >= least))
    ask = ask.select("path", "c", "n", "both", "label", "h", "first", F.explode(F.sequence(bin_of(F.greatest(least, F.lit(1))), bin_of(F.greatest(most, F.lit(1))))).alias("bin"))
    have = able.select("path", bin_of(F.col("n")).alias("bin"), *(F.col(k).alias(f"{k}2") for k in ("c", "n", "both", "label", "h", "first")))
    enough = (F.col("label") != F.col("label2")) & (F.least("both", "both2") >= share * (F.col("n") + F.col("n2")) - 1e-6) & _able(percent)
    pairs = ask.join(have, ["path", "bin"]).where(enough & F.arrays_overlap("first", "first2"))
    return pairs.select(F.greatest("c", "c2").alias("a"), F.least("c", "c2").alias("b")).distinct()


def _open(buckets: DataFrame) -> DataFrame:
    """The rows (band, c, label, ...) of buckets with more than one component, with their size; of buckets with the same members one."""
    member = F.xxhash64("c")
    spread = buckets.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size"), F.bit_xor(member).alias("x"), F.sum(member.bitwiseAND(F.lit((1 << 31) - 1))).alias("y"))
    spread = spread.where("lo <> hi").groupBy("size", "x", "y").agg(F.min("band").alias("band")).select("band", "size")
    return buckets.join(spread, "band")


def _pivots(large: DataFrame, rounds: int) -> DataFrame:
    """(band, l, label_l): of each bucket the member whose buckets have the most members. In each further round, of a member's buckets
    the first pivot, and of a bucket's members again: a group of copies then has one."""
    code = F.struct("score", F.xxhash64("c").alias("draw"), "c", "label")
    rows = large.join(large.groupBy("c").agg(F.sum("size").alias("score")), "c").select("band", "c", code.alias("code"))
    top = rows.groupBy("band").agg(F.max("code").alias("top"))
    for _ in range(rounds):
        best = rows.select("band", "c").join(top, "band").groupBy("c").agg(F.max("top").alias("top"))
        top = rows.select("band", "c").join(best, "c").groupBy("band").agg(F.max("top").alias("top"))
    return top.select("band", F.col("top.c").alias("l"), F.col("top.label").alias("label_l"))


def _classes(signed: DataFrame) -> DataFrame:
    """Of each shingle set its least id, a row that has it, its bands, and how many rows have it."""
    columns = (F.min("id").alias("rep"), F.min("row").alias("row"), F.min("n").alias("n"), F.first("bands").alias("bands"), F.count("*").alias("k"), F.min("d").alias("d"), F.max("d").alias("d_hi"))
    return signed.where("n > 0").groupBy("c").agg(*columns)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of df: the smallest id reachable over links, of which that row stays.

    Rows are linked if `percent` hundredths of the union of their sets of `width`-word shingles are in both. Null and
    empty texts, and those of white space, have empty sets and no links. A null id is smallest only where all are null.
    Rows that repeat an id and its text share one verdict. An empty table gives an empty result. Other columns are not read.
    """
    spark, cuts, rows = ship(df.sparkSession), Cuts(df.sparkSession), rows_of(percent)
    kind = df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("id"), whole(F.col(text_col)).alias("t")).withColumn("row", F.xxhash64("id", "t"))

    @keeps("near_dedup")
    def sign(batches):
        for b in batches:
            n, c, d, bands = [], [], [], []
            for t in b.column(2):
                s = shingles(t.as_py(), width)
                n.append(len(s))
                for out, x in ((c, _mix(s)), (d, _mix(s + np.uint64(BANDS)))):  # two hashes of the set
                    out.append(((int(x.sum(dtype=np.uint64)) * 31 + int(np.bitwise_xor.reduce(x)) * 0x9E3779B97F4A7C15 + len(s)) & _ALL) - (1 << 63))
                bands.append(signature(s, rows).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x, pa.int64()) for x in (n, c, d)), pa.array(bands, pa.list_(pa.int64()))], names=["id", "row", "n", "c", "d", "bands"])

    signed = cuts.cut(docs.select("id", "row", "t").mapInArrow(sign, f"id {kind}, row long, n long, c long, d long, bands array<long>"), "near-signed", narrow=True)
    classes = cuts.cut(_classes(signed), "near-classes", narrow=True)
    clash = classes.where("d <> d_hi").select("c", F.lit(True).alias("clash"))
    if not clash.isEmpty():  # two sets with one first hash (not to be expected below 10^9 sets): both hashes name them
        signed = signed.join(clash, "c", "left").withColumn("c", F.when(F.col("clash"), F.xxhash64("c", "d", "n")).otherwise(F.col("c"))).drop("clash")
        signed = cuts.cut(signed, "near-renamed")
        classes = cuts.cut(_classes(signed), "near-classes-again")
    buckets = classes.select(F.lit(0).cast("long").alias("path"), "c", "n", F.explode("bands").alias("band"), F.col("c").alias("label"))
    mine = cuts.cut(_open(buckets), "near-open-0", narrow=True)
    wanted = cuts.cut(classes.join(mine.select("c").distinct(), "c", "left_semi").select("c", "row"), "near-wanted", narrow=True)

    @keeps("near_dedup")
    def full(batches):
        for b in batches:
            found = [shingles(t.as_py(), width) for t in b.column(1)]
            counts = [np.bincount((x & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS) for x in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in found], pa.binary()), pa.array(counts, pa.list_(pa.int32()))], names=["c", "s", "h"])

    of, pending, level = wanted.select("c", F.col("c").alias("label")), None, 0
    if not mine.isEmpty():
        found = maybe_in(docs, "row", wanted.select("row")).where("_maybe").join(wanted, "row")  # other texts are not shuffled
        sets = cuts.cut(found.select("c", "t").mapInArrow(full, "c long, s binary, h array<int>"), "near-sets")
        if sets.count() > wanted.count():  # rows that repeat an id and its text
            sets = cuts.cut(sets.dropDuplicates(["c"]), "near-sets-once")
        own = sets.select(F.lit(0).cast("long").alias("path"), "c", F.col("s").alias("own"), F.lit(b"").alias("inn"))
    while pending is not None or not mine.isEmpty():
        small = SMALL if level == 0 else SMALL_LATER
        few = mine.where(F.col("size") <= small).join(sets.select("c", "h"), "c").select("band", "c", "n", "label", "h")
        other = few.select("band", F.col("c").alias("c2"), F.col("n").alias("n2"), F.col("label").alias("label2"), F.col("h").alias("h2"))
        pairs = few.join(other, "band").where((F.col("c") > F.col("c2")) & (F.col("label") != F.col("label2")) & _able(percent)).select(F.col("c").alias("a"), F.col("c2").alias("b"))
        large = mine.where(F.col("size") > small)
        pivots = cuts.cut(_pivots(large, 2 if level == 0 else 0), f"near-pivots-{level}", narrow=True)
        members = cuts.cut(large.join(pivots, "band").where("c <> l").select("path", "c", "n", "l", "label", "label_l").distinct(), f"near-members-{level}", narrow=True)
        pairs = pairs.union(members.where("label <> label_l").select(F.col("c").alias("a"), F.col("l").alias("b")))
        pairs = (pairs if pending is None else pairs.union(pending)).distinct()
        label = lambda side, to: of.select(F.col("c").alias(side), F.col("label").alias(to))  # noqa: E731, B023
        edges = _linked(pairs, sets, percent).join(label("a", "u"), "a").join(label("b", "v"), "b").where("u <> v").select("u", "v")
        edges = cuts.cut(edges.distinct(), f"near-edges-{level}", narrow=True)
        if not edges.isEmpty():
            joined = components(edges, cuts, f"near-stars-{level}").select(F.col("node").alias("label"), F.col("label").alias("to"))
            of = cuts.cut(of.join(joined, "label", "left").select("c", F.coalesce("to", "label").alias("label")), f"near-labels-{level}", narrow=True)
        # what still has members of more than one component under a pivot
        members = members.select("path", "c", "n", "l").join(label("c", "label"), "c").join(label("l", "label_l"), "l")
        mixed = members.where("label <> label_l").select("path", "l").distinct()
        members = cuts.cut(members.join(mixed, ["path", "l"], "left_semi"), f"near-mixed-{level}", narrow=True)
        if members.isEmpty():
            break
        own = cuts.cut(_outside(members.join(own.select("path", "c", "own", "inn"), ["path", "c"]), sets, percent), f"near-own-{level}")
        pending = _inside(own.join(sets.select("c", "h"), "c"), percent)
        level += 1
        left = _by_shingle(own, "own").join(own.select("path", "c", "n"), ["path", "c"]).join(of, "c")
        mine = cuts.cut(_open(left), f"near-open-{level}", narrow=True)
    least = of.join(classes.select("c", "rep"), "c").groupBy("label").agg(F.min("rep").alias("component"))
    final = classes.select("c", "rep", "k").join(of.join(least, "label").select("c", "component"), "c", "left").where("k > 1 or component is not null")
    final = cuts.cut(final.select("c", F.coalesce("component", "rep").alias("component")), "near-components", narrow=True)
    cuts.keep("near-renamed" if "near-renamed" in cuts.paths else "near-signed", "near-components")
    out = signed.select("id", "n", "c").where("n > 0").join(final, "c", "left").select("id", "n", F.coalesce("component", "id").alias("component"))
    out = out.union(signed.where("n = 0").select("id", "n", F.col("id").alias("component")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def op8_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
