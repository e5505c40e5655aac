"""Repeated passages by a range-partitioned suffix sort over sampled suffixes.

Every byte in a string of `length` bytes that also starts anywhere else is to go. Sorting the suffix at each byte would
shuffle many times the corpus, so suffixes are sampled in a way that loses none:

1. Each window of `length` bytes has an anchor: the GRAM bytes in it with the least hash. Equal windows have the same
   anchor at the same place, and neighbouring windows mostly share one, so a text has an anchor every fifty bytes or so. Only
   windows whose anchor occurs twice or more in the corpus can be repeated. Those anchors reach the next scan as a bitmap
   sized by their number, which can only let too much through.
2. Windows are taken in blocks of 32 that are aligned to their anchor, and the bytes that all windows of a block share are its
   suffix. Its tokens are its leading 8 bytes as they are, then a hash of all bytes that its windows share, then one of all that they
   cover together. Suffixes are range-partitioned by these tokens with sampled splitters, each bucket is sorted by a
   multikey quicksort that looks at the next token only where tokens tie, and each suffix is compared with its
   neighbours, across the boundaries of buckets too. If the last token is repeated so is every window; if the second is
   unique no window is. Equal takes 8 bytes and 64 bits of hash at least (128 bits together), 192 for the last.
3. What lies between (a passage that begins or ends in the block) is taken in blocks of 8, and then window by window.

Texts that occur more than once are looked for first, by 128 bits of hashes; all their windows are repeated, and one row stands for
all copies in the sort. Splitters include the place of a suffix, so a passage in any number of different texts is dealt over as
many buckets as it fills.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import BATCH_ROWS, Cuts, maybe_in, ship, table, whole

LENGTH = 200
GRAM = 96
LEVELS = (32, 8, 1)
CHUNK = 1 << 18
#: A bitmap has BITS_A_HASH bits for each hash in it, up to the most: a quarter of a gigabyte on each executor's Python worker.
BITS_A_HASH, LEAST_BITS, MOST_BITS = 32, 1 << 20, 1 << 31
ROWS_A_BUCKET = 400_000
#: Rows of a bucket that tie, or lie between two pivots, are sorted at once from so many down.
CUTOFF = 1 << 13
BASE = 0x9E3779B97F4A7C15 | 1
_POWER = {1: np.uint64(BASE)}
for _m in range(1, 12):
    _POWER[1 << _m] = np.uint64(pow(BASE, 1 << _m, 1 << 64))
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ROW = "head long, lead long, whole long, text long, place long"
#: Spans of a text with copies: all of it.
ALL = -1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


class Hashes:
    """Polynomial hashes of strings of any length up to `most` in a buffer; those of powers of two at every place."""

    def __init__(self, raw: np.ndarray, most: int):
        self.of = {1: _TABLE[raw]}
        m = 1
        while 2 * m <= most and 2 * m <= len(raw):
            h = self.of[m]
            self.of[2 * m] = h[:-m] * _POWER[m] + h[m:]
            m *= 2

    def at(self, places: np.ndarray, length: int) -> np.ndarray:
        out, m = np.zeros(len(places), np.uint64), 1 << (length.bit_length() - 1)
        while m:
            if length & m:
                out = out * _POWER[m] + self.of[m][places]
                places = places + m
            m >>= 1
        return _mix(out)

    def all(self, length: int, n: int) -> np.ndarray:
        """Of the n first places."""
        out, at, m = None, 0, 1 << (length.bit_length() - 1)
        while m:
            if length & m:
                x = self.of[m][at : at + n]
                out = x if out is None else out * _POWER[m] + x
                at += m
            m >>= 1
        return _mix(out)


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column one after another, and where each text begins (and the last ends)."""
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(column) else raw[:0], offsets - offsets[0]


def runs(raw: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """For each chunk of the bytes: the chunk's ends, its hashes, their first place, and runs of windows with one anchor:
    first and last window, anchor and text. Runs go from the window before the chunk, and a block past its end."""
    ends = bounds[1:]
    for c0 in range(0, len(raw), CHUNK):
        c1 = min(len(raw), c0 + CHUNK)
        lo, hi = max(0, c0 - 2 * LEVELS[0]), min(len(raw), c1 + length + 2 * LEVELS[0])
        first = max(0, c0 - 1)
        n = min(c1 + LEVELS[0], hi - length + 1) - first  # windows that begin from `first` on
        if n <= 0:
            continue
        h = Hashes(raw[lo:hi], length + LEVELS[0])
        valid = np.ones(n, bool)
        for e in ends[np.searchsorted(ends, first, "right") :].tolist():
            if e - length + 1 >= first + n:
                break
            valid[max(0, e - length + 1 - first) : max(0, e - first)] = False
        if not valid.any():
            continue
        w = length - gram + 1
        x = h.all(gram, len(raw[lo:hi]) - gram + 1)[first - lo :]
        bits = np.uint64((1 << 21) - 1)
        x = (x & ~bits) | np.arange(len(x), dtype=np.uint64)
        size = 1
        while 2 * size <= w:
            x = np.minimum(x[:-size], x[size:])
            size *= 2
        x = np.minimum(x[:n], x[w - size : w - size + n]) if size < w else x[:n]
        anchor = (x & bits).astype(np.int64) + first
        new = valid.copy()
        new[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
        stop = valid.copy()
        stop[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:]
        t0, t1 = np.flatnonzero(new) + first, np.flatnonzero(stop) + first
        a = anchor[t0 - first]
        yield c0, c1, h, lo, t0, t1, a, np.searchsorted(ends, t0, "right")


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers from low to high of each row, and their rows."""
    count = np.maximum(high - low + 1, 0)
    row = np.repeat(np.arange(len(low)), count)
    return low[row] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count), row


def _has(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def blocks(raw: np.ndarray, bounds: np.ndarray, bitmaps: list[np.ndarray], length: int, gram: int):
    """For each chunk: of each block with a repeated anchor the text, start, tokens (head, lead and whole), and whether the whole is
    in the text. The first bitmap is that of anchors; each further one takes those blocks whose leading token it has apart
    into blocks of the next level."""
    for c0, c1, h, lo, t0, t1, a, text in runs(raw, bounds, length, gram):
        k = np.flatnonzero(_has(bitmaps[0], h.at(a - lo, gram)))
        if not len(k):
            continue
        t0, t1, a, text, size = t0[k], t1[k], a[k], text[k], LEVELS[0]
        number, row = _spread((a - t1) // size, (a - t0) // size)
        start = a[row] - size * number - size + 1
        t0, t1, text = np.maximum(start, t0[row]), np.minimum(start + size - 1, t1[row]), text[row]
        own = np.flatnonzero((t0 >= c0) & (t0 < c1))  # a block is that of the chunk in which its first window is
        start, number, t0, t1, text = start[own], number[own], t0[own], t1[own], text[own]
        lead = _lead(h, start - lo, number, size, length)
        for bitmap, part in zip(bitmaps[1:], LEVELS[1:]):
            k = np.flatnonzero(_has(bitmap, lead))
            j, row = _spread(np.zeros(len(k), np.int64), np.full(len(k), size // part - 1))
            row = k[row]
            start, number, text = start[row] + part * j, number[row] * (size // part) + j, text[row]
            t0, t1, size = np.maximum(start, t0[row]), np.minimum(start + part - 1, t1[row]), part
            own = np.flatnonzero(t0 <= t1)
            start, number, t0, t1, text = start[own], number[own], t0[own], t1[own], text[own]
            lead = _lead(h, start - lo, number, size, length)
        if not len(start):
            continue
        head = _head(raw, start + size - 1)
        if size == 1:
            yield text, start, head, lead, lead, np.ones(len(start), bool)
            continue
        fits = (start >= bounds[text]) & (start + length + size - 1 <= bounds[text + 1])
        full = np.zeros(len(start), np.uint64)
        full[fits] = h.at(start[fits] - lo, length + size - 1)
        yield text, start, head, lead, full, fits


def _head(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place as one number, in the order of bytes."""
    out = np.zeros(len(at), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | raw[at + k]
    return (out ^ np.uint64(1 << 63)).view(np.int64)


def _lead(h: Hashes, at: np.ndarray, number: np.ndarray, size: int, length: int) -> np.ndarray:
    """The token of the bytes that all windows of a block share; with its number from the anchor, as blocks of two anchors can
    begin at one place."""
    return _mix(h.at(at + size - 1, length - size + 1) + number.astype(np.uint64) * np.uint64(BASE))


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by their tokens, column after column, by multikey quicksort: rows are parted by a token of the median of
    a few into less, equal and more; equal ones go on with their next token, the others with the same one."""
    out = np.arange(len(columns[0]))
    todo = [(0, len(out), 0)]
    while todo:
        lo, hi, k = todo.pop()
        rows = out[lo:hi]
        if hi - lo <= CUTOFF or k == len(columns) - 1:
            out[lo:hi] = rows[np.lexsort([c[rows] for c in columns[k:][::-1]])]
            continue
        token = columns[k][rows]
        pivot = np.sort(token[:: max(1, len(token) // 63)])[len(token[:: max(1, len(token) // 63)]) // 2]
        less, same = token < pivot, token == pivot
        more = ~(less | same)
        out[lo:hi] = np.concatenate([rows[less], rows[same], rows[more]])
        a, b = lo + int(less.sum()), hi - int(more.sum())
        todo += [(lo, a, k), (a, b, k + 1), (b, hi, k)]
    return out


def repeated(rows: DataFrame, cuts: Cuts, name: str) -> DataFrame:
    """(lead, whole, text, place, lead_twice, whole_twice) of the rows (a written table) whose suffix is repeated."""
    spark = rows.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_A_BUCKET))
    dealt = rows.repartitionByRange(buckets, "head", "lead", "whole", "text", "place").withColumn("bucket", F.spark_partition_id())

    def compare(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches).combine_chunks()
        c = [t.column(k).to_numpy() for k in range(5)]
        order = multikey_order(c)
        c = [x[order] for x in c]
        bucket = np.full(len(order), t.column(5)[0].as_py(), np.int32)
        flags = []
        for k in (2, 3):  # equal in the first k tokens to a neighbour
            same = np.ones(len(order) - 1, bool)
            for x in c[:k]:
                same &= x[1:] == x[:-1]
            flags.append(np.r_[False, same] | np.r_[same, False])
        edge = np.zeros(len(order), np.int8)
        edge[0] += 1
        edge[-1] += 2
        keep = np.flatnonzero(flags[0] | (edge > 0))
        for k in range(0, len(keep), 1 << 16):
            at = keep[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([*(pa.array(x[at]) for x in c), pa.array(flags[0][at]), pa.array(flags[1][at]), pa.array(edge[at]), pa.array(bucket[at])], names=["head", "lead", "whole", "text", "place", "lead_twice", "whole_twice", "edge", "bucket"])

    rows_a_batch = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, "16384")  # of these narrow rows
    try:
        out = cuts.cut(dealt.mapInArrow(compare, f"{ROW}, lead_twice boolean, whole_twice boolean, edge byte, bucket int"), name)
    finally:
        spark.conf.set(BATCH_ROWS, rows_a_batch)
    # across boundaries: first and last suffix of each bucket, two rows of a bucket at most
    edges = sorted(((r["bucket"], r["edge"] & 2, (r["head"], r["lead"]), r["whole"], r["edge"]) for r in out.where("edge > 0").collect()), key=lambda r: r[:2])
    fixed: dict[tuple[int, int], list[bool]] = {}
    for x, y in zip(edges, edges[1:]):
        if x[0] != y[0] and x[2] == y[2]:
            for r in (x, y):
                got = fixed.setdefault((r[0], r[4]), [True, False])
                got[1] = got[1] or x[3] == y[3]
    if fixed:
        patch = spark.createDataFrame([(*k, *v) for k, v in fixed.items()], "bucket int, edge byte, lead_too boolean, whole_too boolean")
        out = out.join(F.broadcast(patch), ["bucket", "edge"], "left").withColumn("lead_twice", F.col("lead_twice") | F.coalesce("lead_too", F.lit(False))).withColumn("whole_twice", F.col("whole_twice") | F.coalesce("whole_too", F.lit(False)))
    return out.where("lead_twice").select("lead", "whole", "text", "place", "lead_twice", "whole_twice")


def _bits(hashes: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_HASH * hashes).bit_length()))


def _bitmap(hashes: DataFrame, column: str, bits: int | None = None):
    """A broadcast bitmap in which the low bits of each hash (of a written table) are set."""
    bits = bits or _bits(hashes.count())
    at = F.col(column).bitwiseAND(F.lit(bits - 1)) + 1  # Spark numbers the bits of a bucket from 1 on
    parts = hashes.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map"))
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.toLocalIterator():
        out[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(r["map"], np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(out)


def _keys(text_col: str) -> list:
    """Two hashes of a text, 128 bits together."""
    return [F.xxhash64(text_col).alias("text"), F.xxhash64(F.lit("check"), F.col(text_col)).alias("check")]


def _low_half(c: Column) -> Column:
    return F.shiftright(F.shiftleft(c, 32), 32).cast("int")


def _short_keys(text_col: str) -> list:
    """The keys of repeated_spans: 96 bits of these hashes."""
    text, check = _keys(text_col)
    return [text, _low_half(check)]


def repeated_spans(df: DataFrame, cuts: Cuts, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, bits: int | None = None) -> DataFrame:
    """(text, check, spans): for each distinct text of df with repeated strings, its hashes and the spans to remove, in
    bytes, from the first to past the last. They may overlap. A text with copies has ALL."""
    spark = ship(df.sparkSession)
    texts = df.where(F.octet_length(text_col) >= length).select(*_keys(text_col), F.col(text_col).alias("t"))
    copied = cuts.cut(texts.groupBy("text", "check").count().where("count > 1").select("text", "check"), "suffix-copied", narrow=True)
    if not copied.isEmpty():  # one row for each text with copies; only rows that may be such are shuffled
        rows = maybe_in(texts, "text", copied.select("text"))
        once = rows.where("_maybe").select("text", "check", "t").dropDuplicates(["text", "check"])
        texts = rows.where("not _maybe").select("text", "check", "t").union(cuts.cut(once, "suffix-once"))

    def anchors(batches):
        for b in batches:
            for _, _, h, lo, _, _, a, _ in runs(*_buffer(b.column(0)), length, gram):
                yield pa.RecordBatch.from_arrays([pa.array(h.at(a - lo, gram).view(np.int64))], names=["h"])

    twice = texts.select("t").mapInArrow(anchors, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    bitmaps = [_bitmap(cuts.cut(twice, "suffix-anchors", narrow=True), "h", bits)]
    cuts.drop("suffix-anchors")
    spans = None
    for level, size in enumerate(LEVELS):

        def rows(batches):
            known = [x.value for x in bitmaps]
            for b in batches:
                raw, bounds = _buffer(b.column(2))
                k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
                for text, start, head, lead, full, fits in blocks(raw, bounds, known, length, gram):
                    if not fits.all():  # a whole that is not in the text is equal to none
                        alone = np.flatnonzero(~fits)
                        full[alone] = _mix(_mix(k1[text[alone]].view(np.uint64)) + (start[alone] - bounds[text[alone]]).astype(np.uint64) * np.uint64(BASE))
                    place = (k2[text] << 32) | (start - bounds[text] + LEVELS[0])  # half of the second hash; the other half is looked up with the text
                    yield pa.RecordBatch.from_arrays([pa.array(head), pa.array(lead.view(np.int64)), pa.array(full.view(np.int64)), pa.array(k1[text]), pa.array(place)], names=["head", "lead", "whole", "text", "place"])

        name = f"suffix-level-{level}"
        # after the first level, texts without a repeated block need not be looked at again
        some = texts if level == 0 else maybe_in(texts, "text", found.select("text")).where("_maybe")
        found = cuts.cut(some.select("text", "check", "t").mapInArrow(rows, ROW), name)
        found = repeated(found, cuts, f"{name}-sorted")
        cuts.drop(name)
        start = F.greatest(F.expr("cast(place & 4294967295 as bigint)") - LEVELS[0], F.lit(0))
        done = found.where("whole_twice").select("text", F.shiftright("place", 32).cast("int").alias("check"), start.alias("a"))
        done = done.select("text", "check", (F.shiftright("a", 6) * len(LEVELS) + level).alias("word"), F.expr("shiftleft(1L, cast(a & 63 as int))").alias("bit"))
        spans = done if spans is None else spans.union(done)
        if size > 1:
            bitmaps.append(_bitmap(found.where("not whole_twice"), "lead", bits))
    # places become bits before they meet: those of one text are few words then, and those of its copies the same
    words = spans.groupBy("text", "check", "word").agg(F.bit_or("bit").alias("bits"))
    found = words.groupBy("text", "check").agg(F.flatten(F.collect_list(F.array("word", "bits"))).alias("spans"))
    copied = copied.select("text", _low_half(F.col("check")).alias("check"), F.array(F.lit(ALL).cast("long")).alias("spans"))
    return found.join(copied, ["text", "check"], "left_anti").union(copied)


def merged(spans: np.ndarray, size: int, length: int = LENGTH) -> np.ndarray:
    """What spans (of repeated_spans) cover of a text of `size` bytes, as rows (first byte, past the last), in order and apart."""
    if not len(spans):
        return np.zeros((0, 2), np.int64)
    if spans[0] == ALL:
        return np.array([[0, size]])
    word, bits = spans[0::2], np.ascontiguousarray(spans[1::2])
    row, bit = np.nonzero(np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    a = (word[row] // len(LEVELS)) * 64 + bit
    b = np.minimum(a + length - 1 + np.array(LEVELS)[word[row] % len(LEVELS)], size)
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.flatnonzero(np.r_[True, a[1:] > b[:-1]])
    return np.stack([a[new], b[np.r_[new[1:] - 1, len(b) - 1]]], axis=1)


def spans_of(column: pa.Array) -> list[np.ndarray]:
    """A list column of spans as arrays, without a Python object for each."""
    flat, at = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(int)
    return [flat[at[k] : at[k + 1]] for k in range(len(column))]


def cut_out(raw: bytes, spans: np.ndarray) -> bytes:
    out, at = [], 0
    for a, b in spans.tolist():
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def without_repeats(df: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, bits: int | None = None) -> DataFrame:
    """df without the text: its UTF-8 bytes in `raw`, spans to remove (for merged()) as array<bigint> in `spans` (empty where there are none).

    Every byte covered by a string of `length` bytes that also starts anywhere else is in a span: in any row, or
    elsewhere in the same one. So rows with equal texts of `length` bytes or more lose all of them, shorter texts none.
    Null texts are empty, with no bytes. The other columns of df are kept, with any names but `raw` and `spans` of the result;
    there must be one. An empty table gives an empty result.
    """
    spark, cuts = df.sparkSession, Cuts(df.sparkSession)
    spans = cuts.cut(repeated_spans(df, cuts, text_col, length, gram, bits), "suffix-spans", narrow=True)
    cuts.keep("suffix-spans")
    others = [c for c in df.columns if c != text_col]
    row = df.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"), *(k.alias(f"_{n}") for k, n in zip(_short_keys(text_col), ("text", "check"))), F.encode(whole(F.col(text_col)), "UTF-8").alias("raw"))
    row = maybe_in(row, "_text", spans.select(F.col("text").alias("_text")))
    no_spans = F.array().cast("array<bigint>").alias("spans")
    # only rows that may have spans are shuffled, to meet them
    spans = spans.select(F.col("text").alias("_text"), F.col("check").alias("_check"), "spans")
    some = row.where("_maybe").join(spans, ["_text", "_check"], "left").select("_row.*", "raw", F.coalesce("spans", no_spans).alias("spans"))
    return some.unionByName(row.where("not _maybe").select("_row.*", "raw", no_spans))


def op9_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = without_repeats(docs)

    def digest(batches):
        import hashlib

        for b in batches:
            n, removed, count, sha = [], [], [], []
            for raw, spans in zip(b.column(1).to_pylist(), spans_of(b.column(2))):
                n.append(len(raw))
                if len(spans):
                    spans = merged(spans, len(raw))
                    raw = cut_out(raw, spans)
                removed.append(n[-1] - len(raw))
                count.append(len(spans))
                sha.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "raw", "spans").mapInArrow(digest, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
