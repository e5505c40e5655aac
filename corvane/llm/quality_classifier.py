"""Quality classifier: a factorisation machine over hashed words, statistics of structure, and metadata.

A score is w0 + <w, x> + the sum over pairs i < j of <v_i, v_j> x_i x_j, taken in time linear in the features of a text
as half of (the sum of v_i x_i) squared less the sum of (v_i x_i) squared, for each of FACTORS columns. It is fitted on
a bounded sample of labelled rows: ROWS_A_CLASS of each label at most, drawn by a hash of the id.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import keeps, ship, table

BUCKETS = 1 << 14
LEVELS = 12
FACTORS = 8
ROWS_A_CLASS = 2500
EPOCHS, LEAST_STEPS, RATE, RIDGE, BATCH = 20, 400, 0.05, 2e-4, 128
THRESHOLD = 0.3
CACHE_WORDS = 300_000

#: Each in 0 to 1: a share, or a size on a scale that ends at the value given.
STATS = ("mean_word", "upper", "digits", "symbols", "marks", "distinct_words", "commonest_word", "line_words", "distinct_lines", "size", "bars", "letters", "meta_size", "meta_gap", "echoes")
WIDTH = BUCKETS + len(STATS) * (LEVELS + 1)

_kinds: list[np.ndarray] = []
_buckets: dict[str, int] = {}


def kinds() -> np.ndarray:
    """The class of each code point: 0 mark, 1 upper case, 2 other letter, 3 digit, 4 space, 5 line end, 6 symbol, 7 bar."""
    if not _kinds:
        out = np.zeros(0x110000, np.uint8)
        for i in range(0x110000):
            c = chr(i)
            out[i] = 1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 5 if c == "\n" else 4 if c.isspace() else 0
        for c in "#*$%&<>":
            out[ord(c)] = 6
        out[ord("|")] = 7
        _kinds.append(out)
    return _kinds[0]


def release() -> None:
    _buckets.clear()
    _kinds.clear()


def features(text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of a text's features: distinct words, each statistic, and the level of each statistic."""
    words = text.split()
    count: dict[str, int] = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    if len(_buckets) > CACHE_WORDS:
        _buckets.clear()
    at = []
    for w in count:
        if (b := _buckets.get(w)) is None:
            b = _buckets[w] = zlib.crc32(w.encode()) % BUCKETS
        at.append(b)
    word_at = np.unique(np.array(at, np.int64))
    k = np.zeros(8, np.int64)
    for i in range(0, len(text), 1 << 18):
        k += np.bincount(kinds()[np.frombuffer(text[i : i + (1 << 18)].encode("utf-32-le", "surrogatepass"), np.uint32)], minlength=8)
    chars, solid = max(1, len(text)), max(1, int(k.sum() - k[4] - k[5]))
    lines = [x for x in text.split("\n") if x.strip()]
    n = max(1, len(words))
    scaled = lambda x, top: min(1.0, np.log1p(x) / np.log1p(top))
    s = (
        min(1.0, solid / n / 20), k[1] / solid, k[3] / solid, scaled(100 * k[6] / solid, 100), scaled(100 * k[0] / solid, 100),
        len(count) / n, max(count.values(), default=0) / n, scaled(n / max(1, len(lines)), 1000), len(set(lines)) / max(1, len(lines)), scaled(n, 100_000),
        scaled(100 * k[7] / solid, 100), (k[1] + k[2]) / solid, 0.0 if n_chars is None else scaled(max(0, n_chars), 1_000_000), 1.0 if n_chars is None else scaled(abs(n_chars - chars), 1_000_000),
        sum(map(str.__eq__, words, words[1:])) / n,
    )
    s = np.array(s, np.float32)
    level = np.minimum((s * LEVELS).astype(np.int64), LEVELS - 1)
    base = BUCKETS + np.arange(len(STATS)) * (LEVELS + 1)
    numbers = np.concatenate([word_at, base, base + 1 + level])
    values = np.concatenate([np.full(len(word_at), 1 / np.sqrt(max(1, len(word_at))), np.float32), s, np.full(len(STATS), 0.5, np.float32)])
    return numbers, values


def pair_score(numbers: np.ndarray, values: np.ndarray, starts: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Scores of texts whose features stand one after another from `starts` on (none is without features)."""
    vx = v[numbers] * values[:, None]
    total = np.add.reduceat(vx, starts, axis=0)
    squares = np.add.reduceat((vx * vx).sum(1), starts)
    return w0 + np.add.reduceat(w[numbers] * values, starts) + 0.5 * ((total * total).sum(1) - squares)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, prior: float, seed: int = 0) -> tuple[float, np.ndarray, np.ndarray]:
    """w0, w and v, by AdaGrad on the logistic loss with both labels of equal weight; w0 then moved to the prior."""
    rng = np.random.default_rng(seed)
    w, v, w0 = np.zeros(WIDTH, np.float32), (rng.standard_normal((WIDTH, FACTORS)) * 0.05).astype(np.float32), 0.0
    gw, gv, g0 = np.full_like(w, 1e-6), np.full_like(v, 1e-6), 1e-6
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    x = np.zeros((BATCH, WIDTH), np.float32)
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // max(1, len(rows))))):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            at = order[k : k + BATCH]
            xb = x[: len(at)]
            xb[:] = 0
            for i, j in enumerate(at):
                xb[i, rows[j][0]] = rows[j][1]
            live = np.flatnonzero(xb.any(0))
            xb = xb[:, live]
            x2, s, vl = xb * xb, xb @ v[live], v[live]
            score = w0 + xb @ w[live] + 0.5 * ((s * s).sum(1) - x2 @ (vl * vl).sum(1))
            g = ((1 / (1 + np.exp(-np.clip(score, -30, 30))) - y[at]) * weight[at] / len(at)).astype(np.float32)
            dw = xb.T @ g + RIDGE * w[live]
            dv = xb.T @ (g[:, None] * s) - (x2.T @ g)[:, None] * vl + RIDGE * vl
            gw[live] += dw * dw
            gv[live] += dv * dv
            g0 += float(g.sum()) ** 2
            w[live] -= RATE * dw / np.sqrt(gw[live])
            v[live] -= RATE * dv / np.sqrt(gv[live])
            w0 -= RATE * float(g.sum()) / np.sqrt(g0)
    prior = min(1 - 1e-6, max(1e-6, prior))
    return w0 + float(np.log(prior / (1 - prior))), w, v


def quality_scores(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", meta_col: str = "n_chars", label_col: str = "quality") -> DataFrame:
    """(id, score, predicted) for each row of df, learned from `labels` (id, label 0 or 1; of a repeated id the least).

    Null and empty texts have their statistics as features and are scored like any other. Without labels of both kinds
    every score is 0.5, or the one label. Of rows that repeat a labelled id one is learned from. A text of any length is read whole. Rows are scored each for itself, so repeated rows agree. Null labels are left
    out; other columns are not read.
    """
    ship(df.sparkSession)
    spark = df.sparkSession
    meta = F.col(meta_col).cast("long").alias("_meta") if meta_col in df.columns else F.lit(None).cast("long").alias("_meta")
    labels = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).cast("int").alias("_label"))
    counts = {r["_label"]: r["count"] for r in labels.groupBy("_label").count().collect()}
    kind = df.schema[id_col].dataType.simpleString()
    if len(counts) == 2:
        draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("quality sample")), F.lit(1 << 30))
        share = {k: min(1.0, 1.2 * ROWS_A_CLASS / n) for k, n in counts.items()}
        picked = labels.withColumn("_draw", draw).where(F.col("_draw") <= F.when(F.col("_label") == 0, int(share[0] * (1 << 30))).otherwise(int(share[1] * (1 << 30))))
        ids = [(r[id_col], r["_label"], r["_draw"]) for r in picked.orderBy("_draw", id_col).limit(4 * ROWS_A_CLASS).collect()]
        chosen = spark.createDataFrame(ids, f"`{id_col}` {kind}, _label int, _draw long")  # a bounded sample

        @keeps("quality_classifier")
        def bits(batches):
            for b in batches:
                out = [features(t or "", n) for t, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(2), b.column(3), pa.array([x[0].astype(np.int32).tobytes() for x in out], pa.binary()), pa.array([x[1].tobytes() for x in out], pa.binary())], names=["_label", "_draw", "at", "x"])

        found = df.select(id_col, F.col(text_col), meta).join(F.broadcast(chosen), id_col).select(text_col, "_meta", "_label", "_draw")
        # of rows that share a drawn id one, so that a hot id does not fill the driver
        rows = found.mapInArrow(bits, "_label int, _draw long, at binary, x binary").groupBy("_draw", "_label").agg(F.min(F.struct("at", "x")).alias("r")).select("_draw", "_label", "r.*").collect()
        rows = sorted(rows, key=lambda r: (r["_draw"], r["_label"], r["at"], r["x"]))
        rows = [r for k in (0, 1) for r in [r for r in rows if r["_label"] == k][:ROWS_A_CLASS]]
        model = fit([(np.frombuffer(r["at"], np.int32), np.frombuffer(r["x"], np.float32)) for r in rows], np.array([r["_label"] for r in rows]), counts[1] / (counts[0] + counts[1])) if rows else None
    else:
        model = None
    flat = float(next(iter(counts))) if len(counts) == 1 else 0.5
    sent = spark.sparkContext.broadcast(model)  # WIDTH x (FACTORS + 1) numbers

    @keeps("quality_classifier")
    def run(batches):
        model = sent.value
        for b in batches:
            score = np.full(b.num_rows, flat)
            if model is not None and b.num_rows:
                texts, meta = b.column(1).to_pylist(), b.column(2).to_pylist()
                for k in range(0, len(texts), 64):
                    found = [features(t or "", n) for t, n in zip(texts[k : k + 64], meta[k : k + 64])]
                    starts = np.cumsum([0, *(len(x[0]) for x in found[:-1])])
                    s = pair_score(np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]), starts, *model)
                    score[k : k + 64] = 1 / (1 + np.exp(-np.clip(s.astype(np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32), pa.int32())], names=[id_col, "score", "predicted"])

    return df.select(F.col(id_col), F.col(text_col), meta).mapInArrow(run, f"`{id_col}` {kind}, score double, predicted int")


def held_out(id_col: str = "doc_id"):
    """Rows kept from fitting: the CRC-32 of the id as text, modulo 5, is 0. A null id counts as kept."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


def op4_quality_classifier(spark, sf_dir):
    out = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out()))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")
