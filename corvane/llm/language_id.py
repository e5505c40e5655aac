"""Language ID with string kernels.

The kernel of two texts is the blended-spectrum presence kernel: the number of character n-grams of 1 to N_MAX letters
that both contain, over the root of the product of their own numbers. N-grams are counted as present in BUCKETS hash
buckets. A bounded sample of the labelled rows of every language is fitted: landmarks among them span the Nyström features
K(x, landmarks) K(landmarks, landmarks)^-1/2, and kernel ridge regression finds one against the rest of each language.

A score is K(x, landmarks) times the fitted weights. Both are products of presence vectors, so landmarks and weights are
multiplied once, into one column per language, and a batch of texts is scored by one product of its presence matrix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corvane.llm.common import keeps, ship, table, whole

N_MAX = 4
BUCKETS = 1 << 15
#: The sample that is fitted: so many rows of each language at most; fewer where there would be over ROWS, but LEAST_ROWS still.
ROWS_A_LANGUAGE, LEAST_ROWS, ROWS = 300, 16, 19_200
#: Landmarks: the least number, so many a language beyond, and the most; but one of each language still, as it can't win without.
LANDMARKS, LANDMARKS_A_LANGUAGE, MOST_LANDMARKS = 256, 4, 2048
RIDGE = 0.05
BATCH = 64
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, its lower case if it is a letter, else 32."""
    if not _letters:
        out = np.full(0x110000, 32, np.uint32)
        for i in range(0x110000):
            if (c := chr(i)).isalpha():
                low = c.lower()
                out[i] = ord(low) if len(low) == 1 else i
        _letters.append(out)
    return _letters[0]


def release() -> None:
    _letters.clear()


def presence(text: str, into: np.ndarray) -> bool:
    """Sets the buckets of the text's n-grams in `into`; False if the text has no letter.

    Runs of what is not a letter are one space, and the text stands between spaces. Long texts go in overlapping parts,
    so memory is bounded; presence makes overlaps harmless.
    """
    table_, any_letter, rest = letters(), False, np.array([32], np.uint64)
    for k in range(0, len(text), 1 << 18):
        c = table_[np.frombuffer(text[k : k + (1 << 18)].encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
        any_letter = any_letter or bool((c != 32).any())
        c = np.concatenate([rest, c])
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
        c = c[keep]
        if k + (1 << 18) >= len(text) and c[-1] != 32:
            c = np.append(c, np.uint64(32))
        h = np.zeros(len(c), np.uint64)
        for n in range(1, N_MAX + 1):
            m = len(c) - n + 1
            if m <= 0:
                break
            h = (h[:m] + c[n - 1 : n - 1 + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            into[(h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - (BUCKETS.bit_length() - 1))] = 1
        rest = c[-(N_MAX - 1) :]
    return any_letter


def _sample(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, and the presence bits (packed) and language numbers of the sampled rows."""
    langs = df.groupBy(lang_col).agg(F.count("*").alias("c")).collect()
    if not langs:
        return [], np.zeros((0, BUCKETS // 8), np.uint8), np.zeros(0, int)
    most = min(ROWS_A_LANGUAGE, max(LEAST_ROWS, ROWS // len(langs)))
    # a share of each language that holds about one and a half times the rows wanted, by a hash of the row; then the first of those
    shares = [(r[lang_col], min(1.0, (1.5 * most + 30) / r["c"])) for r in langs]
    limits = df.sparkSession.createDataFrame([(lang, int(share * (1 << 30)) + (share == 1.0)) for lang, share in shares], StructType([StructField("lang", df.schema[lang_col].dataType), StructField("below", LongType())]))
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("language sample")), F.lit(1 << 30))
    picked = df.select(F.col(lang_col).alias("lang"), draw.alias("draw"), F.crc32(F.encode(text_col, "UTF-8")).alias("tie"), F.col(text_col).alias("text"))
    picked = picked.join(F.broadcast(limits), "lang").where("draw < below").select("lang", "draw", "tie", "text")  # a row a language

    @keeps("language_id")
    def bits(batches):
        for b in batches:
            rows = []
            for t in b.column(3).to_pylist():
                x = np.zeros(BUCKETS, np.uint8)
                rows.append(np.packbits(x).tobytes() if presence(t, x) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(rows, pa.binary())], names=["lang", "draw", "tie", "bits"])

    read = picked.mapInArrow(bits, "lang string, draw long, tie long, bits binary").where("bits is not null")
    taken = read.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "tie"))).where(F.col("k") <= most).collect()
    taken.sort(key=lambda r: (r["draw"], r["tie"], r["lang"]))
    names = sorted({r["lang"] for r in taken})
    number = {lang: k for k, lang in enumerate(names)}
    x = np.frombuffer(b"".join([r["bits"] for r in taken]), np.uint8).reshape(len(taken), BUCKETS // 8)
    return names, x, np.array([number[r["lang"]] for r in taken], int)


def _bits(x: np.ndarray) -> np.ndarray:
    return (x if x.shape[1] == BUCKETS else np.unpackbits(x, axis=1)).astype(np.float32)


def fit(x: np.ndarray, y: np.ndarray, n_langs: int) -> np.ndarray:
    """The weights of each bucket for each language, from presence bits (packed or not) and language numbers; float32."""
    # landmarks are dealt over the languages in turn
    turn = np.empty(len(y), int)
    for k in range(n_langs):
        turn[y == k] = np.arange((y == k).sum())
    at = np.lexsort((y, turn))[: max(n_langs, min(MOST_LANDMARKS, max(LANDMARKS, LANDMARKS_A_LANGUAGE * n_langs)))]
    unit = lambda rows: rows / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))
    marks = np.concatenate([unit(_bits(x[at[k : k + BATCH]])) for k in range(0, len(at), BATCH)])
    k_mm = marks @ marks.T
    w, v = np.linalg.eigh(k_mm.astype(np.float64))
    half = (v * np.where(w > 1e-6, 1 / np.sqrt(np.maximum(w, 1e-6)), 0)) @ v.T
    weight = 1.0 / np.maximum(1, np.bincount(y, minlength=n_langs))[y]
    weight *= len(y) / weight.sum()
    square, target = RIDGE * np.eye(len(at)), np.zeros((n_langs, len(at)))
    for k in range(0, len(x), BATCH):
        features = (unit(_bits(x[k : k + BATCH])) @ marks.T) @ half
        weighted = weight[k : k + BATCH, None] * features
        square += features.T @ weighted
        np.add.at(target, y[k : k + BATCH], weighted)
    weights = half @ np.linalg.solve(square, target.T)
    return np.concatenate([(marks[:, k : k + 4096].T @ weights).astype(np.float32) for k in range(0, BUCKETS, 4096)])


def language_id(df: DataFrame, train: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, lang_pred, score) for each row of df, with the languages of `train` (df by default; rows with a null are left out).

    A null text and one without a letter are `und` with score 0, as is every text where nothing can be learned. Ties go
    to the first language in order of names. Rows are scored each for itself, so repeated rows agree. Other columns are
    not read.
    """
    ship(df.sparkSession)
    train = df if train is None else train
    train = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(id_col, text_col, lang_col)
    names, x, y = _sample(train, id_col, text_col, lang_col)
    weights = fit(x, y, len(names)) if names else np.zeros((BUCKETS, 0), np.float32)
    sent = df.sparkSession.sparkContext.broadcast((names, weights))  # BUCKETS numbers a language: 128 KB
    kind = df.schema[id_col].dataType.simpleString()

    @keeps("language_id")
    def run(batches):
        names, weights = sent.value
        x = np.zeros((BATCH, BUCKETS), np.float32)
        for b in batches:
            texts, pred, score = b.column(1).to_pylist(), [], []
            for k in range(0, len(texts), BATCH):
                part = texts[k : k + BATCH]
                x[: len(part)] = 0
                known = [presence(t or "", x[i]) for i, t in enumerate(part)]
                if not names:
                    pred += [UNKNOWN] * len(part)
                    score += [0.0] * len(part)
                    continue
                s = (x[: len(part)] @ weights) / np.sqrt(np.maximum(x[: len(part)].sum(1, keepdims=True), 1))
                best = s.argmax(1)
                pred += [names[j] if ok else UNKNOWN for j, ok in zip(best, known)]
                score += [float(min(1.0, max(0.0, s[i, j]))) if ok else 0.0 for i, (j, ok) in enumerate(zip(best, known))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[id_col, "lang_pred", "score"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """Rows kept from fitting: the CRC-32 of the id as text, modulo 4, is 2. A null id counts as kept."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 4 == 2, F.lit(True))


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = language_id(docs, train=docs.where(~held_out()))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
