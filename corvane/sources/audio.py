"""Audio of WAV files: scanned by Spark, decoded in Arrow batches, a file read once for all rates and windows asked of it.

PCM of 8 to 32 bits is read here; another container needs a reader given as `read`, a function of its bytes. A file that cannot
be read gives null samples and does not stop its batch.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Callable
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Read = Callable[[bytes], "tuple[np.ndarray, int] | None"]
TAPS, BLOCK = 16, 1 << 15
PROBE = "channels int, codec string, sample_rate int, duration_sec double, lr_correlation double"


def files(spark: SparkSession, folder: str, pattern: str = "*.wav") -> DataFrame:
    """(path, modified, bytes, content) of the files below a folder; the content is read only where it is used."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return rows.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"), "content")


def clip(content: bytes, start: float, end: float) -> bytes | None:
    """The part of a PCM WAV from start to end, in seconds, as a WAV."""
    try:
        with wave.open(io.BytesIO(content)) as w:
            w.setpos(min(w.getnframes(), int(start * w.getframerate())))
            raw, params = w.readframes(int((end - start) * w.getframerate())), w.getparams()
    except (wave.Error, EOFError):
        return None
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setparams(params)
        w.writeframes(raw)
    return out.getvalue()


def attach(rows: DataFrame, path: str = "audio_path") -> DataFrame:
    """rows with the `content` of the file that each names, from any store that pyarrow reads; null where there is none. A path that ends
    in #<from>-<to> names that part of a WAV file, in seconds."""

    def run(batches):
        from pyarrow import fs

        for pdf in batches:
            found = []
            for p in pdf[path]:
                try:
                    p, _, part = p.partition("#")
                    store, name = fs.FileSystem.from_uri(p if "://" in p or p.startswith("file:") else f"file://{p}")
                    with store.open_input_file(name) as f:
                        content = f.read()
                    found.append(clip(content, *map(float, part.split("-"))) if part else content)
                except (OSError, ValueError, TypeError, AttributeError):
                    found.append(None)
            yield pdf.assign(content=found)

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{names}, content binary")


def read_wav(content: bytes) -> tuple[np.ndarray, int] | None:
    """Samples from -1 to 1, a column a channel, and their rate; None for what is no PCM WAV."""
    try:
        with wave.open(io.BytesIO(content)) as w:
            width, channels, rate, raw = w.getsampwidth(), w.getnchannels(), w.getframerate(), w.readframes(w.getnframes())
    except (wave.Error, EOFError, OSError, RuntimeError):
        return None
    raw = raw[: len(raw) // (width * channels) * width * channels]
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) / 2.0**31).astype(np.float32)
    else:
        x = (np.frombuffer(raw, f"<i{width}") / 2.0 ** (8 * width - 1)).astype(np.float32)
    return x.reshape(-1, channels), rate


def resample(y: np.ndarray, rate: int, target: int) -> np.ndarray:
    """y at another rate, by a windowed sinc that cuts off at the lower of the two; in blocks, so memory is bounded."""
    if rate == target or not len(y):
        return y.astype(np.float32)
    g = gcd(rate, target)
    step, cut = rate / target, min(1.0, target / rate)
    half = int(np.ceil(TAPS / cut))
    padded = np.concatenate([np.zeros(half, np.float32), y, np.zeros(half + 1, np.float32)])
    n, around, out = -(-len(y) * (target // g) // (rate // g)), np.arange(-half, half + 1), []
    for k in range(0, n, BLOCK):
        at = np.arange(k, min(n, k + BLOCK)) * step
        near = np.floor(at).astype(np.int64)
        t = near[:, None] + around[None, :] - at[:, None]
        weight = np.sinc(t * cut) * cut * np.where(np.abs(t) <= half, 0.5 + 0.5 * np.cos(np.pi * t / half), 0)
        out.append((padded[np.clip(near[:, None] + around + half, 0, len(padded) - 1)] * weight).sum(1).astype(np.float32))
    return np.concatenate(out)


def decode(rows: DataFrame, rates: list[int], key: str = "path", read: Read = read_wav, windows: str | None = None) -> DataFrame:
    """(key, sample_rate, start_sec, samples, duration_sec) of rows (key, content), mono: a row for each different rate, and with `windows` (a
    column of arrays of start and length in seconds) for each of a row's windows. samples is null where a file cannot be read."""
    rates = list(dict.fromkeys(rates))

    def run(batches):
        for pdf in batches:
            out = []
            for k, content, asked in zip(pdf["key"], pdf["content"], pdf["windows"]):
                found = None if content is None else read(bytes(content))
                if found is None:
                    out += [(k, r, 0.0, None, None) for r in rates]
                    continue
                y, rate = found[0].mean(1), found[1]
                for start, length in [(0.0, None)] if asked is None else asked:
                    part = y if length is None else y[int(start * rate) : int((start + length) * rate)]
                    out += [(k, r, start, resample(part, rate, r), len(y) / rate) for r in rates]
            yield pd.DataFrame(out, columns=["key", "sample_rate", "start_sec", "samples", "duration_sec"])

    asked = F.transform(windows, lambda w: F.array(w["start"], w["length"])) if windows else F.lit(None).cast("array<array<double>>")
    kind = rows.schema[key].dataType.simpleString()
    made = rows.select(F.col(key).alias("key"), "content", asked.alias("windows")).mapInPandas(run, f"key {kind}, sample_rate int, start_sec double, samples array<float>, duration_sec double")
    return made.withColumnRenamed("key", key)


def probe(rows: DataFrame, key: str = "path", read: Read = read_wav, codec: str = "pcm") -> DataFrame:
    """(key, channels, codec, sample_rate, duration_sec, lr_correlation) of rows (key, content); the last for two channels that both vary."""

    def run(batches):
        for pdf in batches:
            out = []
            for k, content in zip(pdf["key"], pdf["content"]):
                found = None if content is None else read(bytes(content))
                if found is None:
                    out.append((k, None, None, None, None, None))
                    continue
                y, rate = found
                r = None
                if y.shape[1] == 2 and len(y) and y.std(0).min() > 0:
                    r = float(np.corrcoef(y.T.astype(np.float64))[0, 1])
                out.append((k, y.shape[1], codec, rate, len(y) / rate, r))
            yield pd.DataFrame(out, columns=["key", *(c.split()[0] for c in PROBE.split(", "))]).astype({"channels": "Int32", "sample_rate": "Int32"})

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("key"), "content").mapInPandas(run, f"key {kind}, {PROBE}").withColumnRenamed("key", key)


def frames(samples: Column, size: int, hop: int | None = None) -> Column:
    """The mean energy of each frame of `size` samples, natively; what is left at the end is no frame."""
    hop = hop or size
    n = F.floor((F.size(samples) - size) / hop).cast("int")
    energy = lambda i: F.aggregate(F.slice(samples, i * hop + 1, size), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / size
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), energy)).otherwise(F.array().cast("array<double>"))


def snr(energies: Column) -> Column:
    """10 log10 of the mean of the loudest tenth of frames over that of the quietest, to one place; null without frames."""
    x, tenth = F.array_sort(energies), F.greatest(F.lit(1), F.floor(F.size(energies) / 10).cast("int"))
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / tenth
    top, low = mean(F.slice(x, F.size(x) - tenth + 1, tenth)), mean(F.slice(x, F.lit(1), tenth))
    return F.when(F.size(energies) > 0, F.round(10 * F.log10((top + 1e-10) / (low + 1e-10)), 1))


def speech_spans(probabilities: Column, frame_sec: float, on: float = 0.5, off: float = 0.35, least_sec: float = 0.25, pause_sec: float = 0.1) -> Column:
    """Where a voice detector's frame probabilities say speech: an array of (start_sec, end_sec).

    Speech begins at `on` and ends where it falls under `off` for `pause_sec`; shorter spans than `least_sec` are left out. Native: one
    fold over the frames with the open span as its state."""
    span = "struct<start_sec:double,end_sec:double>"
    none, quiet = F.lit(None).cast("double"), round(pause_sec / frame_sec)
    zero = F.struct(F.lit(0).alias("i"), none.alias("start"), none.alias("end"), F.array().cast(f"array<{span}>").alias("out"))
    one = lambda a, b: F.array(F.struct(a.alias("start_sec"), b.alias("end_sec")))
    put = lambda s: F.when(s["end"] - s["start"] >= least_sec, F.concat(s["out"], one(s["start"], s["end"]))).otherwise(s["out"])

    def step(s: Column, p: Column) -> Column:
        here, live = s["i"] * F.lit(frame_sec), (p >= on) | (s["start"].isNotNull() & (p >= off))
        over = s["start"].isNotNull() & ~live & (here - s["end"] >= (quiet - 0.5) * frame_sec)
        start = F.when(over, none).when(s["start"].isNull() & live, here).otherwise(s["start"])
        end = F.when(over, none).when(live, here + frame_sec).otherwise(s["end"])
        return F.struct((s["i"] + 1).alias("i"), start.alias("start"), end.alias("end"), F.when(over, put(s)).otherwise(s["out"]).alias("out"))

    return F.aggregate(probabilities, zero, step, lambda s: F.when(s["start"].isNotNull(), put(s)).otherwise(s["out"]))
