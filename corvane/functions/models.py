"""The contract of model inference: functions of pandas batches, with a model loaded once a worker."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What each kind of model gives for a row; a model is registered under a name of its own with the schema of its kind.
SCHEMAS: dict[str, str] = {
    "asr": "id string, text string, confidence double, metadata string",
    "lid": "id string, lang string, lang_prob double, yue_prob double, cmn_prob double, top3 string",
    "lid_window": "raw_id string, start_sec double, top_labels array<struct<lang:string,prob:double>>",
    "overlap": "id string, overlap_ratio double, overlap_sec double, speech_ratio double",
    "tagging": "id string, music_prob double, music_tags string",
    "dnsmos": "id string, dnsmos_sig double, dnsmos_ovrl double",
    "diarization": "raw_id string, turn_idx int, start_sec double, end_sec double, speaker_tag string",
    "encoder": "id string, embedding array<float>",
    "aligner": "id string, chars array<struct<ch:string,start_sec:double,end_sec:double>>",
    "vad": "id string, voiced_sec double, gaps array<struct<start_sec:double,end_sec:double,dur:double>>, f0_median_hz double",
}
MODELS: dict[str, tuple[Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], str]] = {}


def register(name: str, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> None:
    """A model: `load` is called once in each Python worker and gives a function of batches, whose rows have `schema`, or the schema of that kind."""
    MODELS[name] = (load, SCHEMAS.get(schema, schema))


def checked_scores(rows: DataFrame, columns: tuple[str, ...] = ("dnsmos_sig", "dnsmos_ovrl")) -> DataFrame:
    """rows with opinion scores to 2 places; those outside 1 to 5 are null, as of a model that failed."""
    return rows.withColumns({c: F.when(F.col(c).between(1.0, 5.0), F.round(c, 2)) for c in columns})


def energy_model(rate: int, frame_sec: float = 0.03, loud: float = 1e-4):
    """A stand-in for voice detection that needs no weights: voiced seconds and gaps by the energy of frames (kind `vad`, rows with `samples`)."""

    def load():
        import numpy as np

        def forward(batch: pd.DataFrame) -> pd.DataFrame:
            out, size = [], int(rate * frame_sec)
            for i, samples in zip(batch.id, batch.samples):
                x = np.zeros(0) if samples is None else np.asarray(samples, np.float64)
                on = (x[: len(x) // size * size].reshape(-1, size) ** 2).mean(1) > loud
                edge = np.flatnonzero(np.diff(np.r_[1, on, 1]))
                gaps = [{"start_sec": a * frame_sec, "end_sec": b * frame_sec, "dur": (b - a) * frame_sec} for a, b in zip(edge[::2], edge[1::2]) if b - a >= 0.2 / frame_sec]
                out.append((i, float(on.sum() * frame_sec), gaps, None))
            return pd.DataFrame(out, columns=["id", "voiced_sec", "gaps", "f0_median_hz"])

        return forward

    return load


def halving(forward: Callable[[pd.DataFrame], pd.DataFrame], batch: pd.DataFrame) -> pd.DataFrame:
    """forward(batch), or that of its halves where it is out of memory, down to a row."""
    try:
        return forward(batch)
    except MemoryError:
        if len(batch) < 2:
            raise
        at = len(batch) // 2
        return pd.concat([halving(forward, batch.iloc[:at]), halving(forward, batch.iloc[at:])])


def run_model(rows: DataFrame, forward: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch: int = 64) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), batch):
                yield halving(forward, pdf.iloc[k : k + batch])

    return rows.mapInPandas(run, schema)


def infer(rows: DataFrame, name: str, batch: int = 64) -> DataFrame:
    """What the registered model gives for rows."""
    if name not in MODELS:
        raise KeyError(f"no model {name} is registered; register one with a schema of {sorted(SCHEMAS)}")
    load, schema = MODELS[name]

    def run(batches):
        forward = load()
        for pdf in batches:
            for k in range(0, len(pdf), batch):
                yield halving(forward, pdf.iloc[k : k + batch])

    return rows.mapInPandas(run, schema)


#: What nodes are given besides tables: the reading lexicon, and the models' names in results with their keys.
RESOURCES: dict[str, dict] = {"lexicon": {}, "asr_models": {}}


def lexicon_reader(lexicon: dict[str, str], code_switch: bool = False):
    """A UDF that reads a text by the longest entries of a lexicon; what has none is passed over, but for words of Latin letters
    with `code_switch`, which stay as they are."""
    words = sorted(filter(None, lexicon), key=len, reverse=True)
    latin = ["[A-Za-z]+(?:'[A-Za-z]+)?"] if code_switch else []
    pattern = "|".join([*map(re.escape, words), *latin])
    find = re.compile(pattern, re.S).findall if pattern else lambda t: []

    @F.pandas_udf("string")
    def read(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else " ".join([lexicon.get(w, w) for w in find(t)]))

    return read
