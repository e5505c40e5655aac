"""Agreement of transcripts: the mean ratio of difflib over all pairs of normalised texts.

The ratio depends on the order of its arguments and on difflib's own heuristics for long texts, so it is what difflib gives, by
looking up where runs of its uncommon characters meet; in Arrow batches. All else here is native.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import normalize_text


#: Places of runs that are kept, for each character of both texts; beyond it (long copies of uncommon characters) difflib itself is asked.
RUNS_A_CHARACTER = 20


def _places(text: str, chars: set[str]) -> dict[str, list[int]]:
    out = {c: [] for c in chars}
    if len(chars) > 32:
        for k, c in enumerate(text):
            if c in out:
                out[c].append(k)
        return out
    for c, at in out.items():
        k = text.find(c)
        while k >= 0:
            at.append(k)
            k = text.find(c, k + 1)
    return out


def _runs(a: str, b: str) -> list[tuple[list[int], list[list[int]]]] | None:
    """By length less 1: where runs of characters that difflib looks up begin in a, and where the same ones do in b; None if they are too many."""
    most = len(b) // 100 + 1 if len(b) >= 200 else len(b)
    chars = {c for c, n in Counter(b).items() if n <= most}.intersection(a)
    of_a, of_b = _places(a, chars), _places(b, chars)
    begin = sorted(k for at in of_a.values() for k in at)
    runs, left = [(begin, [of_b[a[i]] for i in begin])], RUNS_A_CHARACTER * (len(a) + len(b))
    while runs[-1][0]:
        n, longer = len(runs), ([], [])
        for i, at in zip(*runs[-1]):
            c = a[i + n : i + n + 1]
            if c in chars and (on := [j for j in at if b[j + n : j + n + 1] == c]):
                longer[0].append(i)
                longer[1].append(on)
                left -= len(on)
                if left < 0:
                    return None
        runs.append(longer)
    return runs[:-1]


def _alike(a: str, i: int, b: str, j: int, most: int, way: int) -> int:
    """How many characters are the same from a[i] and b[j] on (way 1), or before these (way -1)."""
    n, step = 0, 16
    while n < most and step:
        k = min(step, most - n)
        same = a[i + n : i + n + k] == b[j + n : j + n + k] if way > 0 else a[i - n - k : i - n] == b[j - n - k : j - n]
        if same:
            n, step = n + k, 2 * step
        else:
            step = k // 2
            most = n + k - 1
    return n


def ratio(a: str, b: str) -> float:
    """SequenceMatcher(None, a, b).ratio()."""
    if a == b:
        return 1.0
    runs = _runs(a, b)
    if runs is None:
        from difflib import SequenceMatcher

        return SequenceMatcher(None, a, b).ratio()
    same, todo = 0, [(0, len(a), 0, len(b), len(runs))]
    while todo:
        alo, ahi, blo, bhi, n = todo.pop()
        i, j, k = alo, blo, 0
        while n and not k:  # the longest run of them, the first in a, then in b; none is longer than the one around it
            begin, places = runs[n - 1]
            for x in range(bisect_left(begin, alo), len(begin)):
                if begin[x] + n > ahi:
                    break
                at = places[x]
                y = bisect_left(at, blo)
                if y < len(at) and at[y] + n <= bhi:
                    i, j, k = begin[x], at[y], n
                    break
            n -= not k
        back = _alike(a, i, b, j, min(i - alo, j - blo), -1)
        i, j, k = i - back, j - back, k + back
        k += _alike(a, i + k, b, j + k, min(ahi - i - k, bhi - j - k), 1)
        if k:
            same += k
            if alo < i and blo < j:
                todo.append((alo, i, blo, j, n))
            if i + k < ahi and j + k < bhi:
                todo.append((i + k, ahi, j + k, bhi, n))
    return 2.0 * same / (len(a) + len(b))


def ratio_mean(texts: list[str]) -> float:
    pairs = list(combinations(texts, 2))
    return round(sum(ratio(a, b) for a, b in pairs) / len(pairs), 3) if pairs else 1.0


def char_agreement(texts: Column) -> Column:
    """Of an array of texts, in its order; 1.0 for fewer than two, null for a null array."""

    @F.pandas_udf("double")
    def agree(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else ratio_mean(["" if t is None else t for t in x]))

    return agree(texts)


def grouped(results: DataFrame, retired: tuple[str, ...] = ()) -> DataFrame:
    """(id, model_count, candidates): an id's results in order of model; model_count has retired models too."""
    row = F.struct("model", "text", "confidence")
    out = results.groupBy("id").agg(F.count("*").cast("int").alias("model_count"), F.array_sort(F.collect_list(row)).alias("candidates"))
    if retired:
        out = out.withColumn("candidates", F.filter("candidates", lambda x: ~x["model"].isin(*retired)))
    return out


def best_text(candidates: Column) -> Column:
    """The text of the most confident candidate that has one, the first of equals; empty if none has."""
    filled = F.filter(candidates, lambda x: F.coalesce(x["text"], F.lit("")) != "")
    top = F.array_max(F.transform(filled, lambda x: F.coalesce(x["confidence"], F.lit(0.0))))
    first = F.get(F.filter(filled, lambda x: F.coalesce(x["confidence"], F.lit(0.0)) == top), F.lit(0))
    return F.coalesce(first["text"], F.lit(""))


def resolved(results: DataFrame, models: dict[str, str], current: dict[str, str] | None = None) -> DataFrame:
    """results with `key`, what their model is known as by `models` (its name to its key); others, and those of a key in `current` under
    another name than the one there, are left out."""
    names = F.create_map(*(F.lit(x) for pair in models.items() for x in pair)) if models else F.lit(None).cast("map<string,string>")
    rows = results.withColumn("key", F.try_element_at(names, F.col("model"))).where("key is not null")
    for key, name in (current or {}).items():
        rows = rows.where((F.col("key") != key) | (F.col("model") == name))
    return rows


def agreement_rows(results: DataFrame, retired: tuple[str, ...] = (), models: dict[str, str] | None = None, current: dict[str, str] | None = None, primary: str | None = None) -> DataFrame:
    """(id, agreement, best_text, text_verified, model_count, canto_ft_confidence) of ids with two results or more.

    With `models`, results count under their key (see resolved) and unknown models not at all, but model_count has every result. Retired
    keys take no part in agreement and best text. Agreement is over the texts that are not empty as they came, each then normalised; it is 0
    with fewer than two. The last column is the confidence of the key `primary`, 0 where that is null, and null without a result of it.
    """
    keyed = resolved(results, models, current) if models is not None else results.withColumn("key", F.col("model"))
    known = grouped(keyed.select("id", F.col("key").alias("model"), "text", "confidence")).select("id", "candidates")
    count = results.groupBy("id").agg(F.count("*").cast("int").alias("model_count")).where("model_count >= 2")
    rows = count.join(known, "id", "left").withColumn("candidates", F.coalesce("candidates", F.array().cast(known.schema["candidates"].dataType)))
    of = F.transform(F.filter("candidates", lambda x: x["model"] == primary), lambda x: F.coalesce(x["confidence"], F.lit(0.0))) if primary else F.array().cast("array<double>")
    active = F.filter("candidates", lambda x: ~x["model"].isin(*retired)) if retired else F.col("candidates")
    rows = rows.select("id", "model_count", F.try_element_at(of, F.lit(1)).alias("canto_ft_confidence"), active.alias("candidates"))
    texts = F.transform(F.filter("candidates", lambda x: F.coalesce(x["text"], F.lit("")) != ""), lambda x: normalize_text(x["text"]))
    # the difflib stage sees only rows with two texts: a UDF in a CASE would run on all
    rows = rows.withColumn("_texts", texts)
    some = rows.where(F.size("_texts") >= 2).withColumn("agreement", char_agreement(F.col("_texts")))
    none = rows.where(F.size("_texts") < 2).withColumn("agreement", F.lit(0.0))
    return some.unionByName(none).select("id", "agreement", best_text(F.col("candidates")).alias("best_text"), F.lit(False).alias("text_verified"), "model_count", "canto_ft_confidence")
