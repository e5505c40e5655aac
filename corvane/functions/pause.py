"""Reconciling punctuation with pauses: a walk over a text and its aligned characters, and tokens put into the text."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks, the half-width ones that count as such, the cut-offs in seconds, and the tokens.
MARKS = "，。、；：？！"
HALF = str.maketrans(",?!;:", "，？！；：")
NO_PAUSE_SEC, LONG_SEC = 0.16, 0.48
SHORT_TOKEN, LONG_TOKEN = "<pause-short>", "<pause-long>"

PLAN = "array<struct<offset:int,mark:string,kind:string,delta_t:double,verdict:string>>"


def verdict(delta: float, no_pause: float = NO_PAUSE_SEC, long: float = LONG_SEC) -> str:
    return "no_pause" if delta < no_pause else "short" if delta < long else "long"


def verdict_of(delta: Column, no_pause: float = NO_PAUSE_SEC, long: float = LONG_SEC) -> Column:
    return F.when(delta < no_pause, "no_pause").when(delta < long, "short").when(delta.isNotNull(), "long")


ANY_MARK = re.compile("[" + re.escape(MARKS + ",?!;:") + "]")


def walk(text: str, chars: str, starts, ends, duration: float | None, no_pause: float = NO_PAUSE_SEC, long: float = LONG_SEC) -> tuple[list[dict], bool]:
    """(events, unalignable) of a text, its aligned characters, and where each starts and ends.

    A character that the alignment has next is passed; of the others, marks are events, by whether aligned characters stand
    on both sides. Unless all aligned characters are met there are no events. What stands between two marks is compared at
    once: without what the alignment has nowhere, it is mostly the next of its characters.
    """
    at, events, n, has, done = 0, [], len(chars), set(chars), 0
    unknown = {ord(c): None for c in set(text) - has}

    def passed(at: int, part: str) -> int:
        known = part.translate(unknown)
        if chars.startswith(known, at):
            return at + len(known)
        for c in known:
            at += at < n and c == chars[at]
        return at

    for m in ANY_MARK.finditer(text):
        offset, c = m.start(), m[0]
        at = passed(at, text[done:offset])
        done = offset + 1
        if at < n and c == chars[at]:
            at += 1
            continue
        event = {"offset": offset, "mark": c.translate(HALF), "delta_t": None, "verdict": None}
        if at == 0:
            event |= {"kind": "leading_tail", "t_start": 0.0, "t_end": float(starts[0]) if n else None}
        elif at >= n:
            last = float(ends[n - 1])
            event |= {"kind": "trailing_tail", "delta_t": None if duration is None else round(duration - last, 4), "t_start": last, "t_end": duration}
        else:
            before, after = float(ends[at - 1]), float(starts[at])
            delta = round(after - before, 4)
            event |= {"kind": "normal", "delta_t": delta, "verdict": verdict(delta, no_pause, long), "t_start": before, "t_end": after}
        events.append(event)
    at = passed(at, text[done:])
    return ([], True) if at != n else (events, False)


TIMED = PLAN.replace("verdict:string", "verdict:string,t_start:double,t_end:double")


def _joined(ch: pa.Array) -> str | list[str]:
    """Characters as one text, so that a row's are a part of it; as a list where some are not one character."""
    if len(ch) and not ch.null_count and pc.all(pc.equal(pc.utf8_length(ch), 1)).as_py():
        return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(ch)], pa.int32()), ch), "")[0].as_py()
    return ch.to_pylist()


def _plans(t: pa.Array, c: pa.Array, d: pa.Array, kind: str, no_pause: float, long: float) -> pa.Array:
    """struct(plan, unalignable) of texts, their aligned characters and durations."""
    fields = ("offset", "mark", "kind", "delta_t", "verdict", "t_start", "t_end")[: 5 if kind == PLAN else 7]
    types = (pa.int32(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.float64(), pa.float64())
    # of all rows at once: characters as a text, times as arrays, and where each row's begin
    flat, sizes = c.flatten(), c.value_lengths().fill_null(0).to_pylist()
    ch, start, end = (flat.field(k) for k in range(3))
    ch, start, end = _joined(ch), start.to_numpy(zero_copy_only=False), end.to_numpy(zero_copy_only=False)
    made, bad, upto, at = [], [], [0], 0
    for text_, size, dur in zip(t.to_pylist(), sizes, d.to_pylist()):
        chars = ch[at : at + size]
        events, wrong = walk(text_ or "", chars if isinstance(chars, str) else "".join(chars), start[at : at + size], end[at : at + size], dur, no_pause, long)
        made += events
        bad.append(wrong)
        upto.append(len(made))
        at += size
    columns = [pa.array([e[f] for e in made], k) for f, k in zip(fields, types)]
    plans = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.StructArray.from_arrays(columns, fields=[pa.field(f, k) for f, k in zip(fields, types)]))
    return pa.StructArray.from_arrays([plans, pa.array(bad, pa.bool_())], names=["plan", "unalignable"])


def _walks(text: Column, chars: Column, duration: Column, kind: str, no_pause: float, long: float) -> Column:
    @F.arrow_udf(f"struct<plan:{kind},unalignable:boolean>")
    def plan(t: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        return _plans(t, c, d, kind, no_pause, long)

    return plan(text, chars, duration.cast("double"))


#: Bytes of text that are aligned at once; a longer text is aligned by itself.
ALIGNED = 1 << 20


def plan_aligned(text: Column, align: Callable[..., pa.Array], of: list[Column], duration: Column, kind: str = PLAN, no_pause: float = NO_PAUSE_SEC, long: float = LONG_SEC) -> Column:
    """The plan (or, with kind TIMED, the preview) of a text whose characters an aligner of Arrow batches gives, of the text and more columns.

    The characters take some twenty times the bytes of the text, so they are walked where they are made, some texts at a time."""

    @F.arrow_udf(f"struct<plan:{kind},unalignable:boolean>")
    def plan(t: pa.Array, d: pa.Array, *more: pa.Array) -> pa.Array:
        if not len(t):
            return _plans(t, align(t, *more), d, kind, no_pause, long)
        ends, out, begin = np.cumsum(pc.binary_length(t).fill_null(0).to_numpy()), [], 0
        while begin < len(t):
            before = ends[begin - 1] if begin else 0
            n = max(int(np.searchsorted(ends, before + ALIGNED, "right")) - begin, 1)
            part = t.slice(begin, n)
            out.append(_plans(part, align(part, *(m.slice(begin, n) for m in more)), d.slice(begin, n), kind, no_pause, long))
            begin += n
        return pa.concat_arrays(out)

    return plan(text, duration.cast("double"), *of)


def pause_plan(text: Column, chars: Column, duration: Column, no_pause: float = NO_PAUSE_SEC, long: float = LONG_SEC) -> Column:
    """struct(plan, unalignable) of a text, its array of (ch, start_sec, end_sec), and the clip's seconds. Null chars are none."""
    return _walks(text, chars, duration, PLAN, no_pause, long)


def preview(text: Column, chars: Column, duration: Column) -> Column:
    """The same with where each event begins and ends in the clip: between the aligned characters on both sides, or its ends."""
    return _walks(text, chars, duration, TIMED, NO_PAUSE_SEC, LONG_SEC)


def counts(plan: Column) -> dict[str, Column]:
    """n_punct and the number of each verdict."""
    of = lambda v: F.size(F.filter(plan, lambda e: e["verdict"] == v)).cast("int")
    return {"n_punct": F.size(plan).cast("int"), "n_no_pause": of("no_pause"), "n_short": of("short"), "n_long": of("long")}


def _with(value: Column, f) -> Column:
    """f of a value that is computed once, however often f's lambdas name it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def text_pause(text: Column, plan: Column, short: str = SHORT_TOKEN, long: str = LONG_TOKEN) -> Column:
    """The text with pause tokens after marks, and without marks at which there was no pause.

    An event counts only if its mark stands at its offset; of events at one offset the last counts. Native, and linear but for
    the sort of the events: what stands between two of them is taken as a whole."""
    letters = F.when(F.length(text) > 0, F.split(text, "")).otherwise(F.array().cast("array<string>"))

    def tokens(chars: Column) -> Column:
        standing = F.filter(F.coalesce(plan, F.array()), lambda e: F.get(chars, e["offset"]) == e["mark"])
        ordered = F.array_sort(F.transform(standing, lambda e, k: F.struct(e["offset"].alias("offset"), k.alias("k"), e["verdict"].alias("verdict"))))
        last = _with(ordered, lambda es: F.filter(es, lambda e, k: ~F.get(es, k + 1)["offset"].eqNullSafe(e["offset"])))
        return _with(last, lambda es: put(chars, es))

    def put(chars: Column, events: Column) -> Column:
        after = lambda k: F.coalesce(F.get(events, k - 1)["offset"] + 1, F.lit(0))
        between = lambda begin, n: F.array_join(F.slice(chars, begin + 1, n), "")

        def upto(e: Column, k: Column) -> Column:
            c, v = F.get(chars, e["offset"]), e["verdict"]
            c = F.when(v == "no_pause", "").when(v == "short", F.concat(c, F.lit(short))).when(v == "long", F.concat(c, F.lit(long))).otherwise(c)
            return F.concat(between(after(k), e["offset"] - after(k)), c)

        return F.concat(F.array_join(F.transform(events, upto), ""), between(after(F.size(events)), F.size(chars)))

    return _with(letters, tokens)
