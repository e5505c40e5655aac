"""Edit distance of whole texts, in time that goes by how much they differ."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Of the shorter text: from so many edits on, all of it is compared with all of the other.
FAR = 8


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _packed(codes: np.ndarray) -> np.ndarray:
    """At each place, the 8 bytes from there on, the first one lowest."""
    padded = np.concatenate([codes, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view("<u8").ravel()


def near_distance(a: str, b: str, most: int) -> int | None:
    """The distance, or None if it is over `most`: how far each diagonal gets with one edit more, all diagonals at once."""
    x, y = _codes(a), _codes(b)
    n, m = len(x), len(y)
    signs = np.unique(np.concatenate([x, y]))
    if len(signs) < 254:  # a byte a character, so eight are compared at a time; the ends are bytes that differ
        width, x, y = 8, np.searchsorted(signs, x).astype(np.uint8) + 2, np.searchsorted(signs, y).astype(np.uint8) + 2
        x, y = _packed(np.append(x, np.uint8(0))), _packed(np.append(y, np.uint8(1)))
    else:
        width, x, y = 1, np.append(x, np.uint32(0xFFFFFFFE)), np.append(y, np.uint32(0xFFFFFFFF))
    one = np.uint64(1)

    def slide(i: np.ndarray, k: np.ndarray) -> None:
        """Moves the places i on the diagonals k past what is equal."""
        at, still = None, i
        while len(still):
            diff = x[still] ^ y[still - k]
            if width == 8:
                low = np.bitwise_count((diff & (~diff + one)) - one) >> 3  # equal bytes before the first that differs; 8 if none does
                still = still + low
                go = np.flatnonzero(low >= 8)
            else:
                go = np.flatnonzero(diff == 0)
                still[go] += 1
            if at is None:
                i[:] = still
                at = go
            else:
                i[at] = still
                at = at[go]
            still, k = i[at], k[go]

    # place k + most + 1 has how far in a the diagonal k (in a less in b) gets; -2: not reached
    far = np.full(2 * most + 3, -2, np.int64)
    ks = np.arange(-most - 1, most + 2)
    top, end = most + 1, n - m + most + 1
    if not 0 < end < len(far) - 1:
        return None
    begin = np.zeros(1, np.int64)
    slide(begin, ks[top : top + 1])
    far[top] = begin[0]
    for e in range(most + 1):
        if far[end] >= n:
            return e
        if e == most:
            break
        lo, hi = max(top - e - 1, top - m), min(top + e + 1, top + n)
        lo, hi = max(lo, 1), min(hi, len(far) - 2)
        k = ks[lo : hi + 1]
        i = np.maximum(np.maximum(far[lo : hi + 1] + 1, far[lo - 1 : hi] + 1), far[lo + 1 : hi + 2])
        np.minimum(i, n, out=i)
        np.minimum(i, m + k, out=i)
        slide(i, k)
        far[lo : hi + 1] = i
    return None


def any_distance(a: str, b: str) -> int:
    """The distance of any two texts: a column of the table at a time, as bits of where it rises and falls."""
    n = len(a)
    if not n:
        return len(b)
    places: dict[str, int] = {}
    for c in set(a):
        places[c] = int("".join("1" if d == c else "0" for d in reversed(a)), 2)
    every, last, score = (1 << n) - 1, 1 << n - 1, n
    rises, falls = every, 0
    for c in b:
        eq = places.get(c, 0)
        flat = (((eq & rises) + rises) ^ rises) | eq | falls
        up, down = falls | (every & ~(flat | rises)), rises & flat
        score += bool(up & last) - bool(down & last)
        up, down = (up << 1) | 1, down << 1
        rises, falls = (down | (every & ~(flat | up))) & every, up & flat & every
    return score


def distance(a: str, b: str) -> int:
    """Characters put in, left out or replaced to make one text of the other."""
    if a == b:
        return 0
    if not a or not b:
        return len(a) + len(b)
    least = min(len(a), len(b))
    found = near_distance(a, b, max(least // FAR, 32))
    return any_distance(a, b) if found is None else found


def edit_distance(a: Column, b: Column) -> Column:
    """The distance of two texts; null if one is null."""

    @F.arrow_udf("int")
    def apart(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else distance(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int32())

    return apart(a, b)
