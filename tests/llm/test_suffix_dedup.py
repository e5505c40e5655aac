import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from corvane.llm import suffix_dedup as S


def brute(texts, length):
    seen = {}
    raws = [(t or "").encode() for t in texts]
    for r in raws:
        for i in range(len(r) - length + 1):
            seen[r[i : i + length]] = seen.get(r[i : i + length], 0) + 1
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(r, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(df, **k):
    out = {}
    for r in S.without_repeats(df.select("doc_id", "text", "_id"), **k).collect():
        spans = S.merged(np.array(r["spans"], np.int64), len(r["raw"]))
        kept = S.cut_out(bytes(r["raw"]), spans)
        out.setdefault(r["doc_id"], []).append((len(r["raw"]), len(r["raw"]) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def texts():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, edge = text(80), text(200)
    out = [text(60) + passage + text(60), passage, text(5) + passage[:230] + text(50), passage[1:201], passage[:199], edge[:400], text(9) + edge[300:700] + text(3)]
    out += [text(300), "ab" * 300, "x" * 199, "x" * 200, "y" * 201, None, "", text(20)]
    twice = text(50)
    out += [twice + text(30) + twice, edge[350:560], edge[340:550] + "z"]
    out += [out[7], passage + edge]
    for _ in range(20):
        a = rng.randrange(0, 500)
        out.append(text(rng.randrange(20)) + edge[a : a + rng.randrange(150, 420)] + text(rng.randrange(20)))
    return out


@pytest.mark.parametrize("bits", [None, 1 << 20, 1 << 15])
def test_every_repeated_byte_and_no_other(docs, bits):
    rows = list(enumerate(texts()))
    want = brute([t for _, t in rows], 200)
    got = run(docs(rows), bits=bits)
    for i, t in rows:
        assert got[i] == [want[i]], (i, t)


def test_chunks(docs, monkeypatch):
    """Runs and blocks that pass the end of a chunk of the buffer; in this process, as workers have their own module."""
    monkeypatch.setattr(S, "CHUNK", 256)
    rows = [t for t in texts() if t]
    raw, bounds = S._buffer(pa.array(rows))
    all_ = np.full(1 << 10, 255, np.uint8)
    small = sorted((int(t), int(s), int(x)) for text, start, _, lead, _, _ in S.blocks(raw, bounds, [all_, all_, all_], 200, 96) for t, s, x in zip(text, start, lead))
    monkeypatch.setattr(S, "CHUNK", 1 << 18)
    large = sorted((int(t), int(s), int(x)) for text, start, _, lead, _, _ in S.blocks(raw, bounds, [all_, all_, all_], 200, 96) for t, s, x in zip(text, start, lead))
    assert small == large
    windows = [(k, int(bounds[k]) + i) for k, t in enumerate(rows) for i in range(len(t.encode()) - 199)]
    assert [(t, s) for t, s, _ in large] == windows


@pytest.mark.parametrize("cutoff", [1, 16, 1 << 13])
def test_multikey_order(monkeypatch, cutoff):
    monkeypatch.setattr(S, "CUTOFF", cutoff)
    rng = np.random.default_rng(0)
    for high in (1, 5, 10**6):
        cols = [rng.integers(-high, high, 3000) for _ in range(5)]
        order = S.multikey_order(cols)
        rows = list(zip(*(c[order].tolist() for c in cols)))
        assert rows == sorted(rows) and sorted(order.tolist()) == list(range(3000))
    assert S.multikey_order([np.zeros(0, np.int64)] * 5).tolist() == []


def test_heads_are_in_the_order_of_bytes():
    raw = np.frombuffer("zz aaé b".encode() + bytes([0, 127, 128, 255]) * 9, np.uint8)
    at = np.arange(len(raw) - 8)
    heads = S._head(raw, at)
    assert [i for _, i in sorted((int(h), int(i)) for h, i in zip(heads, at))] == sorted(at.tolist(), key=lambda i: (raw[i : i + 8].tobytes(), i))


def test_copies_of_one_text_are_one_row_in_the_sort(spark, docs):
    """However many copies a text has, its suffixes stand once; a text that holds it loses that part, and its own text stays."""
    from corvane.llm.common import Cuts

    copy = " ".join(str(i * i) for i in range(200))
    rows = [(i, copy) for i in range(3000)] + [(5000, "own words before it " + copy + " and after")]
    seen = []
    was, S.repeated = S.repeated, lambda rows, *a: seen.append(rows.count()) or was(rows, *a)
    try:
        spans = S.repeated_spans(docs(rows), Cuts(spark))
        assert spans.count() == 2
    finally:
        S.repeated = was
    assert max(seen) < 3 * len(copy)
    got = run(docs(rows))
    want = brute([copy, copy, rows[-1][1]], 200)
    assert got[5000] == [want[2]] and got[0] == [want[0]] == got[2999]


def test_empty_table_repeated_rows_and_long_text(docs):
    assert run(docs([])) == {}
    long = " ".join(str(i * i) for i in range(120_000))
    got = run(docs([(1, "z" * 250), (1, "z" * 250), (2, long), (None, "short")]))
    assert [x[1] for x in got[1]] == [250, 250]
    assert got[None][0][1] == 0 and got[2][0][1] == brute([long[:1000]], 200)[0][1] == 0
