import hashlib
import zlib

import numpy as np
import pytest

from corvane.llm import bpe, packing
from tests.conftest import DATA

TEXTS = [
    "", "  ", "Hello's WORLD 123 ½ x² ΣΑΣ ς <|endoftext|> foo<|startoftext|>bar", "a" * 3000 + " " + "abc" * 100, "日本語 テスト 한국어", "éa İstanbul ǅ _under_ '' 's 'LL 'll  \n\n x\t\ty  ",
    "a\u0085b c\x1cd\x1fe f", "🙂🙂 x🙂y", "​‍ a​b", "٣٤ Ⅷ ⅷ", "don't I'd we'LL", "İı ẞ ß", " ".join(chr(i) for i in range(1, 0x300)), "a  \n b \r\n\r\n  c   ", "_ __a_b 1_2 ", "<|ENDOFTEXT|>",
]


@pytest.fixture(scope="module")
def corpus(spark):
    return TEXTS + [r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


def library(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_is_the_library_s(corpus):
    t, own = library("word_bpe_49k.json"), bpe.WordBPE()
    for x in corpus:
        ids = t.encode(x, add_special_tokens=False).ids
        assert own.encode(x) == ids
        assert own.decode(ids) == t.decode(ids, skip_special_tokens=False)


def test_long_words_take_the_heap(monkeypatch):
    own = bpe.WordBPE()
    words = [b"abcabcabc", "überüber".encode(), b"zzzzzzzzzzzz", b"q"]
    for w in words:
        assert own._merge_long(w) == own._merge_short([w])[0]


def test_bpe_table(spark, docs):
    rows = [(1, "Hi there"), (2, None), (None, ""), (1, "Hi there")]
    got = bpe.bpe_table(docs(rows), returns=("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(got) == 4
    for r in got:
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
    assert bpe.bpe_table(docs([])).collect() == []


def test_a_step_with_more_new_words_than_are_kept(monkeypatch):
    """Words that were kept before a step are still there when its new ones fill the cache."""
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    own, t = bpe.WordBPE(), library("word_bpe_49k.json")
    texts = ["hello there", " ".join(f"w{i}x" for i in range(400)) + " hello there", "hello again " + " ".join(f"v{i}" for i in range(60)), "<|endoftext|> hello w7x"]
    for x in [*texts, *texts[::-1]]:
        assert own.encode(x) == t.encode(x, add_special_tokens=False).ids
    assert [[e[3] for e in text] for text in own.entries(texts)] == [[own.encode(w) for w in own.split(x) if isinstance(w, str)] if i < 3 else [[49407], own.encode("hello"), *[[k] for k in ()], *[own.encode(w) for w in own.split("w7x")]] for i, x in enumerate(texts)]


def test_packing_ids_are_the_library_s(corpus):
    t, own = library("byte_bpe_50k.json"), packing.load(packing.default_path())
    assert own.core is not None
    for x in [*corpus, "a\n\n", " " * 3, "x  \t ", "I've 've'll 'S a's", "\u3000 \u3000x", "a" * 5000, " " * 5000 + "b"]:
        assert own.ids(x) == t.encode(x, add_special_tokens=False).ids


def test_packing_leaves_what_it_cannot_read_to_the_library(tmp_path):
    """A run of white space that is too long for the split, and a file of another kind."""
    t, own = library("byte_bpe_50k.json"), packing.Tokens(packing.default_path())
    x = "a" + " " * 1_500_000 + "b"
    assert own.ids(x) == t.encode(x, add_special_tokens=False).ids
    import public_tokenizers

    words, own = library("word_bpe_49k.json"), packing.Tokens(public_tokenizers.path("word_bpe_49k.json"))
    assert own.core is None and own.ids("Hello, World's") == words.encode("Hello, World's", add_special_tokens=False).ids


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 7, 300):
        lengths = rng.integers(1, 65, n).tolist()
        fill, want = [], [0] * n
        for i in sorted(range(n), key=lambda i: -lengths[i]):
            b = next((k for k, f in enumerate(fill) if f + lengths[i] <= 64), len(fill))
            if b == len(fill):
                fill.append(0)
            fill[b] += lengths[i]
            want[i] = b
        assert packing.first_fit_decreasing(lengths, 64) == want


def test_pack_round_trip(spark, docs):
    texts = [None, "", "word " * 3000, "a b c"] + ["some words in a text of its own %d " % i * (i % 40) for i in range(60)]
    rows = list(enumerate(texts)) + [(3, "a b c")]
    got = packing.pack(docs(rows), size=64, group_docs=16, with_ids=True).collect()
    t = library("byte_bpe_50k.json")
    by_doc, by_seq = {}, {}
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert len(r["ids"]) == r["length"]
        by_doc.setdefault(r["doc_id"], {}).setdefault(r["start"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for i, x in enumerate(texts):
        ids = [k for s in sorted(by_doc[i]) for k in by_doc[i][s][0]["ids"]]
        assert ids == t.encode(x or "", add_special_tokens=False).ids + [0]
        assert {r["doc_tokens"] for p in by_doc[i].values() for r in p} == {len(ids)}
    assert len(by_doc[3][0]) == 2
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    assert packing.pack(docs([])).collect() == []
