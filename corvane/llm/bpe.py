"""Byte-pair encoding and decoding with a contiguous rank array.

A short word is held as its parts and, beside them, the merge ranks of adjacent parts. The least rank is found by a
scan, its boundary deleted, and the ranks on both sides refreshed. Words of similar length go through this together, as
rows of one matrix. Words over SHORT bytes, where scanning again and again would be quadratic, take a heap of ranks
over linked parts, with the same result. Each worker keeps what it has encoded, about CACHE_WORDS distinct words in each of
two halves, of which the older goes when the newer is full.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from corvane.llm.common import PLAIN, keeps, ship, table

SHORT = 64
CACHE_WORDS = 120_000
NONE = np.int32(2**31 - 1)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class WordBPE:
    """A vocabulary with word ends, of a file of the tokenizers library: NFC, white space and case folded, split, merged."""

    def __init__(self, path: str | None = None):
        j = json.load(open(path or default_path(), encoding="utf-8"))
        self.vocab: dict[str, int] = j["model"]["vocab"]
        self.end = j["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        pattern = j["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.plain = PLAIN  # over texts in which this finds nothing, the next pattern is the same as the one above
        self.plain_words = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+") if pattern == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" else None
        symbols = byte_symbols()
        self.inner = np.array([self.vocab[s] for s in symbols], np.int32)
        self.last = np.array([self.vocab[s + self.end] for s in symbols], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in j["model"]["merges"]]
        keys = np.array([self.vocab[a] << 32 | self.vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        keep = np.r_[True, np.diff(keys[order]) != 0] if len(order) else np.zeros(0, bool)
        self.keys = np.r_[keys[order][keep], np.int64(2**62)]
        self.rank = np.r_[order[keep], 0].astype(np.int32)
        self.made = np.r_[np.array([self.vocab[a + b] for a, b in merges], np.int32)[order[keep]], np.int32(0)]
        self.pair = {int(k): (int(r), int(m)) for k, r, m in zip(self.keys[:-1], self.rank, self.made)} if len(keys) else {}
        self.cache: dict[str, tuple[int, str, str, list[int]]] = {}
        self.older: dict[str, tuple[int, str, str, list[int]]] = {}

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a.astype(np.int64) << 32 | b
        i = np.searchsorted(self.keys, key)
        hit = self.keys[i] == key
        return np.where(hit, self.rank[i], NONE), i

    def _merge_short(self, words: list[bytes]) -> list[list[int]]:
        """Words of one length in bytes."""
        n, size = len(words), len(words[0])
        raw = np.frombuffer(b"".join(words), np.uint8).reshape(n, size)
        parts = self.inner[raw]
        parts[:, -1] = self.last[raw[:, -1]]
        out: list[list[int]] = [[]] * n
        who = np.arange(n)
        ranks = np.full((n, size), NONE, np.int32)  # the last column stays without a neighbour
        if size > 1:
            ranks[:, :-1] = self._ranks(parts[:, :-1], parts[:, 1:])[0]
        while True:
            at = ranks.argmin(1)
            rows = np.arange(len(who))
            live = ranks[rows, at] != NONE
            if not live.all():
                for w, p in zip(who[~live], parts[~live].tolist()):
                    out[w] = p
                who, parts, ranks, at = who[live], parts[live], ranks[live], at[live]
                rows = np.arange(len(who))
            if not len(who):
                return out
            new = self.made[self._ranks(parts[rows, at], parts[rows, at + 1])[1]]
            cols = np.arange(parts.shape[1] - 1)
            move = cols[None, :] + (cols[None, :] > at[:, None])
            parts = np.take_along_axis(parts, move, 1)
            parts[rows, at] = new
            ranks = np.take_along_axis(ranks, cols[None, :] + (cols[None, :] >= at[:, None]), 1)
            left = at > 0
            ranks[rows[left], at[left] - 1] = self._ranks(parts[rows[left], at[left] - 1], new[left])[0]
            right = at < parts.shape[1] - 1
            ranks[rows[right], at[right]] = self._ranks(new[right], parts[rows[right], at[right] + 1])[0]
            ranks[rows[~right], at[~right]] = NONE

    def _merge_long(self, word: bytes) -> list[int]:
        parts = [*self.inner[np.frombuffer(word[:-1], np.uint8)].tolist(), int(self.last[word[-1]])]
        n = len(parts)
        after, before, alive = [*range(1, n + 1)], [*range(-1, n - 1)], [True] * n
        heap = []

        def push(i: int) -> None:
            if i >= 0 and after[i] < n and (hit := self.pair.get(parts[i] << 32 | parts[after[i]])):
                heapq.heappush(heap, (hit[0], i, parts[i], parts[after[i]], hit[1]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            if not alive[i] or parts[i] != a or after[i] >= n or parts[after[i]] != b:
                continue
            gone = after[i]
            parts[i], alive[gone], after[i] = new, False, after[gone]
            if after[i] < n:
                before[after[i]] = i
            push(before[i])
            push(i)
        return [p for p, x in zip(parts, alive) if x]

    def _learn(self, words: list[str]) -> None:
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            by_size.setdefault(len(b := w.encode()), []).append((w, b))
        for size, same in by_size.items():
            if size > SHORT:
                made = [self._merge_long(b) for _, b in same]
            else:
                made = [x for k in range(0, len(same), 8192) for x in self._merge_short([b for _, b in same[k : k + 8192]])]
            for (w, _), ids in zip(same, made):
                self.cache[w] = (len(ids), " ".join(map(str, ids)), " ".join(map(self.token.__getitem__, ids)), ids)

    def split(self, text: str) -> list[str | int]:
        """Words, and the ids of special tokens."""
        if "<|" in text and self.split_special.search(text):
            out: list[str | int] = []
            at = 0
            for m in self.split_special.finditer(text):
                out += [*self._words(text[at : m.start()]), self.special[m[0]]]
                at = m.end()
            return out + self._words(text[at:])
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma: letters are lowered one by one
        text = text.lower()
        if self.plain_words and not self.plain.search(text):
            return self.plain_words.findall(text)
        return self.words.findall(text)

    def entries(self, texts: list[str]) -> Iterator[list[tuple[int, str, str, list[int]]]]:
        """For each text, its words as (ids, the ids in decimal, the tokens, the ids)."""
        for k in range(0, len(texts), 64):
            split = [self.split(t) for t in texts[k : k + 64]]
            words = set(chain.from_iterable(split)).difference(self.special.values())
            if new := words.difference(self.cache):
                if len(self.cache) + len(new) > CACHE_WORDS:  # words in use come back from the older half; those of a step are all kept for it
                    self.older, self.cache = self.cache, {}
                    new = words
                known = {w: self.older[w] for w in new if w in self.older}
                self.cache.update(known)
                self._learn(list(new.difference(known)))
            get = self.cache.__getitem__
            for words in split:
                try:
                    yield list(map(get, words))
                except KeyError:
                    yield [(1, str(w), self.token[w], [w]) if w.__class__ is int else self.cache[w] for w in words]

    def encode(self, text: str) -> list[int]:
        return [i for e in next(self.entries([text])) for i in e[3]]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by a space, as the library does without a decoder; ids it does not know are passed over."""
        return " ".join(self.token[i] for i in ids if i in self.token)


_loaded: dict[str, WordBPE] = {}


def release() -> None:
    _loaded.clear()


def load(path: str) -> WordBPE:
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


def _hex(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def bpe_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, returns: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """(id, and of n_tokens, ids, decoded, ids_sha256, decoded_sha256 those in `returns`) for each row of df.

    Null texts are empty: no ids, and the decoded text is empty. Texts of any length and of any number of words are encoded whole. Rows are independent, so repeated rows, ties and null
    ids give a row each. Other columns are not read. `decoded` is the decoding of the ids.
    """
    path = path or default_path()
    kinds = {"n_tokens": ("long", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}
    make = {
        "n_tokens": lambda e: sum(x[0] for x in e),
        "ids": lambda e: [i for x in e for i in x[3]],
        "decoded": lambda e: " ".join([x[2] for x in e]),
        "ids_sha256": lambda e: _hex(" ".join([x[1] for x in e])),
        "decoded_sha256": lambda e: _hex(" ".join([x[2] for x in e])),
    }
    ship(df.sparkSession)
    id_type = df.schema[id_col].dataType.simpleString()

    @keeps("bpe")
    def run(batches):
        bpe = load(path)
        for b in batches:
            out: dict[str, list] = {r: [] for r in returns}
            for e in bpe.entries([t or "" for t in b.column(1).to_pylist()]):
                for r in returns:
                    out[r].append(make[r](e))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(out[r], kinds[r][1]) for r in returns)], names=[id_col, *returns])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, " + ", ".join(f"{r} {kinds[r][0]}" for r in returns))


def op5_bpe(spark, sf_dir):
    return bpe_table(table(spark, sf_dir, "documents"), returns=("n_tokens", "ids_sha256", "decoded_sha256"))
