"""Packing of token sequences: first-fit decreasing with a tournament tree, within randomised groups of documents.

Documents are tokenised where they are read. Full pieces are sequences of their own; what is left of each document is
packed with that of its group, a few thousand documents dealt out by a hash of the row. The tree holds bin capacities
with the maximum of each pair above it, so the first bin that fits is found in one descent. A group's rows are bounded
by its number of documents and their length; one shuffle carries a few numbers a piece, and 4 bytes a token only where ids are asked for.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.bpe import byte_symbols
from corvane.llm.common import keeps, ship, table, whole

SIZE = 1024
GROUP_DOCS = 4096
SEPARATOR = 0

def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: The split of byte-level vocabularies without backing off into a run that has matched; the same pieces as of the library's own pattern.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


class Tokens:
    """Ids of whole texts as the tokenizers library gives them for a file of its own.

    Byte-level BPE whose ids stand in the order of its merges, without a normaliser, is read into tiktoken, which has the same
    ids at a third of the time; any other file is left to the library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        self.path, self.library, self.core = path, None, None
        added = j.get("added_tokens") or []
        self.special = {t["content"]: t["id"] for t in added}
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        ranks = self._ranks(j) if not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")) else None
        if ranks is not None:
            import tiktoken

            self.core = tiktoken.Encoding("corvane", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})._core_bpe

    @staticmethod
    def _ranks(j: dict) -> dict[bytes, int] | None:
        """The id of each string of bytes, if the file is of the kind whose merges go by the id of what they make."""
        model, before = j["model"], j.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and j.get("normalizer") is None and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            return None
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab[a + b] for a, b in merges]
        byte = {c: b for b, c in enumerate(byte_symbols())}
        special = {t["content"] for t in j.get("added_tokens") or []}
        words = {t: i for t, i in vocab.items() if t not in special}
        if any(a >= b for a, b in zip(made, made[1:])) or not set(byte) <= set(vocab) or len(words) != len(byte) + len(made) or max(vocab[c] for c in byte) >= min(made, default=1 << 31):
            return None
        return {bytes(byte[c] for c in t): i for t, i in words.items()}

    def _by_library(self, text: str) -> list[int]:
        if self.library is None:
            from tokenizers import Tokenizer

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            self.library = Tokenizer.from_file(self.path)
            self.library.no_truncation()
            self.library.no_padding()
        return self.library.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        if self.core is None:
            return self._by_library(text)
        if not self.split_special.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.split_special.finditer(text):
            out += [*self._plain(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[int]:
        try:
            return self.core.encode_ordinary(text)
        except BaseException as e:  # a panic: the split runs out of its own stack on some hundred thousand white spaces in a row
            if type(e).__name__ != "PanicException":
                raise
            return self._by_library(text)


_loaded: dict[str, Tokens] = {}


def release() -> None:
    _loaded.clear()


def load(path: str) -> Tokens:
    if path not in _loaded:
        _loaded[path] = Tokens(path)
    return _loaded[path]


def first_fit_decreasing(lengths: list[int], size: int) -> list[int]:
    """The bin of each length (none over `size`), by first fit in decreasing order; ties in the order given."""
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [size] * (2 * leaves)  # the capacity of each bin, and above two nodes the larger
    out = [0] * n
    for i in sorted(range(n), key=lambda i: -lengths[i]):
        need, node = lengths[i], 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        out[i] = node - leaves
        tree[node] -= need
        node //= 2
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a > b else b
            node //= 2
    return out


def _pack_group(group: pa.Table, size: int, with_ids: bool, id_col: str) -> pa.Table:
    length, ids = group.column("length").to_pylist(), group.column("ids").to_pylist()
    start, whole_docs = group.column("start").to_pylist(), group.column("doc_tokens").to_pylist()
    crc, key = group.column("ids_crc32").to_pylist(), group.column("_g")[0].as_py()
    order = sorted(range(len(length)), key=lambda i: (length[i] == size, -length[i], whole_docs[i], crc[i], start[i]))  # whatever order rows arrive in
    tail = [i for i in order if length[i] < size]
    bins = first_fit_decreasing([length[i] for i in tail], size)
    sequence, offset, used = [0] * len(length), [0] * len(length), {}
    for i, b in zip(tail, bins):
        sequence[i], offset[i] = b, used.get(b, 0)
        used[b] = offset[i] + length[i]
    for k, i in enumerate(order[len(tail) :]):
        sequence[i] = len(used) + k
    columns = [group.column(id_col).combine_chunks(), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(whole_docs, pa.int64()), pa.array([key << 32 | s for s in sequence], pa.int64()), pa.array(offset, pa.int64())]
    if with_ids:
        columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
    return pa.Table.from_arrays(columns, names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, size: int = SIZE, group_docs: int = GROUP_DOCS, seed: int = 0, with_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) for each piece of each row of df.

    A document is the ids of its text and a final 0; null and empty texts are that 0 alone. Each id lies in one piece.
    A text of any length is tokenised whole, one at a time in a worker. Rows that repeat a document are packed each; of an equal length, the order is that of their contents. Null ids are
    allowed. An empty table gives an empty result. Other columns are not read.
    """
    path = path or default_path()
    ship(df.sparkSession)
    groups = max(1, -(-df.count() // group_docs))
    kind = df.schema[id_col].dataType.simpleString()

    @keeps("packing")
    def tokens(batches):
        t = load(path)
        for b in batches:
            row, start, length, crc, whole_docs, part = [], [], [], [], [], []
            for k, x in enumerate(b.column(1)):
                ids = array("I", t.ids(x.as_py() or ""))
                ids.append(SEPARATOR)
                raw, n = memoryview(ids).cast("B"), len(ids)
                for at in range(0, n, size):
                    m = min(size, n - at)
                    row.append(k)
                    start.append(at)
                    length.append(m)
                    crc.append(zlib.crc32(raw[4 * at : 4 * (at + m)]))
                    whole_docs.append(n)
                    part.append(bytes(raw[4 * at : 4 * (at + m)]) if with_ids else None)
            row = pa.array(row, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(row), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(whole_docs, pa.int64()), pa.array(part, pa.binary()), b.column(2).take(row)], names=[id_col, "start", "length", "ids_crc32", "doc_tokens", "ids", "_g"])

    group = F.pmod(F.xxhash64(F.col(id_col), F.crc32(F.encode(whole(F.col(text_col)), "UTF-8")), F.lit(seed)), F.lit(groups)).alias("_g")
    pieces = df.select(F.col(id_col), F.col(text_col), group).mapInArrow(tokens, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary, _g long")
    out = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return pieces.groupBy("_g").applyInArrow(lambda t: _pack_group(t, size, with_ids, id_col), out)


def op2_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
