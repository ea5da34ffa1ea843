"""Byte-level BPE encoding and decoding with a contiguous rank array.

A word is held as its part boundaries and the merge rank of each adjacent pair. The smallest rank is looked for again
and again; its boundary goes, and the two neighbouring ranks are refreshed. Words of over SHORT bytes use a heap over
the same arrays, so that a text without spaces stays near linear. Distinct words are encoded once for each worker.

Nulls: a null text counts as empty and a null id comes back as null. Empty text: no ids, empty decoded text. Rows may repeat;
every row is encoded. Other columns are ignored by encode() and kept by nothing.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import id_text, null_id, register_cache, tidy

SHORT = 256
#: The byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = 1 << 60


def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary's file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class ByteBPE:
    def __init__(self, path: str, most: int = 300_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_chars()
        back = {c: b for b, c in chars.items()}
        vocab = spec["model"]["vocab"]
        self.byte_id = [vocab[chars[b]] for b in range(256)]
        self.token = [b""] * (max(max(vocab.values()), *(a["id"] for a in spec["added_tokens"])) + 1)
        for text, i in vocab.items():
            self.token[i] = bytes(back[c] for c in text) if all(c in back for c in text) else text.encode()
        self.rank: dict[tuple[int, int], int] = {}
        self.result: list[int] = []
        for k, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = k
            self.result.append(vocab[a + b])
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for text, i in self.added.items():
            self.token[i] = text.encode()
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.split = regex.compile(PATTERN).findall
        # White space runs in which a space is neither first nor last, or not alone: pieces cut at spaces would differ.
        self.odd = regex.compile(r"\s \s|  |\s $").search
        self.most, self.words, self.pieces = most, {}, {}

    def word(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids = [self.byte_id[b] for b in data]
        if len(ids) > SHORT:
            return self._long(ids)
        get, result = self.rank.get, self.result
        ranks = [get(p, _NONE) for p in zip(ids, ids[1:])]
        while ranks:
            r = min(ranks)
            if r == _NONE:
                break
            i = ranks.index(r)
            ids[i] = result[r]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), _NONE)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), _NONE)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.rank.get
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i) for i, p in enumerate(zip(ids, ids[1:])) if (r := get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or get((ids[i], ids[j])) != r:
                continue
            ids[i], alive[j] = self.result[r], False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (x := get((ids[i], ids[after[j]]))) is not None:
                    heapq.heappush(heap, (x, i))
            if before[i] >= 0 and (x := get((ids[before[i]], ids[i]))) is not None:
                heapq.heappush(heap, (x, before[i]))
        return [x for x, ok in zip(ids, alive) if ok]

    def _piece(self, piece: str) -> bytes:
        out = []
        for w in self.split(piece):
            ids = self.words.get(w)
            if ids is None:
                ids = np.array(self.word(w.encode()), "<u4").tobytes()
                if len(w) <= SHORT:
                    self.words[w] = ids
            out.append(ids)
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        if self.odd(text):
            return self._piece(text)
        first, *rest = text.split(" ")
        out, get, pieces = [self._piece(first)] if first else [], self.pieces.get, self.pieces
        for p in rest:
            ids = get(p)
            if ids is None:
                ids = self._piece(" " + p)
                if len(p) <= SHORT:
                    pieces[p] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers; strings of added tokens are those tokens."""
        if len(self.pieces) > self.most:
            self.pieces.clear()
        if len(self.words) > self.most:
            self.words.clear()
        if self.special is None or not (found := list(self.special.finditer(text))):
            return self._plain(text)
        out, at = [], 0
        for m in found:
            if m.start() > at:
                out.append(self._plain(text[at : m.start()]))
            out.append(np.array([self.added[m[0]]], "<u4").tobytes())
            at = m.end()
        return b"".join([*out, self._plain(text[at:])] if at < len(text) else out)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the ids' text; bytes that aren't UTF-8 become U+FFFD."""
        data = b"".join(map(self.token.__getitem__, ids.tolist()))
        try:
            data.decode()
            return data
        except UnicodeDecodeError:
            return data.decode("utf-8", "replace").encode()


_codecs: dict[str, ByteBPE] = {}
register_cache(_codecs.clear, "bpe", "lengths")


def codec(path: str) -> ByteBPE:
    if path not in _codecs:
        _codecs[path] = ByteBPE(path)
    return _codecs[path]


def encode(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int)."""

    def run(batches):
        c = codec(tokenizer)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                p = b.slice(at, 256)
                ids = [np.frombuffer(c.encode(t.decode()), "<i4") for t in p.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([p.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, ids array<int>").select(null_id(), "ids")


def decode(encoded: DataFrame, tokenizer: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text. Null ids give a null text."""

    def run(batches):
        c = codec(tokenizer)
        for b in batches:
            out = [None if x is None else c.decode(np.asarray(x, "<i8")).decode() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return encoded.select(encoded[id_col].cast("long").alias("doc_id"), encoded[ids_col].cast("array<long>").alias("ids")).mapInArrow(tidy(run), "doc_id long, text string")


def digest(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        c = codec(tokenizer)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                p, rows = b.slice(at, 1024), []
                for t in p.column(1).to_pylist():
                    ids = c.encode(t.decode())
                    rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(c.decode(np.frombuffer(ids, "<u4"))).hexdigest()))
                n, a, d = zip(*rows)
                yield pa.RecordBatch.from_arrays([p.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(d)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return id_text(docs, id_col, text_col).mapInArrow(tidy(run), schema).select(null_id(), "n_tokens", "ids_sha256", "decoded_sha256")


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
