"""Substring dedup: repeated runs of words, found with a compressed FM-index per shard.

Content decides the shard. Each window of ``width`` words belongs to its minimizer, the smallest hash among its runs of GRAM words, so
equal windows meet in one shard however the documents are split. Windows of one minimizer side by side form a
segment. Segments whose minimizer stands nowhere else are unique and stop there; the others go to
their shard, each distinct one of a unit once. A shard indexes its distinct segments (a suffix order, its BWT in a wavelet matrix of bit
vectors with counts) and streams them through backward search: a match grows leftwards by rank queries, is reported
at ``width`` words with the smallest document of its suffix interval, and is shortened by a word on the right before it grows on.
Minimizers of very many units are dealt out by whole windows instead.

A word is removed if a window that covers it also starts in a document with a smaller id. Windows are those of the input. Words lie between ASCII
white space. Nulls: a null text has no words; null ids are equal and the largest. Rows of one id never remove from each other.
Empty table: no rows. Other columns are carried along, but for those called like a count, which it replaces (``names`` names the counts).
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import exchange_parts, get_table, put_table, without, work_dir
from ._units import LOW, finish, meet, stage, texts_of

WIDTH, GRAM = 13, 4
#: Text of a unit. Its words are objects of some ten times their bytes, in each of an executor's workers.
UNIT_BYTES = 6 << 20
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def least_in_windows(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value in each window; in blocks, since argmin copies its windows."""
    views = np.lib.stride_tricks.sliding_window_view(h, width)
    return np.concatenate([views[at : at + 65536].argmin(axis=1) + np.arange(at, min(at + 65536, len(views))) for at in range(0, len(views), 65536)])


class Segments:
    """Words of a unit's documents and their windows by minimizer."""

    def __init__(self, texts: list[bytes], width: int):
        self.words: list[bytes] = []
        counts = []
        for t in texts:
            w = t.split()
            counts.append(len(w))
            self.words += w
        self.counts = np.array(counts, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))
        n, gram = len(self.words), min(GRAM, width)
        self.first = self.last = self.doc = np.zeros(0, np.int64)
        self.hash = np.zeros(0, np.uint64)
        if n < width:
            return
        one = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, n)
        h = one[: n - gram + 1]
        for k in range(1, gram):
            h = h * _MULTIPLY + one[k : n - gram + 1 + k]
        h = _mix(h)
        low = least_in_windows(h, width - gram + 1)
        doc = np.repeat(np.arange(len(counts)), self.counts)[: len(low)]
        at = np.flatnonzero(np.arange(len(low)) + width <= self.starts[doc + 1])  # windows inside a document
        if not len(at):
            return
        low, doc = low[at], doc[at]
        head = np.flatnonzero(np.concatenate(([True], (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]))))
        self.first, self.last = at[head], at[np.append(head[1:], len(at)) - 1]  # first and last window
        self.doc, self.hash = doc[head], h[low[head]]


class WaveletMatrix:
    """Rank over integers; one bit vector with counts per bit of the alphabet."""

    def __init__(self, data: np.ndarray, sigma: int):
        self.bits, self.n = max(1, int(sigma - 1).bit_length()), len(data)
        self.words, self.ones, self.zeros = [], [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (data >> level) & 1
            padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
            padded[: self.n] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.words.append(words)
            self.ones.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64))))
            self.zeros.append(self.n - int(self.ones[-1][-1]))
            data = np.concatenate((data[bit == 0], data[bit == 1]))
        self.begin = self._walk(np.arange(sigma), np.zeros(sigma, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.bits):
            block = at >> 6
            ones = self.ones[k][block] + np.bitwise_count(self.words[k][block] & ((LOW << (at & 63).astype(np.uint64)) - LOW))
            at = np.where((symbol >> (self.bits - 1 - k)) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._walk(symbol, at) - self.begin[symbol]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in order, by prefix doubling; ends at once where all ranks differ."""
    rank, k, n = np.unique(text, return_inverse=True)[1].astype(np.int64), 1, len(text)
    while True:
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        del key
        if new[-1] == n - 1 or k >= n:
            return order
        rank[order] = new
        k *= 2


class FMIndex:
    """Index of segments (lists of words) with a document number each."""

    def __init__(self, segments: Iterable[list[bytes]], docs: np.ndarray, width: int):
        self.width = width
        vocab: dict[bytes, int] = {}
        words, sizes = array("q"), array("q")
        for s in segments:  # one segment's words at a time; numbers are an eighth of them
            words.extend(vocab.setdefault(w, len(vocab) + 1) for w in s)
            sizes.append(len(s))
        self.size = np.array(sizes, np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size + 1)))[:-1]
        n, count = len(words) + len(sizes), len(sizes)
        text = np.zeros(n, np.int64)  # symbol 0 ends a segment
        where = np.ones(n, bool)
        where[self.start + self.size] = False
        text[where] = np.frombuffer(words, np.int64) if words else 0
        del words
        own = text + count - 1  # every end sorts as a symbol of its own
        own[~where] = np.arange(count)
        order = suffix_order(own)
        sigma = len(vocab) + 1
        del vocab, where
        self.tree = WaveletMatrix(text[order - 1], sigma)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))[:-1]
        self.text = text
        # Neighbours in suffix order that agree in width-1 and in width words; ends agree with nothing.
        same, k = np.ones(max(0, n - 1), bool), 0
        for k in range(width):
            if k == width - 1:
                shorter = same.copy()
            x = own[np.minimum(order + k, n - 1)]
            same &= (x[1:] == x[:-1]) & (order[1:] + k < n) & (order[:-1] + k < n)
        self.low, self.high = self._spans(shorter)
        heads = np.flatnonzero(np.concatenate(([True], ~same)))
        least = np.minimum.reduceat(np.repeat(docs, self.size + 1)[order], heads)
        self.least = np.repeat(least, np.diff(np.append(heads, n)))

    @staticmethod
    def _spans(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        heads = np.flatnonzero(np.concatenate(([True], ~same)))
        ends = np.append(heads[1:], len(same) + 1)
        return np.repeat(heads, ends - heads), np.repeat(ends, ends - heads)

    def matches(self) -> np.ndarray:
        """For every place of the text that starts a window, the smallest document that holds the window."""
        out = np.full(len(self.text), np.iinfo(np.int64).max)
        lo, hi = np.zeros(len(self.size), np.int64), np.full(len(self.size), len(self.text), np.int64)
        length = np.zeros(len(self.size), np.int64)
        for step in range(1, int(self.size.max(initial=0)) + 1):
            on = np.flatnonzero(self.size >= step)
            at = self.start[on] + self.size[on] - step
            c, a, b = self.text[at], lo[on], hi[on]
            full = length[on] == self.width  # shorten the match by its last word
            a, b = np.where(full, self.low[a], a), np.where(full, self.high[lo[on]], b)
            a, b = self.before[c] + self.tree.rank(c, a), self.before[c] + self.tree.rank(c, b)
            lo[on], hi[on], length[on] = a, b, np.minimum(length[on] + 1, self.width)
            done = length[on] == self.width
            out[at[done]] = self.least[a[done]]
        return out


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a) for a in arrays], "<u4").tobytes()
    return zstandard.compress(head + b"".join(a.tobytes() for a in arrays), 1)


def _unpack(data: bytes, *kinds) -> list[np.ndarray]:
    data, out = zstandard.decompress(data), []
    sizes, at = np.frombuffer(data, "<u4", len(kinds)), 4 * len(kinds)
    for n, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, names: tuple[str, ...] = ("n_words", "n_removed")) -> DataFrame:
    """The documents with repeated words removed, and n_words, n_removed. A text without removals stays as it is; else kept words are joined by a space."""
    out = work_dir(docs.sparkSession, "substrings")

    def anchors(texts):
        return Segments(texts, width).hash

    def send(path, unit, kept, parts):
        ids, texts = texts_of(unit)
        s = Segments(texts, width)
        at = np.searchsorted(kept | LOW, s.hash | LOW)
        ok = at < len(kept)
        ok[ok] = (kept | LOW)[at[ok]] == (s.hash | LOW)[ok]
        pick, hot = np.flatnonzero(ok), (kept[at[ok]] & LOW) == LOW
        first, last, doc, h = s.first[pick], s.last[pick], s.doc[pick], s.hash[pick]
        number: dict[tuple, int] = {}
        rows = []  # word of the first window, windows, document, distinct segment
        for a, b, d, x, one in zip(first.tolist(), last.tolist(), doc.tolist(), ((h >> LOW) % np.uint64(parts)).tolist(), hot.tolist()):
            for lo, hi in ((p, p) for p in range(a, b + 1)) if one else ((a, b),):
                text = b" ".join(s.words[lo : hi + width])
                key = (xxhash.xxh64_intdigest(text) % parts if one else x, text)
                rows.append((lo, hi - lo + 1, d, number.setdefault(key, len(number))))
        first, n, doc, seg = (np.array(c, np.int64) for c in zip(*rows))
        put_table(f"{path}.seg", pa.table({"first": first - s.starts[doc], "n": n.astype(np.int32), "doc": doc.astype(np.int32), "seg": seg.astype(np.int32)}))
        least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(least, seg, np.array(ids, np.int64)[doc])
        dealt: dict[int, list] = {}
        for (bucket, text), k in number.items():
            dealt.setdefault(bucket, []).append((k, text))
        for bucket, got in dealt.items():
            k = np.array([x for x, _ in got], np.int32)
            yield bucket, _pack(k, least[k], np.frombuffer(b"\n".join(t for _, t in got), np.uint8))

    def answer(rows):
        number: dict[bytes, int] = {}
        parts = []
        for unit, data in rows:
            k, least, text = _unpack(data, np.int32, np.int64, np.uint8)
            parts.append((unit, k, least, np.array([number.setdefault(t, len(number)) for t in text.tobytes().split(b"\n")], np.int64)))
        if not parts:
            return
        docs_ = np.full(len(number), np.iinfo(np.int64).max)
        for _, _, least, at in parts:
            np.minimum.at(docs_, at, least)
        index = FMIndex((t.split(b" ") for t in number), docs_, width)
        number.clear()
        found = index.matches()
        for unit, k, least, at in parts:
            n = index.size[at] - width + 1
            flat = np.repeat(index.start[at] - np.concatenate(([0], np.cumsum(n)))[:-1], n) + np.arange(n.sum())
            yield unit, _pack(k, n.astype(np.int32), found[flat])

    def edit(path, unit, answers):
        ids, texts = texts_of(unit)
        words = [t.split() for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        removed = np.zeros(len(texts), np.int64)
        if answers:
            got = [_unpack(a, np.int32, np.int32, np.int64) for a in answers]
            k, n, least = (np.concatenate(c) for c in zip(*got))
            begin = np.zeros(int(k.max()) + 1, np.int64)
            begin[k] = np.concatenate(([0], np.cumsum(n)))[:-1]
            seg = get_table(f"{path}.seg")
            first, m, doc, s = (seg.column(c).to_numpy().astype(np.int64) for c in ("first", "n", "doc", "seg"))
            inner = np.arange(m.sum()) - np.repeat(np.concatenate(([0], np.cumsum(m)))[:-1], m)
            doc, place = np.repeat(doc, m), np.repeat(first, m) + inner
            gone = least[np.repeat(begin[s], m) + inner] < np.array(ids, np.int64)[doc]
            doc, place = doc[gone], place[gone]
            base = np.concatenate(([0], np.cumsum(counts + 1)))[:-1]
            step = np.zeros(int((counts + 1).sum()) + 1, np.int64)
            np.add.at(step, base[doc] + place, 1)
            np.add.at(step, base[doc] + place + width, -1)
            cover = np.cumsum(step) > 0
            for d in np.unique(doc):
                own = cover[base[d] : base[d] + counts[d]]
                removed[d] = own.sum()
                texts[d] = b" ".join([w for w, g in zip(words[d], own.tolist()) if not g])
        return texts, [pa.array(counts), pa.array(removed)]

    docs = without(docs, *names)
    parts = exchange_parts(docs, text_col)
    answers = meet(stage(docs, id_col, text_col, out, anchors, parts, UNIT_BYTES), out, parts, send, answer)
    return finish(answers, docs, text_col, ", ".join(f"`{c}` long" for c in names), edit)


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = remove_repeats(docs)
    # Texts without removals keep their own white space; the digest is of the words joined by one space.
    joined = F.concat_ws(" ", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    text = F.when(F.col("n_removed") > 0, F.col("text")).otherwise(joined)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
