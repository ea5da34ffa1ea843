"""Suffix-array dedup: bytes under a string of ``width`` bytes that also starts elsewhere.

Suffixes are taken at anchors: every window of ``width`` bytes belongs to its minimizer, the smallest hash among its runs of GRAM
bytes, and equal windows have equal minimizers. An anchor's right context is the suffix that starts there, its left
context the bytes before it, both as far as its windows reach. Anchors whose GRAM bytes stand nowhere else stop there. Each
unit sorts the rest into runs and sends them front-coded (length of the common prefix, then new bytes) to buckets by content; a
bucket merges its runs with a loser tree that knows each head's common prefix with the last output and compares only
bytes beyond it. The merged order and its common prefixes give the pairs of anchors with left + right agreement of ``width`` bytes
or more; such a pair removes that stretch around each of both. Anchors of very many units are dealt out by half a window on either side, one of which any pair shares.

Matches never cross documents; strings are those of the input. Nulls: a null text is empty, a null id comes back as null. Repeated rows
are places of their own. Texts shorter than ``width`` stay whole. Empty table: no rows. Other columns are carried along, but for those called like a count, which it replaces (``names`` names the counts); the text becomes binary,
since cuts may fall inside a character.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from ._common import exchange_parts, get_table, put_table, without, work_dir
from ._units import LOW, finish, meet, stage, texts_of
from .substrings import _mix, _pack, _unpack

WIDTH, GRAM = 400, 32
CHUNK = 1 << 21
PAIRWISE = 48
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_POSITION = np.uint64(28)


def _lowest(data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of data: place and hash of its minimizer (leftmost of equal ones)."""
    h, m, power = _BYTE[data], 1, 0xD6E8FEB86659FD93
    while m < GRAM:
        h, power, m = h[:-m] * np.uint64(power) + h[m:], power * power % (1 << 64), 2 * m
    h = _mix(h)
    key = (h >> _POSITION << _POSITION) | np.arange(len(h), dtype=np.uint64)
    span, m = width - GRAM + 1, 1
    while 2 * m <= span:
        key, m = np.minimum(key[:-m], key[m:]), 2 * m
    if m < span:
        key = np.minimum(key[: len(key) - (span - m)], key[span - m :])
    at = (key & ((LOW << _POSITION) - LOW)).astype(np.int64)
    return at, h[at]


class Anchors:
    """Anchors of a unit: place, first and last window, document, hash; places count through all texts."""

    def __init__(self, texts: list[bytes], width: int):
        self.data = b"".join(texts)
        self.starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))))
        raw, parts = np.frombuffer(self.data, np.uint8), []
        for at in range(0, max(0, len(raw) - width + 1), CHUNK):
            piece = raw[at : at + CHUNK + width - 1]
            place, h = _lowest(piece, width)
            window = np.arange(len(place))
            doc = np.searchsorted(self.starts, at + window, "right") - 1
            ok = at + window + width <= self.starts[doc + 1]
            window, place, h, doc = window[ok], place[ok], h[ok], doc[ok]
            if len(window):
                head = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]))))
                tail = np.append(head[1:], len(window)) - 1
                parts.append((at + place[head], at + window[head], at + window[tail], doc[head], h[head]))
        none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
        place, first, last, doc, h = (np.concatenate(c) for c in zip(*parts)) if parts else none
        if len(place):  # an anchor whose windows lie in two chunks
            head = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]))))
            last = last[np.append(head[1:], len(place)) - 1]
            place, first, doc, h = place[head], first[head], doc[head], h[head]
        self.place, self.first, self.last, self.doc, self.hash = place, first, last, doc, h


def common(a: bytes, b: bytes, k: int = 0) -> int:
    """Length of the common prefix, given that k bytes agree."""
    n = min(len(a), len(b))
    while k < n and a[k : k + 32] == b[k : k + 32]:
        k += 32
    while k < n and a[k] == b[k]:
        k += 1
    return min(k, n)


def front_code(run: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common prefix with the one before, length, and new bytes of sorted strings."""
    prefix, before = [], b""
    for s in run:
        prefix.append(common(before, s))
        before = s
    new = b"".join(s[p:] for s, p in zip(run, prefix))
    return np.array(prefix, np.uint16), np.fromiter(map(len, run), np.uint16, len(run)), np.frombuffer(new, np.uint8)


def front_decode(prefix: np.ndarray, size: np.ndarray, new: np.ndarray) -> list[bytes]:
    out, before, at, new = [], b"", 0, new.tobytes()
    for p, n in zip(prefix.tolist(), size.tolist()):
        before = before[:p] + new[at : at + n - p]
        at += n - p
        out.append(before)
    return out


def merge(runs: list[tuple[list[bytes], list[int]]]):
    """(run, place, common prefix with the string before) of all strings in order.

    A loser tree: each inner node keeps the loser of its match with its common prefix with the winner. All heads that meet
    know their common prefix with the last output: the longer one wins unseen; equal ones are compared beyond it.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads, at = [r[0][0] if r[0] else None for r in runs] + [None] * (k - len(runs)), [0] * k
    lcp, loser = [0] * k, [-1] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); sets the loser's prefix with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (a, b) if y is None else (b, a)
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        n = common(x, y, lcp[a])
        if x[n:] <= y[n:]:
            lcp[b] = n
            return a, b
        lcp[a] = n
        return b, a

    def start(node: int) -> int:
        if node >= k:
            return node - k
        w, loser[node] = play(start(2 * node), start(2 * node + 1))
        return w

    winner = start(1)
    while heads[winner] is not None:
        yield winner, at[winner], lcp[winner]
        at[winner] += 1
        strings, prefix = runs[winner]
        if at[winner] < len(strings):
            heads[winner], lcp[winner] = strings[at[winner]], prefix[at[winner]]
        else:
            heads[winner] = None
        node = (winner + k) // 2
        while node:
            winner, loser[node] = play(winner, loser[node])
            node //= 2


def stretches(right: list[bytes], prefix: list[int], left: list[bytes], count: list[int], width: int) -> list[tuple[int, int]]:
    """(bytes to the left, bytes to the right) that each anchor of a group shares with partners; (0, 0): none.

    right is sorted, prefix[i] the common prefix of right[i-1] and right[i]; contexts are distinct and stand count times.
    """
    m = len(right)
    out = [(len(a), len(b)) if n > 1 else (0, 0) for a, b, n in zip(left, right, count)]
    if m <= PAIRWISE:
        for i in range(m):
            r = len(right[i])
            for j in range(i + 1, m):
                r = min(r, prefix[j])
                if r < GRAM:
                    break
                need = max(0, width - r)
                a, b = left[i], left[j]
                if len(a) < need or len(b) < need or (need and a[-need:] != b[-need:]):
                    continue
                n = common(a[::-1], b[::-1], need)
                out[i] = max(out[i][0], n), max(out[i][1], r)
                out[j] = max(out[j][0], n), max(out[j][1], r)
        return out
    # Many contexts: for each offset of the anchor in a window, classes of equal right parts and of equal left parts.
    turned = [x[::-1] for x in left]
    order = sorted(range(m), key=turned.__getitem__)
    back = np.array([0] + [common(turned[a], turned[b]) for a, b in zip(order, order[1:])])
    order, ahead = np.array(order), np.array(prefix)
    nl, nr = np.fromiter(map(len, left), np.int64, m), np.fromiter(map(len, right), np.int64, m)
    low, high = np.full(m, width + 1), np.full(m, -1)
    for o in range(max(0, width - int(nr.max())), int(nl.max()) + 1):
        there = (nl >= o) & (nr >= width - o)
        if there.sum() < 2:
            continue
        lid = np.empty(m, np.int64)
        lid[order] = np.cumsum(back < o)
        key = np.cumsum(ahead < width - o) * (m + 1) + lid
        _, which, n = np.unique(key[there], return_inverse=True, return_counts=True)
        found = np.flatnonzero(there)[n[which] > 1]
        low[found], high[found] = np.minimum(low[found], o), np.maximum(high[found], o)
    return [(max(a, int(h)), max(b, width - int(lo))) if h >= 0 else (a, b) for (a, b), lo, h in zip(out, low, high)]


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, names: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans")) -> DataFrame:
    """The documents with repeated bytes removed (text as binary), and n_bytes, n_removed, n_spans."""
    if width < 2 * GRAM:
        raise ValueError(f"width must be at least {2 * GRAM}")
    out, half = work_dir(docs.sparkSession, "suffixes"), width // 2

    def anchors(texts):
        return Anchors(texts, width).hash

    def send(path, unit, kept, parts):
        s = Anchors(texts_of(unit)[1], width)
        at = np.searchsorted(kept | LOW, s.hash | LOW)
        ok = at < len(kept)
        ok[ok] = (kept | LOW)[at[ok]] == (s.hash | LOW)[ok]
        pick, hot = np.flatnonzero(ok), (kept[at[ok]] & LOW) == LOW
        place, first, last, doc, h = s.place[pick], s.first[pick], s.last[pick], s.doc[pick], s.hash[pick]
        number: dict[tuple[bytes, bytes], int] = {}
        seg, count, dealt = [], [], {}
        for a, f, l, x, one in zip(place.tolist(), first.tolist(), (last + width).tolist(), ((h >> LOW) % np.uint64(parts)).tolist(), hot.tolist()):
            left, right = s.data[f:a], s.data[a:l]
            k = number.setdefault((right, left), len(number))
            seg.append(k)
            if k < len(count):
                count[k] += 1
                continue
            count.append(1)
            if not one:
                dealt.setdefault((x, 0), []).append((right, left, k))
            else:
                if len(right) >= half:
                    dealt.setdefault((xxhash.xxh64_intdigest(right[:half]) % parts, 1), []).append((right, left, k))
                if len(left) >= half:
                    dealt.setdefault((xxhash.xxh64_intdigest(left[-half:]) % parts, 2), []).append((right, left, k))
        put_table(f"{path}.seg", pa.table({"place": place - s.starts[doc], "doc": doc.astype(np.int32), "seg": np.array(seg, np.int32)}))
        count = np.array(count, np.int32)
        for (bucket, kind), rows in dealt.items():
            rows.sort()
            k = np.array([r[2] for r in rows], np.int32)
            left = [r[1] for r in rows]
            coded = front_code([r[0] for r in rows])
            yield bucket, _pack(np.array([kind], np.int32), k, count[k], *coded, np.fromiter(map(len, left), np.uint16, len(left)), np.frombuffer(b"".join(left), np.uint8))

    def answer(rows):
        runs: dict[int, list] = {}
        for unit, data in rows:
            kind, k, count, prefix, size, new, nl, left = _unpack(data, np.int32, np.int32, np.int32, np.uint16, np.uint16, np.uint8, np.uint16, np.uint8)
            cuts, left = np.concatenate(([0], np.cumsum(nl, dtype=np.int64))).tolist(), left.tobytes()
            lefts = [left[a:b] for a, b in zip(cuts, cuts[1:])]
            runs.setdefault(int(kind[0]), []).append((unit, k.tolist(), count.tolist(), lefts, front_decode(prefix, size, new), prefix.tolist()))
        found: dict[str, list[tuple[int, int, int]]] = {}

        def close(group):
            """group: [(right, prefix, left, run, place)] that agree in GRAM bytes at least."""
            right, prefix, left, count, who, known = [], [], [], [], [], {}
            low = 1 << 30
            for r, p, f, run, i in group:
                low = min(low, p)
                key = (r, f)
                if key in known:
                    count[known[key]] += run[2][i]
                    who[known[key]].append((run, i))
                else:
                    known[key] = len(right)
                    right.append(r)
                    prefix.append(low)
                    left.append(f)
                    count.append(run[2][i])
                    who.append([(run, i)])
                    low = 1 << 30
            if len(right) == 1 and count[0] < 2:
                return
            for (a, b), members in zip(stretches(right, prefix, left, count, width), who):
                if a or b:
                    for run, i in members:
                        found.setdefault(run[0], []).append((run[1][i], a, b))

        for own in runs.values():
            group = []
            for k, i, p in merge([(r[4], r[5]) for r in own]):
                if p < GRAM and group:
                    close(group)
                    group = []
                group.append((own[k][4][i], p, own[k][3][i], own[k], i))
            close(group)
        for unit, got in found.items():
            yield unit, _pack(*(np.array(c, np.int32) for c in zip(*got)))

    def edit(path, unit, answers):
        texts = texts_of(unit)[1]
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        removed, spans = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        if answers:
            k, a, b = (np.concatenate(c).astype(np.int64) for c in zip(*(_unpack(x, np.int32, np.int32, np.int32) for x in answers)))
            seg = get_table(f"{path}.seg")
            place, doc, s = (seg.column(c).to_numpy().astype(np.int64) for c in ("place", "doc", "seg"))
            left, right = np.zeros(int(max(k.max(), s.max())) + 1, np.int64), np.zeros(int(max(k.max(), s.max())) + 1, np.int64)
            np.maximum.at(left, k, a)
            np.maximum.at(right, k, b)
            lo, hi = place - left[s], place + right[s]
            ok = left[s] + right[s] > 0
            doc, lo, hi = doc[ok], lo[ok], hi[ok]
            order = np.lexsort((lo, doc))
            doc, lo, hi = doc[order].tolist(), lo[order].tolist(), hi[order].tolist()
            i = 0
            while i < len(doc):
                d, kept, until = doc[i], [], 0
                while i < len(doc) and doc[i] == d:
                    if not spans[d] or lo[i] > until:
                        kept.append(texts[d][until : lo[i]])
                        spans[d] += 1
                        removed[d] += hi[i] - lo[i]
                        until = hi[i]
                    elif hi[i] > until:
                        removed[d] += hi[i] - until
                        until = hi[i]
                    i += 1
                texts[d] = b"".join([*kept, texts[d][until:]])
        return texts, [pa.array(size), pa.array(removed), pa.array(spans)]

    docs = without(docs, *names)
    parts = exchange_parts(docs, text_col)
    answers = meet(stage(docs, id_col, text_col, out, anchors, parts), out, parts, send, answer)
    return finish(answers, docs, text_col, ", ".join(f"`{c}` long" for c in names), edit, binary=True)


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))
