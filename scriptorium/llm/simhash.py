"""SimHash near-dedup by Golay-code fuzzy hashing.

A 64-bit fingerprint falls into three segments of 22, 21 and 21 bits, each read as a word of the perfect Golay code
(23, 12, 7). Fingerprints at three or fewer differing bits have two segments with at most one error each. Of two words one bit
apart, either both decode to one codeword, or both lie at distance 3 from theirs and each at distance 4 from the
other's; so a word's keys are its own codeword and, at distance 3, the five codewords at distance 4. The keys of a
fingerprint are the pairs of segment keys for each pair of segments, from its own pair on in order (the other
fingerprint supplies the rest). Fingerprints that share a key are verified by their differing bits.

Equal fingerprints are one node, named by the fingerprint. In a key's group of many, links are found by a search that compares only what isn't linked
yet, and each found node gives one link, so rows grow with the nodes and not with their pairs.

Nulls: a null text counts as empty, with fingerprint zero; a null id comes back as null and is the largest. Repeated rows
and ids are kept. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import flagged, id_text, null_id, tidy, work_dir, write_once
from .components import components, join_groups, with_roots

#: Fixed value: the Golay code's generator polynomial.
GENERATOR = 0xC75
SEGMENTS = ((0, 22), (22, 21), (43, 21))
RADIUS = 3
PAIRWISE = 32  # groups up to this size compare all their pairs


def _syndrome(v: int) -> int:
    for k in range(22, 10, -1):
        if v >> k & 1:
            v ^= GENERATOR << (k - 11)
    return v


class Golay:
    """Decoding tables, from the generator."""

    def __init__(self):
        unit = [_syndrome(1 << k) for k in range(23)]
        self.low, self.high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
        for k in range(12):
            self.low[1 << k : 2 << k] = self.low[: 1 << k] ^ unit[k]
        for k in range(11):
            self.high[1 << k : 2 << k] = self.high[: 1 << k] ^ unit[12 + k]
        self.error, self.far = np.zeros(2048, np.int64), np.full((2048, 5), -1, np.int64)
        fill = np.zeros(2048, np.int64)
        for weight in range(5):
            for bits in combinations(range(23), weight):
                s = e = 0
                for b in bits:
                    s, e = s ^ unit[b], e | 1 << b
                if weight <= 3:
                    self.error[s] = e
                else:
                    self.far[s, fill[s]] = e
                    fill[s] += 1

    def keys(self, word: np.ndarray) -> np.ndarray:
        """Six columns of codeword indices, the own one first; -1 where there is none."""
        s = self.low[word & 0xFFF] ^ self.high[word >> 12]
        errors = np.concatenate((self.error[s][:, None], self.far[s]), axis=1)
        return np.where(errors >= 0, (word[:, None] ^ errors) >> 11, -1)


_golay: list[Golay] = []


def golay() -> Golay:
    if not _golay:
        _golay.append(Golay())
    return _golay[0]


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of the fingerprints."""
    code = [golay().keys(((fp >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)) for at, n in SEGMENTS]
    rows, keys = [], []
    for p, (a, b) in enumerate(combinations(range(3), 2)):
        both = (code[a][:, :, None] << 12 | code[b][:, None, :]).reshape(len(fp), 36)
        ok = ((code[a][:, :, None] >= 0) & (code[b][:, None, :] >= 0)).reshape(len(fp), 36) & (both >= both[:, :1])
        r, c = np.nonzero(ok)
        rows.append(r)
        keys.append(p << 24 | both[r, c])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """A-Z lower-cased, words between ASCII white space, shingles with repeats, XXH64; a bit is set if in over half."""
    w = text.lower().split()
    if not w:
        return 0
    parts = map(b" ".join, zip(*(w[k:] for k in range(shingle)))) if len(w) >= shingle else [b" ".join(w)]
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(seed)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        ones += np.unpackbits(h[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                p = b.slice(at, 512)
                fp = np.array([fingerprint(t, shingle, seed) for t in p.column(1).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([p.column(0), pa.array(fp)], ["doc_id", "fp"])

    return id_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, fp long")


def _group_links(fp: np.ndarray, node: np.ndarray, radius: int):
    """Links of a large group: a search in which every node found is compared only with those not found yet."""
    left = np.argsort(node, kind="stable")  # smaller nodes first, so that groups of several keys give the same links
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            i = todo.pop()
            near = np.bitwise_count(fp[left] ^ fp[i]) <= radius
            found = left[near]
            if len(found):
                yield np.full(len(found), node[i]), node[found]
                todo.extend(found.tolist())
                left = left[~near]


def links_in(keys: np.ndarray, fp: np.ndarray, node: np.ndarray, radius: int):
    """(u, v) of verified links between rows with equal keys; rows come sorted by key."""
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.repeat(sizes := np.diff(np.append(heads, len(keys))), sizes)
    small = np.flatnonzero((size > 1) & (size <= PAIRWISE))
    for d in range(1, min(PAIRWISE, int(size[small].max(initial=1)))):
        i = small[small + d < len(keys)]
        i = i[keys[i] == keys[i + d]]
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= radius]
        if len(i):
            yield node[i], node[i + d]
    for h, n in zip(heads[sizes > PAIRWISE], sizes[sizes > PAIRWISE]):
        yield from _group_links(fp[h : h + n], node[h : h + n], radius)


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fps, node) rows, fps an array of one fingerprint for each seed → links (u, v) enough to connect all nodes within radius bits for a seed."""

    def spread(batches):
        for b in batches:
            for at in range(0, b.num_rows, 8192):
                p = b.slice(at, 8192)
                fps, node = np.asarray(p.column("fps").flatten()).reshape(p.num_rows, -1).view(np.uint64), np.asarray(p.column("node"))
                for seed in range(fps.shape[1]):
                    fp = np.ascontiguousarray(fps[:, seed])
                    rows, keys = keys_of(fp)
                    yield pa.RecordBatch.from_arrays([pa.array(keys | seed << 26), pa.array(fp[rows].view(np.int64)), pa.array(node[rows])], ["key", "fp", "node"])

    def verify(batches):
        kept = None
        for b in batches:
            now = [np.asarray(c) for c in b.columns]
            now = now if kept is None else [np.concatenate(x) for x in zip(kept, now)]
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            kept = [x[cut:] for x in now]
            yield from emit([x[:cut] for x in now])
        if kept is not None:
            yield from emit(kept)

    def emit(rows):
        if len(rows[0]) < 2:
            return
        found = list(links_in(rows[0], rows[1].view(np.uint64), rows[2], radius))
        if found:
            u, v = (np.concatenate(x) for x in zip(*found))
            uv = np.unique(np.stack((np.maximum(u, v), np.minimum(u, v)), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(uv[:, 0]), pa.array(uv[:, 1])], ["u", "v"])

    keyed = nodes.select("fps", "node").mapInArrow(tidy(spread), "key long, fp long, node long")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(verify), "u long, v long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, seed: int = 42, radius: int = RADIUS) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable over links, null if none has an id).

    Links are between fingerprints, so that null or repeated ids connect nothing.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError("the keys cover up to three differing bits")
    uri = work_dir(docs.sparkSession, "simhash")
    prints = write_once(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, seed=seed), f"{uri}/prints")
    nodes = write_once(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), f"{uri}/nodes")
    found = links(nodes.select(F.array("fp").alias("fps"), F.col("fp").alias("node")), radius)
    total = prints.count()
    group = with_roots(nodes.select(F.col("fp").alias("node"), "least"), components(found, f"{uri}/components"), total)
    group = nodes.select("fp", "n").join(group.withColumnRenamed("node", "fp"), "fp")
    out = join_groups(prints, group, "fp", total).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    return out.select(null_id(), "fingerprint", null_id("component_id"))


def _whole(w: list[bytes]) -> int:
    """A hash of the words in order."""
    return xxhash.xxh3_64_intdigest(b" ".join(w)) - (1 << 63)


def _word_prints(text: bytes, seeds: int) -> tuple[int, list[int]]:
    """A hash of the lower-cased words in order, and SimHashes over the distinct words, one for each seed."""
    w = text.lower().split()
    whole = _whole(w)
    if not w:
        return whole, [0] * seeds
    h = np.fromiter(map(xxhash.xxh64_intdigest, set(w)), np.uint64)
    out = []
    for s in range(seeds):
        x = h * np.uint64(0x9E3779B97F4A7C15 + 2 * s) ^ np.uint64(s * 0xD1B54A32D192ED03 % (1 << 64))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        ones = np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * ones > len(x), bitorder="little").view("<i8")[0]))
    return whole, out


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words: the whole sequence."""
    w = text.lower().split()
    parts = map(b" ".join, zip(*(w[k:] for k in range(shingle)))) if len(w) >= shingle else [b" ".join(w)]
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64))


def share(n, similarity: float):
    """Least number of common members of two sets of n members in all at the similarity."""
    return np.ceil(n * similarity / (1 + similarity) - 1e-9).astype(np.int64)


def prefix(s: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """The first members of a sorted set, those in common (sorted) last: two sets at the similarity share one of them, whatever common holds."""
    at = np.searchsorted(common, s)
    last = at < len(common)
    last[last] = common[at[last]] == s[last]
    return np.concatenate((s[~last], s[last]))[: len(s) - int(np.ceil(similarity * len(s) - 1e-9)) + 1]


def sketch(s: np.ndarray) -> bytes:
    """Parity of the members by their low bits, in about one bit for each: sets differ in at least as many members as sketches do in bits."""
    n = 1 << max(6, int(len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1, bitorder="little").astype(np.uint8).tobytes()


def _differ(x: np.ndarray, y: np.ndarray) -> int:
    """Differing bits of two sketches, the longer folded to the shorter."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def _may(n, m, i, j, similarity: float):
    """Whether sets of n and m members whose first common one is at places i and j can reach the similarity."""
    return (similarity * np.maximum(n, m) <= np.minimum(n, m) + 1e-9) & (1 + np.minimum(n - i, m - j) - 1 >= share(n + m, similarity))


class Sketches:
    """Rows of one key: nodes, members of their sets, places of the key and sketches."""

    def __init__(self, node: np.ndarray, n: np.ndarray, at: np.ndarray, sketches: list, similarity: float):
        self.node, self.n, self.at, self.similarity = node, n.astype(np.int64), at.astype(np.int64), similarity
        self.width = np.array([len(k) for k in sketches])
        self.place, self.rows, self.half = np.zeros(len(node), np.int64), {}, {}
        for w in np.unique(self.width).tolist():
            pick = np.flatnonzero(self.width == w)
            self.place[pick] = np.arange(len(pick))
            self.rows[w] = np.frombuffer(b"".join(sketches[i] for i in pick), np.uint8).reshape(-1, w)
            self.half[w] = self.rows[w][:, : w // 2] ^ self.rows[w][:, w // 2 :]

    def may(self, i: int, j: np.ndarray) -> np.ndarray:
        """Of the rows j those that can be similar to row i; sets of similar sizes have sketches of one width or twice that."""
        n, m = self.n[i], self.n[j]
        j = j[_may(n, m, self.at[i], self.at[j], self.similarity)]
        bits, w = np.full(len(j), 1 << 40), int(self.width[i])
        for width, one, many in ((w, self.rows[w], self.rows), (w * 2, self.rows[w], self.half), (w // 2, self.half[w], self.rows)):
            pick = np.flatnonzero(self.width[j] == width)
            if len(pick):
                bits[pick] = np.bitwise_count(many[width][self.place[j[pick]]] ^ one[self.place[i]]).sum(axis=1, dtype=np.int64)
        both = n + self.n[j]
        return j[bits <= both - 2 * share(both, self.similarity)]

    def search(self):
        """Links enough to connect all that can be similar: a node found is compared only with those not found yet."""
        left = np.arange(len(self.node))
        while len(left):
            todo, left = [left[0]], left[1:]
            while todo and len(left):
                i = todo.pop()
                found = self.may(i, left)
                if len(found):
                    yield np.full(len(found), self.node[i]), self.node[found]
                    todo.extend(found.tolist())
                    left = np.setdiff1d(left, found, assume_unique=True)

    def across(self, label: np.ndarray):
        """All pairs of different labels that can be similar."""
        for i in range(len(label) - 1) if (label != label[0]).any() else ():
            found = self.may(i, i + 1 + np.flatnonzero(label[i + 1 :] != label[i]))
            if len(found):
                yield np.full(len(found), self.node[i]), self.node[found]


def whole_keys(batches):
    """Columns of rows sorted by their first column, in parts that end where its value does."""
    kept = []
    for b in batches:
        if not b.num_rows:
            continue
        cut = int(np.searchsorted(now := np.asarray(b.column(0)), now[-1]))
        if cut or kept and kept[0].column(0)[0] != b.column(0)[0]:
            yield pa.Table.from_batches([*kept, b.slice(0, cut)]).combine_chunks()
            kept = []
        kept.append(b.slice(cut))
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def _linked(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["u", "v"])


def large_links(members: DataFrame, similarity: float, across: bool) -> DataFrame:
    """Rows of large groups (key, node, n, at, k, label) → (u, v) of a search in each group, or of all pairs across labels that can be similar."""

    def run(batches):
        for t in whole_keys(batches):
            keys, node, n, at = (np.asarray(t.column(c).combine_chunks()) for c in ("key", "node", "n", "at"))
            heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            for h, e in zip(heads, np.append(heads[1:], len(keys))):
                g = Sketches(node[h:e], n[h:e], at[h:e], t.column("k").slice(h, e - h).to_pylist(), similarity)
                for u, v in g.across(np.asarray(t.column("label").slice(h, e - h).combine_chunks())) if across else g.search():
                    yield _linked(u, v)

    rows = members.select("key", "node", "n", "at", "k", "label")
    return rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(tidy(run), "u long, v long").distinct()


def pairs_in(keys: np.ndarray, node: np.ndarray, n: np.ndarray, at: np.ndarray, similarity: float):
    """(u, v) of all pairs with equal keys that can reach the similarity; rows come sorted by key."""
    if not len(keys):
        return
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.repeat(sizes := np.diff(np.append(heads, len(keys))), sizes)
    i = np.flatnonzero(size > 1)
    for d in range(1, int(size.max(initial=1))):
        i = i[i + d < len(keys)]
        i = i[keys[i] == keys[i + d]]
        k = i[_may(n[i], n[i + d], at[i], at[i + d], similarity) & (node[i] != node[i + d])]
        if len(k):
            yield node[k], node[k + d]


def shared_members(source: DataFrame, shingle: int, least: int = 4, most: int = 200_000) -> np.ndarray:
    """Shingles that are common in a sixteenth of the texts. They only order prefixes, so that a list that lacks some loses no pair."""

    def run(batches):
        for b in batches:
            for t in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t, shingle).view(np.int64))], ["m"])

    found = source.where("pmod(xxhash64(text), 16) = 0").select("text").mapInArrow(tidy(run), "m long").groupBy("m").count()
    found = found.where(F.col("count") >= least).orderBy(F.desc("count"), "m").limit(most).select("m").toArrow()
    return np.sort(np.asarray(found.column("m").combine_chunks()).view(np.uint64))


def close_pairs(source: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(text) → rows (u, v) of pairs of texts, by the hash of their words, (key, u, n, at) of members of large groups, and (u, n, at: -1, k) of every text with its sketch.

    All pairs at the similarity are among the pairs or within a large group.
    """
    common = shared_members(source, shingle)
    names, schema = ["key", "u", "v", "n", "at", "k"], "key long, u long, v long, n int, at int, k binary"

    def spread(batches):
        seen = set()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                out = []
                for t in b.column(0).slice(at, 512).to_pylist():
                    w = _whole(t.lower().split())
                    if w not in seen:
                        seen.add(w)
                        s = shingle_set(t, shingle)
                        p = prefix(s, common, similarity)
                        out.append((np.append(p.view(np.int64), w), np.full(len(p) + 1, w), np.full(len(p) + 1, len(s), np.int32), np.append(np.arange(len(p), dtype=np.int32), np.int32(-1)), [None] * len(p) + [sketch(s)]))
                if out:
                    *c, k = zip(*out)
                    yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(x)) for x in c), pa.array([y for x in k for y in x], pa.binary())], ["key", "node", "n", "at", "k"])

    def meet(batches):
        for t in whole_keys(batches):
            plain = t.filter(pa.compute.greater_equal(t.column("at"), 0))
            if plain.num_rows < t.num_rows:
                own = t.filter(pa.compute.less(t.column("at"), 0))
                none = pa.nulls(own.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([none, *(own.column("node").chunks or [none]), none, *(c.combine_chunks() for c in own.columns[2:])], names)
            rows = [np.asarray(c.combine_chunks()) for c in plain.columns[:4]]
            if not len(rows[0]):
                continue
            one = np.concatenate(([True], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])))  # texts that several tasks met
            rows = [c[one] for c in rows]
            heads = np.flatnonzero(np.concatenate(([True], rows[0][1:] != rows[0][:-1])))
            size = np.repeat(sizes := np.diff(np.append(heads, len(rows[0]))), sizes)
            for u, v in pairs_in(*(c[(size > 1) & (size <= PAIRWISE)] for c in rows), similarity):
                none = pa.nulls(len(u), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.nulls(len(u), pa.int64()), *_linked(u, v).columns, none, none, pa.nulls(len(u), pa.binary())], names)
            if (large := size > PAIRWISE).any():
                key, node, n, at = (pa.array(c[large]) for c in rows)
                yield pa.RecordBatch.from_arrays([key, node, pa.nulls(len(key), pa.int64()), n, at, pa.nulls(len(key), pa.binary())], names)

    keyed = source.select("text").mapInArrow(tidy(spread), "key long, node long, n int, at int, k binary")
    return keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(tidy(meet), schema)


def similar_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, seeds: int = 1, unique_ids: bool = False) -> DataFrame:
    """Per row: doc_id, component_id (smallest id of the group, null if none has one) over links of texts whose shingle sets reach the Jaccard similarity.

    Candidates come from SimHashes over the distinct words, one for each seed, within three bits by the same keys, and from a
    join on prefixes of the shingle sets, which misses no pair at the similarity. Every candidate link is verified, first by
    sketches of the shingle sets, then by the sets of both texts. Groups of over 32 texts under one shingle are searched, and
    then all pairs across the verified groups are compared. Texts of equal words are one node; ids connect nothing, so null or
    repeated ids do no harm. unique_ids tells that no id is null or repeated, which saves a written copy of the texts.
    """
    spark, uri = docs.sparkSession, work_dir(docs.sparkSession, "similar")
    source = id_text(docs, id_col, text_col)
    if unique_ids:
        source = source.withColumn("row", F.col("doc_id"))
    else:
        source = write_once(source.withColumn("row", F.monotonically_increasing_id()), f"{uri}/rows")

    def mark(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                p = b.slice(at, 512)
                whole, fps = zip(*(_word_prints(t, seeds) for t in p.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays([p.column("row"), p.column("doc_id"), pa.array(whole, pa.int64()), pa.array(fps, pa.list_(pa.int64()))], ["row", "doc_id", "whole", "fps"])

    marks = write_once(source.mapInArrow(tidy(mark), "row long, doc_id long, whole long, fps array<long>"), f"{uri}/marks")
    nodes = marks.groupBy("whole").agg(F.min("doc_id").alias("least"), F.min("row").alias("row"), F.min("fps").alias("fps"), F.count("*").alias("n"))
    nodes = write_once(nodes.withColumnRenamed("whole", "node"), f"{uri}/nodes")
    bits, met = write_once(links(nodes.select("fps", "node")), f"{uri}/bits"), write_once(close_pairs(source, shingle, similarity), f"{uri}/met")
    sketches = met.where("at < 0").select(F.col("u").alias("node"), "n", "k").dropDuplicates(["node"])
    near = bits.union(met.where("v is not null").select("u", "v")).distinct()

    def screen(batches):
        for b in batches:
            n, m = np.asarray(b.column("n")), np.asarray(b.column("m"))
            may = np.array([_differ(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)) for x, y in zip(b.column("k"), b.column("l"))], np.int64) <= n + m - 2 * share(n + m, similarity)
            yield b.select(["u", "v"]).filter(pa.array(may))

    def verify(batches):
        sets: dict[int, np.ndarray] = {}  # of the last texts; rows of one text come one after another
        for b in batches:
            ok = []
            for u, v, a, c in zip(*(b.column(k).to_pylist() for k in ("u", "v", "a", "c"))):
                x, y = (sets[e] if e in sets else shingle_set(t, shingle) for e, t in ((u, a), (v, c)))
                sets = {u: x, v: y}
                both = len(np.intersect1d(x, y, assume_unique=True)) if similarity * max(len(x), len(y)) <= min(len(x), len(y)) + 1e-9 else 0
                ok.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield b.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    def verified(pairs, name):
        u, v = (sketches.select(F.col("node").alias(e), F.col("n").alias(a), F.col("k").alias(b)) for e, a, b in (("u", "n", "k"), ("v", "m", "l")))
        kept = write_once(pairs.join(u, "u").join(v, "v").select("u", "v", "n", "m", "k", "l").mapInArrow(tidy(screen), "u long, v long"), f"{uri}/{name}-screened")
        ends = kept.select(F.col("u").alias("node")).union(kept.select("v")).distinct().join(nodes.select("node", "row"), "node")
        ends = write_once(ends, f"{uri}/{name}-ends")
        some = flagged(source.select("row", "text"), ends, "row", "needed").where("needed")
        texts = write_once(some.join(ends, "row").select("node", "text"), f"{uri}/{name}-texts")
        u, v = (texts.select(F.col("node").alias(e), F.col("text").alias(b)) for e, b in (("u", "a"), ("v", "c")))
        return write_once(kept.join(u, "u").join(v, "v").select("u", "v", "a", "c").mapInArrow(tidy(verify), "u long, v long"), f"{uri}/{name}-links")

    members = met.where("at >= 0 and v is null").select("key", F.col("u").alias("node"), "n", "at")
    if members.isEmpty():
        root = components(verified(near, "all"), f"{uri}/components")
    else:  # a link of the search that fails leaves its ends in different groups, and all pairs across groups are compared then
        members = members.join(sketches.select("node", "k"), "node")
        found = verified(near.union(large_links(members.withColumn("label", F.col("node")), similarity, False)).distinct(), "first")
        root = components(found, f"{uri}/first")
        members = members.join(root.select(F.col("u").alias("node"), "root"), "node", "left").withColumn("label", F.coalesce("root", "node"))
        root = components(found.union(verified(large_links(members, similarity, True), "rest")), f"{uri}/components")
    total = marks.count()
    group = with_roots(nodes.select("node", "least"), root, total)
    group = nodes.select("node", "n").join(group, "node").withColumnRenamed("node", "whole")
    return join_groups(marks.select("doc_id", "whole"), group, "whole", total).select(null_id(), null_id("component_id"))


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3)
