"""Benchmark decontamination with a positional inverted index of the corpus.

build_index() writes shards of whole documents. A shard row holds its documents (ids, word counts), its sorted vocabulary, and for each
term the ascending positions at which it stands; positions number the words of the shard through, with gaps between documents,
so that a position names its document. match() takes the benchmark in blocks of bounded size, intersects a block's vocabulary with the
shard's, which leaves the windows that can occur, and for each of these intersects the list of its rarest term with the other
terms' lists shifted by their offsets, rarest first. An empty intersection ends a window early. Nothing but one block's windows, as
numbers, is broadcast and no text is shuffled. With a slop, proximity takes the place of exact phrases.

Words: A-Z lower-cased, then runs of bytes other than 00-2F, 3A-60 and 7B-7F. A window is ``width`` consecutive words of an
item; an item of fewer words, but not none, is one window. Every word of every occurrence of a window is hit.
Nulls: a null text has no words; a null document id comes back as null; items with a null id or text take no part.
Repeated items with one id count once. Empty tables: no rows, or no hits. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import id_text, null_id, tidy, units, work_dir, write_once

WIDTH = 10
SHARD_BYTES = 8 << 20
ITEM_BLOCK_BYTES = 16 << 20
GAP = 1 << 12  # free positions between documents, over any slop or window
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


class Shard:
    """Documents and their postings."""

    fields = ("ids", "counts", "terms", "sizes", "postings")

    def __init__(self, ids, counts, terms, sizes, postings):
        self.ids, self.counts, self.sizes, self.postings = ids, counts, sizes, postings
        self.starts = np.concatenate(([0], np.cumsum(counts + GAP)))[:-1]  # a document's first position
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        self.number = {t: k for k, t in enumerate(terms)}

    @classmethod
    def build(cls, ids: list[int], texts: list[bytes]) -> dict:
        number: dict[bytes, int] = {}
        counts, parts, at = [], [], 0
        for t in texts:
            w = words(t)
            for x in set(w).difference(number):
                number[x] = len(number)
            parts.append(np.fromiter(map(number.__getitem__, w), np.int32, len(w)))
            counts.append(len(w))
        counts, terms = np.array(counts, np.int64), list(number)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        starts = np.concatenate(([0], np.cumsum(counts + GAP)))[:-1]
        where = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)))[:-1], counts) + np.arange(len(flat))
        order = np.argsort(flat, kind="stable")
        sizes, where = np.bincount(flat, minlength=len(terms)).astype(np.int64), where[order]
        # Gaps between positions of a term; the first one of each term is absolute.
        gaps = np.diff(where, prepend=0)
        heads = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        gaps[heads[sizes > 0]] = where[heads[sizes > 0]]
        return dict(zip(cls.fields, (_pack(np.array(ids, np.int64)), _pack(counts), zstandard.compress(b" ".join(terms), 1), _pack(sizes.astype(np.int32)), _pack(gaps.astype(np.uint32)))))

    @classmethod
    def load(cls, row: dict) -> Shard:
        sizes = _unpack(row["sizes"], np.int32).astype(np.int64)
        return cls(_unpack(row["ids"], np.int64), _unpack(row["counts"], np.int64), zstandard.decompress(row["terms"]).split(), sizes, _unpack(row["postings"], np.uint32))

    def positions(self, term: int) -> np.ndarray:
        return np.cumsum(self.postings[self.ends[term] : self.ends[term + 1]], dtype=np.int64)


class Matcher:
    """Looks up phrases in one shard; lists of positions are decoded once for each term."""

    def __init__(self, shard: Shard):
        self.shard, self.lists = shard, {}

    def list(self, term: int) -> np.ndarray:
        if term not in self.lists:
            self.lists[term] = self.shard.positions(term)
        return self.lists[term]

    def phrase(self, terms: list[int]) -> np.ndarray:
        """Positions at which the terms stand one after another: offset-adjusted lists intersected from the rarest term on."""
        found = None
        for k in sorted(range(len(terms)), key=lambda k: self.shard.sizes[terms[k]]):
            own = self.list(terms[k])
            if found is None:
                found = own - k
            else:
                at = np.searchsorted(own, found + k)
                found = found[(at < len(own)) & (own[np.minimum(at, len(own) - 1)] == found + k)]
            if not len(found):
                break
        return found

    def near(self, terms: list[int], reach: int) -> np.ndarray:
        """Positions at which a run of at most reach words starts that holds all terms and begins with one of them."""
        first, *rest = sorted(set(terms), key=lambda t: self.shard.sizes[t])
        found = self.list(first)
        for t in rest:  # places of the rarest term with the others around them
            own = self.list(t)
            found = found[np.searchsorted(own, found + reach - 1, "right") > np.searchsorted(own, found - reach + 1)]
        if not len(found):
            return found
        # Any such run begins at a term that stands within reach before a place found; the next place of each term must lie in it.
        starts = []
        for t in {first, *rest}:
            own = self.list(t)
            lo, hi = np.searchsorted(own, found - reach + 1), np.searchsorted(own, found, "right")
            starts.append(own[np.repeat(lo - np.concatenate(([0], np.cumsum(hi - lo)))[:-1], hi - lo) + np.arange((hi - lo).sum())])
        start = np.unique(np.concatenate(starts))
        for t in {first, *rest}:
            own = self.list(t)
            at = np.searchsorted(own, start)
            start = start[(at < len(own)) & (own[np.minimum(at, len(own) - 1)] < start + reach)]
        return start


def build_index(docs: DataFrame, out: str, *, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the index as a table below out, one row per shard."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for k, (ids, texts) in enumerate(units(batches, shard_bytes)):
            row = Shard.build(ids, texts)
            yield pa.RecordBatch.from_arrays([pa.array([f"{part}-{k}"]), *(pa.array([row[c]], pa.binary()) for c in Shard.fields)], ["shard", *Shard.fields])

    df = id_text(docs, id_col, text_col).mapInArrow(tidy(run), "shard string, " + ", ".join(f"{c} binary" for c in Shard.fields))
    df.write.option("parquet.block.size", 64 << 20).option("compression", "uncompressed").parquet(out)
    return docs.sparkSession.read.schema(df.schema).parquet(out)


class Windows:
    """Distinct windows of a block of items, as numbers of its sorted vocabulary, by their length."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        found: dict[tuple[bytes, ...], set[int]] = {}
        self.items = sorted({item for item, _ in items})
        number = {item: k for k, item in enumerate(self.items)}
        for item, text in items:
            w = words(text)
            for k in range(max(1, len(w) - width + 1) if w else 0):
                found.setdefault(tuple(w[k : k + width]), set()).add(number[item])
        self.terms = sorted({x for w in found for x in w})
        place = {x: k for k, x in enumerate(self.terms)}
        of_size: dict[int, list] = {}
        for w, who in found.items():
            of_size.setdefault(len(w), []).append(([place[x] for x in w], sorted(who)))
        self.sizes = [(np.array([w for w, _ in got], np.int32), np.array([x for _, who in got for x in who], np.int32), np.concatenate(([0], np.cumsum([len(who) for _, who in got])))) for _, got in sorted(of_size.items())]

    def within(self, shard: Shard):
        """(terms of the shard, numbers of the items) of the windows whose every word the shard has."""
        own = np.array([shard.number.get(t, -1) for t in self.terms], np.int64)
        for table, who, cuts in self.sizes:
            there = own[table]
            for k in np.flatnonzero((there >= 0).all(axis=1)).tolist():
                yield there[k].tolist(), who[cuts[k] : cuts[k + 1]].tolist()


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """Lists of (item, text), each of at most about block_bytes, fetched one partition at a time."""
    rows, size = [], 0
    picked = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).dropna()
    for item, text in picked.toLocalIterator():
        rows.append((item, text.encode()))
        size += len(rows[-1][1])
        if size >= block_bytes:
            yield rows
            rows, size = [], 0
    yield rows


SCHEMA = "shard string, place int, doc_id long, n_words long, spans binary, items array<string>"


def match(index: DataFrame, block: list[tuple[str, bytes]], out: str, width: int = WIDTH, slop: int | None = None, every: bool = True) -> DataFrame:
    """Match one block of items and write the result: shard, place (of the document in it), doc_id, n_words, spans, items.

    spans are pairs of first and last-but-one word, merged, as 64-bit integers. every: also documents without a match. With a slop
    the words of a window may stand in any order within a run of as many words as the window has, and slop more.
    """
    spark = index.sparkSession
    sent = spark.sparkContext.broadcast(Windows(block, width))

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                shard = Shard.load(row)
                m, hits, who = Matcher(shard), [], {}
                for terms, items in sent.value.within(shard):
                    reach = len(terms) + (slop or 0)
                    found = m.phrase(terms) if slop is None else m.near(terms, reach)
                    if len(found):
                        hits.append(np.stack((found, found + reach), axis=1))
                        for d in np.unique(np.searchsorted(shard.starts, found, "right") - 1):
                            who.setdefault(int(d), set()).update(items)
                spans: dict[int, list] = {}
                if hits:
                    for lo, hi in merged(np.concatenate(hits)):
                        d = int(np.searchsorted(shard.starts, lo, "right")) - 1
                        spans.setdefault(d, []).append((lo - shard.starts[d], min(hi - shard.starts[d], shard.counts[d])))
                docs = np.arange(len(shard.ids)) if every else np.array(sorted(who), np.int64)
                for at in range(0, len(docs), 4096):
                    some = docs[at : at + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["shard"]] * len(some)), pa.array(some.astype(np.int32)), pa.array(shard.ids[some]), pa.array(shard.counts[some]),
                            pa.array([np.array(spans.get(d, []), np.int64).tobytes() for d in some.tolist()], pa.binary()),
                            pa.array([[sent.value.items[x] for x in sorted(who.get(d, ()))] for d in some.tolist()], pa.list_(pa.string())),
                        ],
                        ["shard", "place", "doc_id", "n_words", "spans", "items"],
                    )

    made = write_once(index.mapInArrow(tidy(run), SCHEMA), out)
    sent.destroy()
    return made


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of half-open spans, sorted."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    heads = np.flatnonzero(new)
    return np.stack((spans[heads, 0], reach[np.append(heads[1:] - 1, len(spans) - 1)]), axis=1)


def _digest(batches):
    for b in batches:
        n_hit, n_items, sha = [], [], []
        for s, items in zip(b.column("spans").to_pylist(), b.column("items").to_pylist()):
            x = np.frombuffer(s, np.int64).reshape(-1, 2)
            n_hit.append(int((x[:, 1] - x[:, 0]).sum()))
            n_items.append(len(items))
            sha.append(hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_words"), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sha), pa.array([x > 0 for x in n_hit])], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, width: int = WIDTH, slop: int | None = None, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = ITEM_BLOCK_BYTES
) -> DataFrame:
    """Per document: doc_id, n_words, spans, items over the whole benchmark; exact phrases, or with a slop proximity matches too (see match).

    Blocks of items are matched one after another, and each block's broadcast goes before the next, so that driver and workers hold
    one block. Later blocks give rows for matching documents only, which are added to those of the first by place in the index.
    """
    out = work_dir(docs.sparkSession, "postings")
    index = build_index(docs, f"{out}/index", id_col=id_col, text_col=text_col)
    frames = [match(index, b, f"{out}/block-{k}", width, slop, every=not k) for k, b in enumerate(_blocks(benchmark, item_col, item_text, block_bytes))]
    if len(frames) == 1:
        return frames[0].drop("shard", "place")
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    joined = union.groupBy("shard", "place").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.collect_list("spans").alias("s"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def fold(batches):
        for b in batches:
            spans = []
            for parts in b.column("s").to_pylist():
                x = np.frombuffer(b"".join(parts), np.int64).reshape(-1, 2)
                spans.append((merged(x) if len(x) else x).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_words"), pa.array(spans, pa.binary()), b.column("items")], ["doc_id", "n_words", "spans", "items"])

    return joined.drop("shard", "place").mapInArrow(tidy(fold), "doc_id long, n_words long, spans binary, items array<string>")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of what contamination() found."""
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return found.mapInArrow(tidy(_digest), schema).select(null_id(), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    return digest(contamination(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))))
