"""Token-ID files: independent zstandard frames, a trailing seek table, checksums per frame.

A shard is a valid file of the public zstd seekable format: frames of at most FRAME_BYTES of little-endian ids, then
one frame with the document index, then a skippable frame (magic 0x184D2A5E) with the compressed size, decompressed
size and low 32 bits of the XXH64 of every frame, closed by the frame count, the flag byte and magic 0x8F92EAB1. A reader fetches
the tail, the index, and then only the frames that hold the documents asked for.

Nulls: a null text counts as empty, a null id sorts last and comes back as null. Empty table: no shard, no rows.
Repeated ids are kept, ordered by text. Other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import fs_of, id_text, null_id, put_file, register_cache, tidy, work_dir, write_once

FRAME_BYTES = 1 << 20
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # fixed values of the format
_INDEX = np.dtype([("doc_id", "<i8"), ("at", "<u8"), ("n", "<u8")])
_HEAD = struct.Struct("<8sBQ")  # magic, bytes per id, documents


class Encoder:
    """Encodes through the tokenizers library, once for each distinct chunk between ASCII white space.

    The vocabulary's pre-tokenizer drops white space, and neither its normaliser nor its pattern looks across it, so
    the ids of a text are those of its chunks in order. Texts of ASCII alone are lower-cased first, as the normaliser would
    (marks of special tokens excepted, which stand for themselves); others go to it as they are, since it composes characters
    before it lower-cases. For vocabularies of which that doesn't hold (``local=False``) whole texts go to the library.
    """

    def __init__(self, path: str, local: bool = True, most: int = 1_200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.local, self.most, self.known = local, most, {}
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4

    def _library(self, texts: list[str]) -> list[bytes]:
        kind = f"<u{self.width}"
        return [np.asarray(e.ids, kind).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.local:
            return self._library([t.decode() for t in texts])
        if len(self.known) > self.most:
            self.known.clear()
        known, chunks = self.known, [(t.lower() if t.isascii() and b"<|" not in t else t).split() for t in texts]
        new = set().union(*chunks).difference(known)
        # A chunk that ends in one full stop or comma after an ASCII letter is that word and that mark.
        cut = {c for c in new if c[-1:] in b".," and c[-2:-1].isalpha()}
        words = list((new - cut) | {c[:-1] for c in cut if c[:-1] not in known} | {m for m in (b".", b",") if m not in known})
        known.update(zip(words, self._library([w.decode() for w in words])))
        for c in cut:
            known[c] = known[c[:-1]] + known[c[-1:]]
        get = known.__getitem__
        return [b"".join(map(get, c)) for c in chunks]


_encoders: dict[tuple, Encoder] = {}
register_cache(_encoders.clear, "token_files")


def encoder(path: str, local: bool) -> Encoder:
    if (path, local) not in _encoders:
        _encoders[path, local] = Encoder(path, local)
    return _encoders[path, local]


class ShardWriter:
    """Writes ids of documents to a stream; holds one frame and the index."""

    def __init__(self, out, width: int):
        self.out, self.width, self.buf, self.at = out, width, bytearray(), 0
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int]] = []
        self.zip = zstandard.ZstdCompressor(level=3)

    def add(self, doc_id: int, ids: bytes) -> None:
        self.index.append((doc_id, self.at // self.width, len(ids) // self.width))
        self.at += len(ids)
        self.buf += ids
        while len(self.buf) >= FRAME_BYTES:
            self._frame(bytes(self.buf[:FRAME_BYTES]))
            del self.buf[:FRAME_BYTES]

    def _frame(self, data: bytes) -> None:
        packed = self.zip.compress(data)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.out.write(packed)

    def close(self) -> None:
        if self.buf:
            self._frame(bytes(self.buf))
        self._frame(_HEAD.pack(b"TOKSHARD", self.width, len(self.index)) + np.array(self.index, _INDEX).tobytes())
        body = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)


class ShardReader:
    """Reads the documents of a shard, fetching only their frames; every frame's checksum is verified."""

    def __init__(self, uri: str):
        fs, path = fs_of(uri)
        self.f = fs.open_input_file(path)
        size = self.f.size()
        n, flags, magic = struct.unpack("<IBI", self.f.read_at(9, size - 9))
        if magic != SEEKABLE or not flags & 0x80:
            raise ValueError(f"{uri}: no seek table with checksums")
        table = self.f.read_at(12 * n + 9 + 8, size - 12 * n - 17)
        if struct.unpack_from("<II", table) != (SKIPPABLE, 12 * n + 9):
            raise ValueError(f"{uri}: damaged seek table")
        self.table = np.frombuffer(table, "<u4", 3 * n, 8).reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.table[:, 0])))
        self.plain = np.concatenate(([0], np.cumsum(self.table[:, 1])))
        self.unzip, self.last = zstandard.ZstdDecompressor(), (-1, b"")
        head = self.frame(n - 1)
        magic, self.width, docs = _HEAD.unpack_from(head)
        if magic != b"TOKSHARD":
            raise ValueError(f"{uri}: no document index")
        self.index = np.frombuffer(head, _INDEX, docs, _HEAD.size)

    def frame(self, k: int) -> bytes:
        if self.last[0] != k:
            size, plain, check = self.table[k]
            data = self.unzip.decompress(self.f.read_at(int(size), int(self.starts[k])), max_output_size=int(plain))
            if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {k} fails its checksum")
            self.last = (k, data)
        return self.last[1]

    def ids(self, row: int) -> np.ndarray:
        """The ids of the row-th document of the index."""
        a, n = int(self.index["at"][row]) * self.width, int(self.index["n"][row]) * self.width
        k, parts = int(np.searchsorted(self.plain, a, "right")) - 1, []
        while n > 0:
            piece = self.frame(k)[a - int(self.plain[k]) :][:n]
            parts.append(piece)
            a, n, k = a + len(piece), n - len(piece), k + 1
        return np.frombuffer(b"".join(parts), f"<u{self.width}")

    def rows(self, doc_ids) -> np.ndarray:
        return np.flatnonzero(np.isin(self.index["doc_id"], doc_ids))


def write_shards(docs: DataFrame, tokenizer: str, out: str, *, end_id: int, id_col: str = "doc_id", text_col: str = "text", local: bool = True) -> DataFrame:
    """Encode all texts and write shards in ascending id order below out; returns the manifest.

    Manifest: shard long (order), path, docs, ids, start (ids in all shards before it).
    """
    spark = docs.sparkSession

    def write(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        enc = encoder(tokenizer, local)
        end = np.array([end_id], f"<u{enc.width}").tobytes()
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        path, sums = f"{out}/part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}.tok.zst", [0, 0]

        def fill(stream):
            w = ShardWriter(stream, enc.width)
            import itertools

            for b in itertools.chain([first], batches):
                for at in range(0, b.num_rows, 512):
                    part = b.slice(at, 512)
                    for i, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist())):
                        w.add(i, ids + end)
            w.close()
            sums[:] = len(w.index), w.at // enc.width

        put_file(path, fill)
        yield pa.RecordBatch.from_pydict({"shard": [ctx.partitionId()], "path": [path], "docs": [sums[0]], "ids": [sums[1]]})

    rows = id_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    made = write_once(rows.mapInArrow(tidy(write), "shard long, path string, docs long, ids long"), f"{out}/_made")
    # One row for each shard of many MB.
    at, full = 0, []
    for r in sorted(made.collect()):
        full.append((*r, at))
        at += r["ids"]
    return spark.createDataFrame(full, "shard long, path string, docs long, ids long, start long")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers)."""

    def read(batches):
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                r = ShardReader(path)
                for at in range(0, len(r.index), 20_000):
                    some = r.index[at : at + 20_000]
                    crc = [zlib.crc32(r.ids(k).astype("<u4").tobytes()) for k in range(at, at + len(some))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some["doc_id"]), pa.array(some["at"].astype("i8") + start), pa.array(some["n"].astype("i8")), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    n = max(1, manifest.count())
    spread = manifest.repartition(n)
    return spread.mapInArrow(tidy(read), "doc_id long, start long, n_tokens long, ids_crc32 long").select(null_id(), "start", "n_tokens", "ids_crc32")


def read_documents(manifest: DataFrame, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids (array of int) of the documents asked for; other frames aren't decompressed."""

    def read(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                r = ShardReader(path)
                for k in r.rows(doc_ids):
                    yield pa.RecordBatch.from_arrays([pa.array([int(r.index["doc_id"][k])]), pa.array([r.ids(k).astype("i4")], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return manifest.repartition(max(1, manifest.count())).mapInArrow(tidy(read), "doc_id long, ids array<int>")


def op1_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = write_shards(docs, public_tokenizers.path("word_bpe_49k.json"), work_dir(spark, "tokens"), end_id=1)
    return read_shards(made)
