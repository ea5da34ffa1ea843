"""WARC archives inside ZIP packages, read in place.

Each archive is a ZIP file with two stored members: ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdxj`` (a line per record with offset and length inside the stored member). The reader parses the end
record, the ZIP64 records and the central directory, finds where stored members begin, and fetches the index and then
single records by byte range; nothing is extracted.

Of pages with equal payloads, the one with the largest id is a response and the others are revisits of it. Repeated
rows of that id are all responses. Nulls: a null payload is empty, a null url is named by its page, a null id comes back as null
and sorts last. Empty table: no archive, no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zipfile
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import NULL_ID, fs_of, put_file, tidy, work_dir, write_once

WARC, CDXJ = "archive/data.warc.gz", "indexes/index.cdxj"
#: Fixed values of the format.
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EOCD, _EOCD64, _LOCATOR, _CENTRAL, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def _record(kind: str, record_id: str, headers: list[tuple[str, str]], block: bytes, content: str) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE), *headers, ("Content-Type", content), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def page_record(page_id: int, url: str | None, payload: bytes, refers_to: int | None) -> tuple[str, str, bytes]:
    """(type, digest, record) of a page."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    target = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is None:
        return "response", digest, _record("response", f"urn:page:{page_id}", headers, http + payload, "application/http; msgtype=response")
    headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return "revisit", digest, _record("revisit", f"urn:page:{page_id}", headers, http, "application/http; msgtype=response")


class _Stream:
    """Only what the ZIP writer needs of a stream that can't seek."""

    def __init__(self, out):
        self.out = out

    def write(self, data):
        self.out.write(data)
        return len(data)

    def flush(self):
        pass


def write_archive(out, rows) -> int:
    """Write (page_id, url, payload, refers_to) rows as one package; returns the number of records."""
    lines, at = [], 0
    with zipfile.ZipFile(_Stream(out), "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        with z.open(zipfile.ZipInfo(WARC), "w", force_zip64=True) as w:
            at += w.write(gzip.compress(_record("warcinfo", "urn:archive", [], b"format: WARC File Format 1.1\r\n", "application/warc-fields"), 6, mtime=0))
            for page_id, url, payload, refers_to in rows:
                kind, digest, data = page_record(page_id, url, payload, refers_to)
                packed = gzip.compress(data, 6, mtime=0)
                entry = {"url": url or f"urn:page:{page_id}", "digest": digest, "type": kind, "offset": str(at), "length": str(len(packed)), "filename": WARC}
                lines.append(f"{quote(url or '', safe='')} 19700101000000 {json.dumps(entry)}\n")
                at += w.write(packed)
        z.writestr(zipfile.ZipInfo(CDXJ), "".join(sorted(lines)))
    return len(lines)


class ZipArchive:
    """Members of a ZIP file by byte ranges."""

    def __init__(self, uri: str):
        fs, path = fs_of(uri)
        self.f = fs.open_input_file(path)
        size = self.f.size()
        base = max(0, size - 65_557 - 20)
        tail = self.f.read_at(size - base, base)
        end = tail.rfind(_EOCD)
        if end < 0:
            raise ValueError(f"{uri}: no end of central directory")
        n, length, at = struct.unpack_from("<HII", tail, end + 10)
        if (n == 0xFFFF or 0xFFFFFFFF in (length, at)) and end >= 20 and tail[end - 20 : end - 16] == _LOCATOR:
            (where,) = struct.unpack_from("<Q", tail, end - 12)
            rec = self.f.read_at(56, where)
            if rec[:4] != _EOCD64:
                raise ValueError(f"{uri}: damaged ZIP64 record")
            n, length, at = struct.unpack_from("<QQQ", rec, 32)
        self.members: dict[str, tuple[int, int, int]] = {}
        central, p = self.f.read_at(length, at), 0
        for _ in range(n):
            if central[p : p + 4] != _CENTRAL:
                raise ValueError(f"{uri}: damaged central directory")
            method, packed, plain = struct.unpack_from("<H", central, p + 10)[0], *struct.unpack_from("<II", central, p + 20)
            name_n, extra_n, note_n = struct.unpack_from("<HHH", central, p + 28)
            (local,) = struct.unpack_from("<I", central, p + 42)
            name = central[p + 46 : p + 46 + name_n].decode()
            q, stop = p + 46 + name_n, p + 46 + name_n + extra_n
            while q + 4 <= stop:  # the ZIP64 field holds, in order, the values that don't fit
                tag, m = struct.unpack_from("<HH", central, q)
                if tag == 1:
                    wide = list(struct.unpack_from(f"<{m // 8}Q", central, q + 4))
                    plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                    packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                    local = wide.pop(0) if local == 0xFFFFFFFF else local
                q += 4 + m
            self.members[name] = (method, local, packed)
            p = stop + note_n

    def start(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's data."""
        method, local, packed = self.members[name]
        if method:
            raise ValueError(f"{name} isn't stored")
        head = self.f.read_at(30, local)
        if head[:4] != _LOCAL:
            raise ValueError(f"{name}: damaged local header")
        return local + 30 + sum(struct.unpack_from("<HH", head, 26)), packed

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        at, size = self.start(name)
        return self.f.read_at(size - offset if length is None else length, at + offset)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines)
    n = int(headers["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return headers, rest[:n]


def write_archives(pages: DataFrame, out: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, archive_bytes: int = 128 << 20) -> DataFrame:
    """Write all pages below out; returns the manifest (path, records). Payloads under least bytes are always responses."""
    src = pages.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload")
    )
    key = src.where(F.length("payload") >= least).select("page_id", F.sha1("payload").alias("digest"))
    kept = key.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("_least")).where("_least < refers_to").drop("_least")
    revisits = key.join(kept, "digest").where("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()
    # The digest is part of the key: rows of one id may have several payloads.
    rows = src.withColumn("digest", F.sha1("payload")).join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "payload", "refers_to")

    def write(batches):
        from pyspark import TaskContext

        ctx, queue = TaskContext.get(), ((r, b) for b in batches for r in range(b.num_rows))
        one, k = next(queue, None), 0
        while one is not None:
            path, n, size = f"{out}/part-{ctx.partitionId():06d}-{k:04d}-{ctx.taskAttemptId()}.wacz", [0], 0

            def some():
                nonlocal one, size
                while one is not None and size < archive_bytes:
                    row = [c[one[0]].as_py() for c in one[1].columns]
                    size += len(row[2])
                    yield row
                    one = next(queue, None)

            put_file(path, lambda stream: n.__setitem__(0, write_archive(stream, some())))
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n[0]]})
            k += 1

    return write_once(rows.mapInArrow(tidy(write), "path string, records long"), f"{out}/_made")


def read_archives(manifest: DataFrame, step: int = 2000) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to, url. Payload digests are verified."""
    parts = manifest.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("records") - 1, F.lit(step).cast("long"))).alias("first")).where("records > 0")
    number = lambda urn: int(urn.strip("<>").rpartition(":")[2])

    def read(batches):
        for b in batches:
            for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                z, out = ZipArchive(path), []
                at, _ = z.start(WARC)
                for line in z.read(CDXJ).decode().splitlines()[first : first + step]:
                    entry = json.loads(line.split(" ", 2)[2])
                    headers, block = parse_record(gzip.decompress(z.f.read_at(int(entry["length"]), at + int(entry["offset"]))))
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"{path}: a payload fails its digest")
                    refers = number(headers["WARC-Refers-To"]) if kind == "revisit" else None
                    out.append((number(headers["WARC-Record-ID"]), size, digest, kind, refers, headers["WARC-Target-URI"]))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()))],
                        ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"],
                    )

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    back = parts.repartition(max(1, parts.count())).mapInArrow(tidy(read), schema)
    null = lambda c: F.nullif(F.col(c), F.lit(NULL_ID)).alias(c)
    return back.select(null("page_id"), "payload_bytes", "payload_digest", "record_type", null("refers_to"), "url")


def op7_warc(spark, sf_dir: str) -> DataFrame:
    made = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), work_dir(spark, "warc"))
    return read_archives(made).drop("url")
