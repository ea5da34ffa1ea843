"""Rounds of work between units of whole documents and buckets of equal content.

stage() splits documents into units of bounded size, writes each unit once to the shared folder, and keeps, of the content
hashes ("anchors") of all units, those that stand in two units or twice in one. Per unit a hash is sent once, so a passage that
a third of all rows share costs one entry a unit. meet() lets every unit send data for its kept anchors to buckets, and
every bucket answer the units. The number of buckets follows the bytes of the corpus. Texts aren't shuffled: a task reads its unit's file.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import NULL_ID, get_table, give_back, put_table, tidy, units, write_once

UNIT_BYTES = 12 << 20
#: An anchor of more units than this is hot: its data is dealt out by finer content.
HOT_UNITS = 64
LOW = np.uint64(1)
ID, TEXT = "__unit_id", "__unit_text"


def groups(batches, key: int = 0) -> Iterator[tuple]:
    """(key, rows) of batches sorted by the key column."""
    now, rows = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[key] != now and rows:
                yield now, rows
                rows = []
            now = row[key]
            rows.append(row)
    if rows:
        yield now, rows


def _units_of(batches, limit: int) -> Iterator[pa.Table]:
    """Tables of at most about limit bytes."""
    parts, size = [], 0
    for b in batches:
        at = 0
        while at < b.num_rows:
            step = max(1, min(b.num_rows - at, int(b.num_rows * (limit - size) / max(1, b.nbytes))))
            part = b.slice(at, step)
            if part.nbytes > limit and step > 1:  # a run of long texts
                part = b.slice(at, max(1, step * limit // part.nbytes))
            parts.append(part)
            size += part.nbytes + 64 * part.num_rows
            at += part.num_rows
            if size >= limit * 0.98:
                yield pa.Table.from_batches(parts)
                parts, size = [], 0
    if parts:
        yield pa.Table.from_batches(parts)


def texts_of(unit: pa.Table) -> tuple[list[int], list[bytes]]:
    return unit.column(ID).to_pylist(), unit.column(TEXT).to_pylist()


def _flagged(h: np.ndarray) -> np.ndarray:
    """Distinct hashes, sorted; the lowest bit tells those found more than once."""
    h, n = np.unique(h | LOW, return_counts=True)
    return np.where(n > 1, h, h ^ LOW)


def stage(docs: DataFrame, id_col: str, text_col: str, out: str, anchors: Callable[[list[bytes]], np.ndarray], parts: int, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """(unit, data): for every unit, the anchors that may have a partner; the lowest bit tells hot ones. Every unit has a row."""
    rows = docs.withColumns({ID: F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)), TEXT: F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")}).drop(text_col)

    def send(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        for k, unit in enumerate(_units_of(batches, unit_bytes)):
            path = f"{out}/units/{ctx.partitionId():06d}-{k:04d}-{ctx.taskAttemptId()}.arrow"
            put_table(path, unit)
            h = _flagged(anchors(texts_of(unit)[1]))
            to = ((h >> LOW) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            h, cuts = h[order], np.searchsorted(to[order], np.arange(parts + 1))
            give_back()
            some = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([*some, zlib.crc32(path.encode()) % parts], pa.int32()), pa.array([path] * (len(some) + 1)), pa.array([*(h[cuts[p] : cuts[p + 1]].tobytes() for p in some), None], pa.binary())], ["bucket", "unit", "data"]
            )

    def find(batches):
        for _, got in groups(batches):
            names = [r[1] for r in got if r[2] is None]
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([None] * len(names), pa.binary())], ["unit", "data"])
            got = [r for r in got if r[2] is not None]
            lists = [np.frombuffer(r[2], np.uint64) for r in got]
            if not lists:
                continue
            every = np.sort(np.concatenate(lists))
            plain = every | LOW
            heads = np.flatnonzero(np.concatenate(([True], plain[1:] != plain[:-1])))
            n = np.diff(np.append(heads, len(plain)))
            twice = np.bitwise_or.reduceat(every, heads) & LOW == LOW
            keep = (n > 1) | twice
            values, hot = plain[heads[keep]], n[keep] > HOT_UNITS
            for r, own in zip(got, lists):
                at = np.searchsorted(values, own | LOW)
                ok = at < len(values)
                ok[ok] = values[at[ok]] == (own | LOW)[ok]
                if ok.any():
                    at = at[ok]
                    yield pa.RecordBatch.from_arrays([pa.array([r[1]]), pa.array([np.where(hot[at], values[at], values[at] ^ LOW).tobytes()], pa.binary())], ["unit", "data"])

    sent = rows.mapInArrow(tidy(send), "bucket int, unit string, data binary").repartition(parts, "bucket").sortWithinPartitions("bucket", "unit")
    return write_once(sent.mapInArrow(tidy(find), "unit string, data binary"), f"{out}/candidates")


def meet(kept: DataFrame, out: str, parts: int, send: Callable[[str, pa.Table, np.ndarray, int], Iterator[tuple[int, bytes]]], answer: Callable[[list[tuple[str, bytes]]], Iterator[tuple[str, bytes]]]) -> DataFrame:
    """(unit, data): the buckets' answers; every unit has a row.

    send(path, unit, anchors, buckets) yields (bucket, data); answer([(unit, data)]) yields (unit, data) for one bucket.
    """

    def sending(batches):
        for path, rows in groups(batches):
            anchors = np.concatenate([np.frombuffer(r[1], np.uint64) for r in rows if r[1]] or [np.zeros(0, np.uint64)])
            sent = list(send(path, get_table(path), np.sort(anchors), parts)) if len(anchors) else []
            give_back()
            yield pa.RecordBatch.from_arrays([pa.array([*(b for b, _ in sent), zlib.crc32(path.encode()) % parts], pa.int32()), pa.array([path] * (len(sent) + 1)), pa.array([*(d for _, d in sent), None], pa.binary())], ["bucket", "unit", "data"])

    def answering(batches):
        for _, rows in groups(batches):
            names = [r[1] for r in rows if r[2] is None]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([None] * len(names), pa.binary())], ["unit", "data"])
            for unit, data in answer([(r[1], r[2]) for r in rows if r[2] is not None]):
                yield pa.RecordBatch.from_arrays([pa.array([unit]), pa.array([data], pa.binary())], ["unit", "data"])

    units_ = kept.repartition(parts, "unit").sortWithinPartitions("unit")
    sent = units_.mapInArrow(tidy(sending), "bucket int, unit string, data binary").repartition(parts, "bucket").sortWithinPartitions("bucket", "unit")
    return write_once(sent.mapInArrow(tidy(answering), "unit string, data binary"), f"{out}/answers")


def finish(answers: DataFrame, docs: DataFrame, text_col: str, extra: str, edit: Callable, binary: bool = False) -> DataFrame:
    """The documents with edited texts and the columns of extra (a DDL string).

    edit(path, unit, answers) gives (list of texts as bytes, list of extra arrays) in the unit's order.
    """
    from pyspark.sql.types import BinaryType, StringType, StructField, StructType

    as_type = BinaryType() if binary else StringType()
    fields = [StructField(f.name, as_type) if f.name == text_col else f for f in docs.schema.fields]
    schema = StructType(fields + StructType.fromDDL(extra).fields)
    names = [f.name for f in schema.fields]

    def run(batches):
        for path, rows in groups(batches):
            unit = get_table(path)
            texts, more = edit(path, unit, [r[1] for r in rows if r[1] is not None])
            give_back()
            text = pa.array(texts, pa.binary())
            cols = {c: unit.column(c) for c in docs_cols if c != text_col} | {text_col: text if binary else text.cast(pa.string())} | dict(zip(names[len(docs_cols) :], more))
            t = pa.table([cols[c] for c in names], names)
            yield from t.to_batches(max_chunksize=2048)

    docs_cols = docs.columns
    return answers.repartition("unit").sortWithinPartitions("unit").mapInArrow(tidy(run), schema)
