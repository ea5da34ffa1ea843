"""Shared plumbing of the training-data operators.

Work files live below the folder that the session names in ``spark.checkpoint.dir`` (shared by the driver and all
executors); only a local session without that setting gets a folder of its own. Executors write whole files under a
temporary name and rename them, and a later job opens only the names that successful tasks reported, so lost
executors and repeated tasks leave no half-read file behind.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import io
import tempfile
import threading
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id inside the operators; results show null again.
NULL_ID = (1 << 63) - 1
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_made: dict[str, int] = {}  # work folders and the threads that made them


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder shared by driver and executors."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base if "://" in base or base.startswith("file:") else f"file://{base}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not getattr(spark.sparkContext, "_scriptorium_dir", None):
        spark.sparkContext._scriptorium_dir = f"file://{tempfile.mkdtemp(prefix='scriptorium-')}"
    return spark.sparkContext._scriptorium_dir


def _forget() -> None:
    """Work folders go with the driver; what an operator was told to write elsewhere stays."""
    for uri in list(_made):
        try:
            remove(uri)
        except OSError:  # the shared folder went first
            pass


atexit.register(_forget)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, empty folder for one run of an operator."""
    small_batches(spark)
    uri = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    fs, path = fs_of(uri)
    fs.create_dir(path, recursive=True)
    _made[uri] = threading.get_ident()
    return uri


def remove(uri: str) -> None:
    """Delete a work folder whose files no plan reads any more."""
    fs, path = fs_of(uri)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_dir(path)
    _made.pop(uri, None)


def made() -> set[str]:
    """The work folders that this thread made and that still stand."""
    return {uri for uri, thread in _made.items() if thread == threading.get_ident()}


def fs_of(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def put_file(uri: str, write) -> None:
    """Run write(stream) on a temporary name, then move the file to its place."""
    fs, path = fs_of(uri)
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(tmp) as out:
        write(out)
    fs.move(tmp, path)


def put_bytes(uri: str, data: bytes) -> None:
    put_file(uri, lambda out: out.write(data))


def get_bytes(uri: str) -> bytes:
    fs, path = fs_of(uri)
    with fs.open_input_file(path) as f:
        return f.read()


def put_table(uri: str, table: pa.Table) -> None:
    sink = io.BytesIO()
    with pa.ipc.new_file(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    put_bytes(uri, sink.getvalue())


def get_table(uri: str) -> pa.Table:
    return pa.ipc.open_file(pa.BufferReader(get_bytes(uri))).read_all()


def small_batches(spark: SparkSession) -> None:
    """Batches between JVM and workers hold at most BATCH_BYTES or one row, unless the session says otherwise; long texts fill memory else."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns doc_id (null: NULL_ID) and text (null: empty, as bytes). Ids must be numbers or text of numbers; others fail the job."""
    small_batches(docs.sparkSession)
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def fresh(columns: list[str], name: str) -> str:
    """name, with marks before it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without the columns of these names, which a result of its own replaces."""
    gone = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in gone))


def null_id(col: str = "doc_id"):
    return F.nullif(F.col(col), F.lit(NULL_ID)).alias(col)


#: Of a worker process: what empties a cache, and the modules whose functions use it.
_caches: list[tuple[Callable[[], None], frozenset[str]]] = []


def register_cache(clear: Callable[[], None], *users: str) -> None:
    """A cache that outlives tasks. It stays while a worker runs functions of the users (module names) and goes when others run there."""
    _caches.append((clear, frozenset(users)))


def give_back() -> None:
    """Return freed memory to the system; allocators keep it otherwise, and executors keep idle workers."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(f: Callable) -> Callable:
    """f for mapInArrow, in workers that operators share: caches that f's module doesn't use go first, freed memory goes back after."""
    user = f.__module__.rpartition(".")[2]

    def run(batches):
        for clear, users in _caches:
            if user not in users:
                clear()
        try:
            yield from f(batches)
        finally:
            give_back()

    run.__module__ = f.__module__
    return run


BITS = 1 << 26


def flagged(rows: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """rows with a column flag, false only where the key surely isn't among the keys.

    The keys' hashes fill a bitmap of fixed size, at most BITS bits in pages of 4 KB, whatever their number; it is broadcast, so
    that wide rows without a partner needn't be shuffled. An exact join of the flagged rows has to follow.
    """
    at = lambda: F.pmod(F.xxhash64(F.col(key)), F.lit(BITS))
    page, place = fresh(rows.columns, "_page"), fresh(rows.columns, "_bitmap")
    pages = keys.groupBy(F.bitmap_bucket_number(at()).alias(page)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at())).alias(place))
    bit = F.bitmap_bit_position(at())
    byte = F.conv(F.hex(F.substring(F.col(place), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.withColumn(page, F.bitmap_bucket_number(at())).join(F.broadcast(pages), page, "left")
    return met.withColumn(flag, F.coalesce(byte.bitwiseAND(F.expr("1").cast("int") * F.pow(F.lit(2), bit % 8).cast("int")) > 0, F.lit(False))).drop(page, place)


def left_out(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """rows whose key isn't among those of gone; only rows that the bitmap flags are shuffled."""
    gone, flag = gone.select(key).distinct(), fresh(rows.columns, "_flag")
    met = flagged(rows, gone, key, flag)
    return met.where(~F.col(flag)).drop(flag).unionByName(met.where(flag).drop(flag).join(gone, key, "left_anti"))


#: Text of the corpus for each bucket of an exchange, so that a bucket's memory doesn't grow with the input.
BUCKET_BYTES = 16 << 20


def exchange_parts(docs: DataFrame, text_col: str) -> int:
    """Buckets of an exchange: one for each BUCKET_BYTES of text, at least the session's shuffle partitions."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    return max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def drop_shuffles(spark: SparkSession) -> None:
    """Let executors delete the shuffle files of jobs that no plan needs any more; else they stay until the driver happens to collect garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shrink_heaps(spark: SparkSession) -> None:
    """Let executors collect their garbage and return the memory. A heap that has grown stays as large else, and leaves the next stage's workers less.

    There is one task for each core, so that every executor that is free gets some; one that gets none keeps its heap, results are the same.
    """
    n = max(1, spark.sparkContext.defaultParallelism)
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')").alias("done")).collect()


def write_once(df: DataFrame, uri: str) -> DataFrame:
    """Cut the lineage with a written table, so that side effects in df run in one job only, and drop the shuffles behind it."""
    df.write.mode("overwrite").parquet(uri)
    drop_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


class Grouper:
    """Collects rows until their texts reach a size, so that a unit of work has bounded memory."""

    def __init__(self, limit: int):
        self.limit, self.rows, self.size = limit, [], 0

    def add(self, ids: list, texts: list):
        """Yield full units (ids, texts)."""
        for i, t in zip(ids, texts):
            self.rows.append((i, t))
            self.size += len(t) + 64
            if self.size >= self.limit:
                yield self.take()

    def take(self):
        rows, self.rows, self.size = self.rows, [], 0
        return [r[0] for r in rows], [r[1] for r in rows]


def units(batches, limit: int):
    """(ids, texts) units of at most about limit bytes from record batches of (doc_id, text)."""
    g = Grouper(limit)
    for b in batches:
        step = max(1, int(b.num_rows * limit / max(1, b.nbytes) / 2))
        for at in range(0, b.num_rows, step):
            part = b.slice(at, step)
            yield from g.add(part.column(0).to_pylist(), part.column(1).to_pylist())
    if g.rows:
        yield g.take()


def distinct_sorted(a: np.ndarray) -> np.ndarray:
    """Distinct values of a sorted array."""
    return a[np.concatenate(([True], a[1:] != a[:-1]))] if len(a) else a
