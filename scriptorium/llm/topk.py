"""Exact top-k inner products by columnar branch-and-bound.

Candidates lie in vertical layout, one row per dimension. Scores build up dimension block by dimension block; after a block, a
candidate is dropped for a query if its partial score plus the product of both remaining norms stays under the
query's k-th best, and the survivors are compacted. Queries go to the executors in blocks of at most QUERY_BLOCK
vectors, so what is broadcast never grows with the data; candidates are never shuffled.

Components become floor(scale * x). Vectors that are null, or hold null or non-finite components, take no part, nor do
those whose squared quantised norm reaches 2**62 (their scores may not fit a long). Vectors meet only vectors of their
own length. A query's own id is no candidate; a repeated query id is asked once, with its smallest vector. Repeated
candidate rows each count. Ties go to the smaller id, a null id last. Fewer candidates than k: all. No query: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import NULL_ID, tidy, work_dir

QUERY_BLOCK, ROW_BLOCK, DIM_BLOCK, PANEL = 4096, 4096, 16, 128


def quantised(batch: pa.RecordBatch, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length: ids and the matrix of floor(scale * x), without vectors that take no part."""
    ids, col = np.asarray(batch.column(0)), batch.column(1)
    length = pa.compute.list_value_length(col).fill_null(-1).to_numpy(zero_copy_only=False)
    flat = pa.compute.list_flatten(col).cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(np.maximum(length, 0))))
    out = {}
    for d in np.unique(length[length >= 0]):
        rows = np.flatnonzero(length == d)
        x = flat[starts[rows][:, None] + np.arange(d)]
        rows, x = rows[(ok := np.isfinite(x).all(axis=1))], x[ok]
        x = np.floor(scale * x)
        ok = (x * x).sum(axis=1) < 2.0**62
        if ok.any():
            out[int(d)] = ids[rows[ok]], x[ok]
    return out


class Best:
    """The k best (score, id) so far of each query of a block."""

    def __init__(self, m: int, k: int):
        self.k = k
        self.q, self.s, self.i = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = np.full(m, -np.inf)

    def add(self, q, s, i):
        q, s, i = np.concatenate((self.q, q)), np.concatenate((self.s, s)), np.concatenate((self.i, i))
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        self.q, self.s, self.i = q[place < self.k], s[place < self.k], i[place < self.k]
        last = place == self.k - 1
        self.least[q[last]] = s[last]


def _rest(x: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Norms of what remains of each row from each cut on."""
    return np.stack([np.sqrt((x[:, c:] ** 2).sum(axis=1)) for c in cuts])


def scan(qids, q, ids, x, best: Best) -> None:
    """Score a block of candidates x (rows of quantised vectors) for all queries q."""
    d = q.shape[1]
    exact = max((q * q).sum(axis=1).max(initial=0), (x * x).sum(axis=1).max(initial=0)) < 2.0**53
    kind = np.float64 if exact else np.int64
    tall, cuts = np.ascontiguousarray(x.T.astype(kind)), [*range(DIM_BLOCK, d, DIM_BLOCK), d]
    left, right, q = _rest(q, cuts), _rest(x, cuts), q.astype(kind)
    for a in range(0, len(q), PANEL):
        panel, at = q[a : a + PANEL], 0
        score, pairs = np.zeros((len(panel), x.shape[0]), kind), None
        least = best.least[a : a + PANEL]
        for c, cut in enumerate(cuts):
            if pairs is None:
                score += panel[:, at:cut] @ tall[at:cut]
                bound = score + left[c, a : a + PANEL, None] * right[c] * (1 + 1e-9) + 0.5
                alive = bound >= least[:, None]
                if cut == d or np.count_nonzero(alive) < 0.2 * alive.size:
                    qi, ci = np.nonzero(alive)
                    pairs, score = True, score[qi, ci]
            else:
                score = score + (panel[qi, at:cut] * tall[at:cut].T[ci]).sum(axis=1)
                alive = score + left[c, a + qi] * right[c, ci] * (1 + 1e-9) + 0.5 >= least[qi]
                qi, ci, score = qi[alive], ci[alive], score[alive]
            at = cut
        if pairs is None:  # vectors without components
            qi, ci = np.nonzero(np.ones_like(score, bool))
            score = score[qi, ci]
        ok = ids[ci] != qids[a + qi]
        best.add(a + qi[ok], score[ok].astype(np.int64), ids[ci[ok]])


def exact_topk(rows: DataFrame, queries: DataFrame, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates among rows for every query."""
    spark = rows.sparkSession
    pick = lambda df: df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    out, source = work_dir(spark, "topk"), pick(rows)
    whole = F.expr("v is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    source, schema = source.where(whole), "query_id long, vec_id long, score long"
    pick(queries).where(whole).where(F.col("vec_id") != NULL_ID).groupBy("vec_id").agg(F.min("v").alias("v")).write.parquet(f"{out}/queries")
    asked, last, page = spark.read.parquet(f"{out}/queries"), None, 0
    while True:
        block = (asked if last is None else asked.where(F.col("vec_id") > last)).orderBy("vec_id").limit(QUERY_BLOCK).toArrow()
        if not block.num_rows:
            break
        last, data = block.column(0)[-1].as_py(), quantised(block.combine_chunks().to_batches()[0], scale)
        sent = spark.sparkContext.broadcast(data)

        def run(batches, sent=sent):
            best = {d: Best(len(i), k) for d, (i, _) in sent.value.items()}
            for b in batches:
                for at in range(0, b.num_rows, ROW_BLOCK):
                    for d, (ids, x) in quantised(b.slice(at, ROW_BLOCK), scale).items():
                        if d in best:
                            scan(*sent.value[d], ids, x, best[d])
            for d, own in best.items():
                yield pa.RecordBatch.from_arrays([pa.array(sent.value[d][0][own.q]), pa.array(own.i), pa.array(own.s)], ["query_id", "vec_id", "score"])

        near = source.mapInArrow(tidy(run), schema)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).write.parquet(f"{out}/page-{page:06d}")
        sent.destroy()
        page += 1
    if not page:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = spark.read.parquet(*[f"{out}/page-{p:06d}" for p in range(page)])
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.nullif("vec_id", F.lit(NULL_ID)).alias("vec_id"), "score")


def op9_exact_topk(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return exact_topk(rows, rows.where("vec_id % 20 = 0"), 20)


SQL_OP9 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select a.vec_id query_id, b.vec_id, cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20
"""
