"""Token counts from an exact histogram of encoded lengths.

Documents are aggregated by their encoded length (partial sums before the shuffle), so a hot source or a group of copies costs one
row per task. The histogram has a row per distinct length, bounded by the longest text and not by the documents; running
and suffix sums over it answer totals, quantiles and truncated totals for every context limit.

Nulls: a null text counts as empty, of length 0. Repeated rows count each. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import id_text, tidy
from .bpe import codec


def histogram(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """length, docs, docs_at_least, tokens_at_least, tokens_truncated (all ids if documents are cut at this length)."""

    def count(batches):
        c = codec(tokenizer)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                yield pa.RecordBatch.from_arrays([pa.array([len(c.encode(t.decode())) // 4 for t in b.slice(at, 1024).column(0).to_pylist()], pa.int64())], ["length"])

    rows = id_text(docs, id_col, text_col).select("text").mapInArrow(tidy(count), "length long").groupBy("length").agg(F.count("*").alias("docs"))
    after, before = Window.orderBy(F.desc("length")), Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("length") * F.col("docs")
    sums = rows.select("length", "docs", F.sum("docs").over(after).alias("docs_at_least"), F.sum(own).over(after).alias("tokens_at_least"), F.coalesce(F.sum(own).over(before), F.lit(0)).alias("_shorter"))
    return sums.select("length", "docs", "docs_at_least", "tokens_at_least", (F.col("_shorter") + F.col("length") * F.col("docs_at_least")).alias("tokens_truncated"))


def truncated_total(hist: DataFrame, limit: int) -> int:
    """Ids of all documents if each is cut at limit."""
    return hist.agg(F.coalesce(F.sum(F.least("length", F.lit(limit)) * F.col("docs")), F.lit(0))).first()[0]


def quantile(hist: DataFrame, share: float) -> int | None:
    """The smallest length that at least this share of documents doesn't exceed."""
    total = F.max("docs_at_least").over(Window.partitionBy(F.lit(0)))
    return hist.where("docs > 0").withColumn("_n", total).where(F.col("_n") - F.col("docs_at_least") + F.col("docs") >= F.ceil(F.lit(share) * F.col("_n"))).agg(F.min("length")).first()[0]


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return histogram(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
