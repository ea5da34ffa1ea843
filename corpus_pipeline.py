"""A corpus pipeline of five operators. Each stage takes (spark, docs, sf_dir) and returns rows with the columns of documents, the last its ids.

Work folders of a stage go when the next stage of that thread starts, since its result is written by then, and executors return what their heaps don't need. Stages keep all columns
of their input, whatever their names; null, repeated and missing ids are told apart by a row key of a name that is free.
"""

from __future__ import annotations

import threading
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import _common, bpe, decontaminate, quality, simhash, substrings

_last = threading.local()


def _stage(f):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for uri in getattr(_last, "made", ()):
            _common.remove(uri)
        _common.shrink_heaps(spark)
        before = _common.made()
        out = f(spark, docs, sf_dir)
        _last.made = _common.made() - before
        return out

    run.__doc__ = f.__doc__
    return run


@_stage
def quality_stage(spark, docs, sf_dir):
    """Documents whose score stays under the threshold go."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def near_dedup_stage(spark, docs, sf_dir):
    """Of each group of similar documents one row stays, of the smallest id; rows without an id come last."""
    docs, row = _keyed(docs)
    group = simhash.similar_documents(docs, id_col=row, unique_ids=True).select(F.col("doc_id").alias(row), "component_id")
    rows = group.join(docs.select(row, F.col("doc_id").alias("_id")), row)
    first = rows.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull(), "_id", row))[row].alias(row))
    return _without(docs, row, group.join(first, row, "left_anti"))


@_stage
def substring_stage(spark, docs, sf_dir):
    """Repeated runs of words go; n_chars follows the text."""
    words, removed = (_common.fresh(docs.columns, c) for c in ("n_words", "n_removed"))
    kept = substrings.remove_repeats(docs, names=(words, removed))
    return kept.select(*(F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).alias("n_chars") if c == "n_chars" else c for c in docs.columns))


@_stage
def decontamination_stage(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark item go."""
    docs, row = _keyed(docs)
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row)
    return _without(docs, row, found.where(F.size("items") > 0).select(F.col("doc_id").alias(row)))


@_stage
def encoding_stage(spark, docs, sf_dir):
    """doc_id, n_tokens and the digests of ids and of the decoded text."""
    return bpe.digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a key of their own, written once, and the key's name; ids can be null or repeated."""
    uri, row = _common.work_dir(docs.sparkSession, "rows"), _common.fresh(docs.columns, "_row")
    return _common.write_once(docs.withColumn(row, F.monotonically_increasing_id()), uri), row


def _without(docs: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """Keyed rows that aren't among those of gone, without the key."""
    uri = _common.work_dir(docs.sparkSession, "gone")
    return _common.left_out(docs, _common.write_once(gone.select(row), uri), row).drop(row)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", encoding_stage),
]
#: Stages that search, learn or tokenise have no SQL. The operators are tested against brute force; run() as a whole is not yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{_common.shared_dir(spark)}/llm/pipeline-{uuid.uuid4().hex[:12]}"
    before = None
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{k}")
        docs = spark.read.parquet(f"{out}/{k}")
        if before:
            _common.remove(before)
        before = f"{out}/{k}"
    return docs
