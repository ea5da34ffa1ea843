"""Reference indexes: joins, priorities, ambiguity, closure."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def resolve(refs: DataFrame, index: DataFrame, on: list[str], value: str) -> DataFrame:
    """Left join of references to an index; resolved tells hits."""
    hit = index.select(*on, value, F.lit(True).alias("resolved"))
    return refs.join(hit, on, "left").withColumn("resolved", F.coalesce("resolved", F.lit(False)))


def priority_merge(first: DataFrame, second: DataFrame, on: str, value: str) -> DataFrame:
    """Entries of first, and those of second whose key first hasn't."""
    both = first.select(on, F.col(value).alias("a"), F.lit(True).alias("_f")).join(second.select(on, F.col(value).alias("b")), on, "full")
    return both.select(on, F.when(F.col("_f"), F.col("a")).otherwise(F.col("b")).alias(value), F.coalesce("_f", F.lit(False)).alias("from_first"))


def first_entries(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where("_n = 1").drop("_n")


def unambiguous(rows: DataFrame, tag: str, value: str, order: str) -> DataFrame:
    """Tags with one distinct value, with the value of the first entry."""
    return rows.groupBy(tag).agg(F.count_distinct(value).alias("_n"), F.min_by(value, order).alias(value)).where("_n = 1").drop("_n")


def expand_suffixes(refs: DataFrame, index: DataFrame, tag: str = "tag") -> DataFrame:
    """References to a base that the index lacks → all suffixed tags (14.44 → 14.44a, 14.44b, ...)."""
    base = index.where(F.col(tag).rlike(r"^\d+(?:\.\d+)*[A-Za-z]$")).select(F.regexp_extract(tag, r"^(.*)[A-Za-z]$", 1).alias("_base"), F.col(tag).alias("expanded")).distinct()
    bare = refs.join(index.select(tag).distinct(), tag, "left_anti")
    return bare.join(base, bare[tag] == base["_base"]).drop("_base")


def closure(edges: DataFrame, seeds: DataFrame, rounds: int | None = 5, out: str | None = None) -> DataFrame:
    """(src, dst) edges, (root, node) seeds → every (root, node, depth) reachable within rounds (None: at all), at its least depth."""
    seen = seeds.select("root", "node", F.lit(0).alias("depth"))
    front = seen
    for k in count(1) if rounds is None else range(1, rounds + 1):
        new = front.join(edges, front["node"] == edges["src"]).select("root", F.col("dst").alias("node")).distinct()
        front = new.join(seen.select("root", "node"), ["root", "node"], "left_anti").withColumn("depth", F.lit(k))
        if out:  # a written table cuts the lineage of long closures
            front.write.mode("overwrite").parquet(f"{out}/{k}")
            front = edges.sparkSession.read.parquet(f"{out}/{k}")
        if rounds is None:  # a checkpoint cuts the lineage, whose plan doubles with each round
            front = front.localCheckpoint()
            if front.isEmpty():
                break
        seen = seen.unionByName(front)
    return seen


def as_of(left: DataFrame, right: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """For each left row the value of the nearest right row before it in the group (union and last value, no range join)."""
    rows = left.select(by, order, F.lit(None).cast(right.schema[value].dataType).alias(value), F.lit(True).alias("_l"))
    rows = rows.unionByName(right.select(by, order, value, F.lit(False).alias("_l")))
    w = Window.partitionBy(by).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(value, F.last(value, ignorenulls=True).over(w)).where("_l").drop("_l")
