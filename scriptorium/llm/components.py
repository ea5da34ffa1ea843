"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 256


def join_groups(rows: DataFrame, groups: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """rows with the columns of groups, which has one row for each key and the column n, how many of the rows have it; n goes.

    Keys that hold more than one in HOT_SHARE of all rows (so at most HOT_SHARE keys, whatever the data) are met by
    broadcast, where their rows lie; the others by a shuffle, in which no key has more than that share.
    """
    most = max(64, total // HOT_SHARE)
    hot = groups.where(F.col("n") > most).toArrow()
    cold = groups.where(F.col("n") <= most).drop("n")
    if not hot.num_rows:
        return rows.join(cold, key, how)
    hot = F.broadcast(rows.sparkSession.createDataFrame(hot, groups.schema).drop("n"))
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key, how))


def _least(rows: DataFrame) -> DataFrame:
    """(u, v) rows → u, m (the smallest of u and its v), n (rows of u)."""
    return rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")


def components(links: DataFrame, out: str, rounds: int = 100) -> DataFrame:
    """(u, v) links of long ids → (u, root), root the smallest id of u's component, for every u that isn't a root.

    Each round is written below out, which cuts the lineage and survives lost executors. Null ends and loops don't count.
    """
    spark = links.sparkSession

    def step(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        df.where("u <> v").distinct().write.parquet(f"{out}/{name}")
        df = spark.read.schema("u long, v long").parquet(f"{out}/{name}")
        return df, tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges, state = step(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).dropna(), "links")
    for k in range(rounds):
        if not state[0]:
            break
        both, total = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), 2 * state[0]
        large = join_groups(both, _least(both), "u", total).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = _least(large)
        small = join_groups(large, least, "u", total).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges, new = step(small, f"round-{k}")
        if new == state:
            break
        state = new
    return edges.select("u", F.col("v").alias("root"))


def with_roots(nodes: DataFrame, root: DataFrame, total: int) -> DataFrame:
    """nodes (node, least id) and their roots → (node, component_id), the smallest id of all nodes of the component."""
    group = nodes.join(root, nodes["node"] == root["u"], "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    ids = group.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    return join_groups(group.select("node", "root"), ids, "root", total).select("node", "component_id")
