"""Merging blocks of one document set into another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import block_key, rstrip, strip, text

END = r"\end{document}"
ENV = "\\newenvironment{origintext}{}{}\n"
MARKER = "% ===== merged blocks =====\n\n"


def wanted(blocks: DataFrame, type_col: str, include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    kind = F.lower(strip(text(type_col)))
    out = blocks.where(kind.isin(list(include))) if include else blocks
    return out.where(~kind.isin(list(exclude))) if exclude else out


def new_blocks(source: DataFrame, target: DataFrame, raw: str, order: list[str], by: list[str] | None = None) -> DataFrame:
    """Source blocks whose normalised text is neither in the target nor earlier in the source."""
    key, by = block_key(raw), by or []
    names = source.columns  # the first row of a key is a partial aggregate, so that a key of very many rows is no one task's
    first = F.min_by(F.struct(*names), F.struct(*order, *[c for c in names if c not in order]))
    s = source.withColumn("_k", key).groupBy(*by, "_k").agg(first.alias("_row"))
    return s.join(target.select(*by, block_key(raw).alias("_k")).distinct(), [*by, "_k"], "left_anti").select("_row.*")


def insert_payload(target, payload, at_end: bool = False):
    """The payload before the last end of the document, or at the end."""
    t, p = text(target), text(payload)
    cut = F.length(t) - F.length(F.substring_index(t, END, -1)) - len(END)
    tail = rstrip(t)
    end = F.concat(tail, F.lit("\n\n"), rstrip(p), F.lit("\n"))
    inside = F.concat(rstrip(F.substring(t, F.lit(1), cut)), F.lit("\n\n"), rstrip(p), F.lit("\n\n"), F.substring(t, cut + 1, F.length(t)))
    return F.when(strip(p) == "", t).when(F.lit(at_end) | ~F.contains(t, F.lit(END)), end).otherwise(inside)


def declare_env(target, uses):
    """The environment's declaration, once, before the document begins."""
    t, at = text(target), F.instr(text(target), r"\begin{document}")
    have = F.contains(t, F.lit(ENV.strip()))
    inside = F.concat(rstrip(F.substring(t, F.lit(1), at - 1)), F.lit("\n" + ENV + "\n"), F.substring(t, at, F.length(t)))
    return F.when(~uses | have, t).when(at > 0, inside).otherwise(F.concat(F.lit(ENV + "\n"), t))


def merge_documents(blocks: DataFrame, target: DataFrame, kept: DataFrame, id_col: str = "doc_id", raw: str = "raw", order: str = "ord", marker: bool = True) -> DataFrame:
    """id, text, kept, skipped: each target text with its kept blocks."""
    rows = F.sort_array(F.collect_list(F.struct(order, raw)))
    some = kept.groupBy(id_col).agg(F.array_join(F.transform(rows, lambda r: r[raw]), "\n\n").alias("_p"), F.count("*").alias("kept"))
    every = blocks.groupBy(id_col).agg(F.count("*").alias("total"))
    t = target.join(some, id_col, "left").join(every, id_col, "left")
    payload = F.when(F.col("_p").isNotNull(), F.concat(F.lit(MARKER if marker else ""), F.col("_p")))
    ready = declare_env("text", F.contains(text("_p"), F.lit(r"\begin{origintext}")))
    n = F.coalesce("kept", F.lit(0))
    return t.select(id_col, insert_payload(ready, payload).alias("text"), n.alias("kept"), (F.coalesce("total", F.lit(0)) - n).alias("skipped"))
