"""Streams of pages: complete documents and session counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def complete_documents(pages: DataFrame, timeout_ms: int = 600_000) -> DataFrame:
    """A stream of (doc_id, page, pages, md) → (doc_id, text, complete): a document when all its pages are there, or as far as it came after the timeout."""

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = dict(zip(*state.get)) if state.exists else {}
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"doc_id": [key[0]], "text": ["\n".join(held[k] for k in sorted(held))], "complete": [False]})
            return
        total = 0
        for f in frames:
            held |= dict(zip(f["page"].tolist(), f["md"].tolist()))
            total = int(f["pages"].max())
        if total and len(held) >= total:
            if state.exists:
                state.remove()
            yield pd.DataFrame({"doc_id": [key[0]], "text": ["\n".join(held[k] for k in sorted(held))], "complete": [True]})
        else:
            state.update((list(held), list(held.values())))
            state.setTimeoutDuration(timeout_ms)

    return pages.groupBy("doc_id").applyInPandasWithState(run, "doc_id string, text string, complete boolean", "page array<int>, md array<string>", "append", GroupStateTimeout.ProcessingTimeTimeout)


def session_counts(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """user_id, start, end, n of event sessions."""
    w = F.session_window("ts", gap)
    return events.withWatermark("ts", late).groupBy("user_id", w.alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
