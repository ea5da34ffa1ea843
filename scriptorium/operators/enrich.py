"""Model-backed enrichment behind an injectable client, with a keyed cache."""

from __future__ import annotations

from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, text


class ModelClient(Protocol):
    """Anything picklable with this method; retries, pacing and secrets are its own business."""

    def complete(self, model: str, prompt: str, max_tokens: int) -> str: ...


class EchoClient:
    """A stub for tests: the prompt's last line."""

    def complete(self, model: str, prompt: str, max_tokens: int) -> str:
        return prompt.rstrip().rpartition("\n")[2][:max_tokens]


def cache_key(model: str, prompt, max_tokens: int):
    return F.sha2(F.concat_ws("\n", F.lit(model), F.lit(str(max_tokens)), text(prompt)).cast("binary"), 256)


def cache_lookup(rows: DataFrame, cache: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(rows with response, null where the cache has none; distinct missing keys with a prompt)."""
    hits = rows.join(cache.select(key, "response").dropDuplicates([key]), key, "left")
    return hits, hits.where("response is null").groupBy(key).agg(F.min("prompt").alias("prompt"))


def complete(missing: DataFrame, client: ModelClient, model: str, max_tokens: int) -> DataFrame:
    """key, response; a failed call gives null. The caller repartitions to limit concurrency."""

    def run(frames):
        for f in frames:
            out = []
            for p in f["prompt"]:
                try:
                    out.append(client.complete(model, p, max_tokens))
                except Exception:  # noqa: BLE001  any failure of a model call is a row without response
                    out.append(None)
            yield pd.DataFrame({"key": f["key"], "response": out})

    return missing.select("key", "prompt").mapInPandas(run, "key string, response string")


def fallback(rows: DataFrame) -> DataFrame:
    """problem_finally, naturalize_status and notes without a model."""
    c, p = strip(text("problem_with_context")), strip(text("problem"))
    pick = lambda a, b, d: F.when(c != "", a).when(p != "", b).otherwise(d)
    return rows.withColumns({
        "problem_finally": pick(c, p, F.lit("")),
        "naturalize_status": pick(F.lit("fallback_context"), F.lit("fallback_original"), F.lit("failed")),
        "notes": pick(F.lit("llm_empty_or_unavailable"), F.lit("llm_empty_or_unavailable"), F.lit("empty_problem_and_context")),
    })


def status_counts(rows: DataFrame, by: list[str] = ()) -> DataFrame:
    s = F.col("naturalize_status")
    count = lambda test, name: F.count_if(test).alias(name)
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), count(s == "ok", "ok"), count(s.startswith("fallback"), "fallback"), count(s == "skipped", "skipped"), count(s == "failed", "failed"))


def first_json(c):
    """The text if it is a JSON object, else the stretch from its first to its last brace if that is one, else null."""
    t = strip(text(c))
    inner = F.regexp_extract(t, r"(?s)\{.*\}", 0)
    is_object = lambda x: F.coalesce(x.startswith("{") & F.json_object_keys(x).isNotNull(), F.lit(False))
    return F.when(is_object(t), t).when(is_object(inner), inner)


def valid_rewrite(original, candidate, field: str = "problem"):
    """The candidate has the original's keys in their order, and only the field differs."""
    keys = F.json_object_keys(original)
    a, b = (F.from_json(x, "map<string,string>") for x in (original, candidate))
    return F.coalesce((keys == F.json_object_keys(candidate)) & F.forall(F.filter(keys, lambda k: k != field), lambda k: F.element_at(a, k).eqNullSafe(F.element_at(b, k))), F.lit(False))
