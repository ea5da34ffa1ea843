"""Sources and sinks: whole-text pages, JSON records, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """doc_id (path below the folder, without suffix), text."""
    df = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path, wholetext=True)
    name = F.col("_metadata.file_path")
    root = path.rstrip("/").rpartition("/")[2]
    return df.select(F.regexp_replace(F.substring_index(name, f"/{root}/", -1), r"\.[^./]+$", "").alias("doc_id"), F.col("value").alias("text"))


def exercises(spark: SparkSession, path: str) -> DataFrame:
    """Exercise objects anywhere in JSON files, in document order: doc_id, ord, object (JSON)."""
    import json

    from pyspark.sql.functions import udtf

    def found(node):
        if isinstance(node, dict):
            if "problem" in node and {"proof", "direct_answer", "source_idx", "source", "题目类型", "预估难度"} & node.keys():
                yield node
                return
            node = list(node.values())
        if isinstance(node, list):
            for x in node:
                yield from found(x)

    @udtf(returnType="ord int, object string")
    class Scan:
        def eval(self, value: str):
            try:
                node = json.loads(value)
            except ValueError:
                return
            for k, x in enumerate(found(node)):
                yield k, json.dumps(x, ensure_ascii=False)

    spark.udtf.register("scan_exercises", Scan)
    documents(spark, path, "*.json").createOrReplaceTempView("_json_documents")
    return spark.sql("select doc_id, ord, object from _json_documents, lateral scan_exercises(text)")


def pending(inputs: DataFrame, done: DataFrame, on: str = "doc_id") -> DataFrame:
    """Inputs without a complete output."""
    return inputs.join(done.where("complete").select(on), on, "left_anti")


def write_records(rows: DataFrame, path: str) -> None:
    """JSON lines; the committer publishes files only when the job has succeeded."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def stats(spark: SparkSession, path: str) -> DataFrame:
    """Counters of stage statistics; what can't be read counts as 0."""
    names = ("rows", "llm_touched", "ok", "fallback", "skipped", "failed")
    df = documents(spark, path, "*.stats.json")
    parsed = F.from_json("text", "map<string,string>")
    return df.select("doc_id", *(F.coalesce(parsed[n].try_cast("int"), F.lit(0)).alias(n) for n in names))
