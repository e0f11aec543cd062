"""Companion message logs: found beside an event log, and read as tool uses, tool results and thoughts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.text import truthy_coalesce
from tracewright.operators.assembly import is_error_result
from tracewright.sources.logs import json_lines


def companion_files(files: DataFrame) -> DataFrame:
    """`event_file`, `companion`: the first by name of the files of its folder that continue an event log's name.

    `files` has the path column `file`. A log named `<base>.trajectory.jsonl` goes with `<base>.jsonl` or `<base>….jsonl.deleted.…`; bases of fewer
    than eight characters have none. Both sides meet by folder and the first eight characters, so no folder is compared with itself in full.
    """
    f = files.select(F.col("file"), F.regexp_extract("file", r"^(.*/)?([^/]*)$", 1).alias("dir"), F.regexp_extract("file", r"([^/]*)$", 1).alias("name")).distinct()
    logs = f.filter(F.col("name").endswith(".trajectory.jsonl")).withColumn("base", F.replace("name", F.lit(".trajectory.jsonl"), F.lit("")))
    logs = logs.filter(F.length("base") >= 8).select(F.col("file").alias("event_file"), "dir", "base", F.left("base", F.lit(8)).alias("head"))
    others = f.filter(~F.col("name").endswith(".trajectory.jsonl")).select("file", "dir", "name", F.left("name", F.lit(8)).alias("head"))
    fits = (F.col("name") == F.concat("base", F.lit(".jsonl"))) | (F.col("name").startswith(F.col("base")) & F.col("name").contains(".jsonl.deleted."))
    return logs.join(others, ["dir", "head"]).filter(fits).groupBy("event_file").agg(F.min_by("file", "name").alias("companion"))


def companion_parts(spark: SparkSession, path: str, pattern: str = "*.jsonl*") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tool uses (`file`, `call_id`, `name`, `input`, `first`), results (`file`, `call_id`, `content`, `is_error`) and thoughts (`file`, `at`, `text`).

    A call id that comes again overrides what it said before and keeps its first place.
    """
    lines = json_lines(spark, path, pattern).filter("v is not null").filter(F.try_variant_get("v", "$.type", "string") == "message")
    lines = lines.withColumn("line", F.monotonically_increasing_id())
    msg = lambda p, t="string": F.try_variant_get("v", f"$.message{p}", t)
    rows = lines.select("file", "line", msg(".role").alias("role"), msg(".toolCallId").alias("result_of"), msg(".content", "array<variant>").alias("parts"))
    each = rows.select("file", "line", "role", F.posexplode("parts").alias("k", "p")).withColumn("at", F.struct("line", "k"))
    part = lambda k, t="string": F.try_variant_get("p", f"$.{k}", t)
    uses = each.filter(part("type").isin("toolCall", "tool_use")).select(
        "file", "at", truthy_coalesce(part("id"), part("callId")).alias("call_id"), part("name").alias("name"), truthy_coalesce(part("input"), part("arguments")).alias("input")
    )
    uses = uses.filter("call_id is not null").groupBy("file", "call_id").agg(F.max_by("name", "at").alias("name"), F.max_by("input", "at").alias("input"), F.min("at").alias("first"))
    thoughts = each.select(
        "file", "at", F.when(part("type") == "thinking", part("thinking")).when((part("type") == "text") & (F.col("role") == "assistant"), part("text")).alias("text")
    ).filter(F.trim("text") != "")
    nested = F.transform(F.coalesce(F.try_variant_get("p", "$.content", "array<struct<text:string>>"), F.array().cast("array<struct<text:string>>")), lambda x: x["text"])
    texts = F.when(part("type") == "text", part("text")).when(part("type") == "toolResult", F.array_join(nested, "\n"))
    results = (
        rows.filter("role = 'toolResult' and coalesce(result_of, '') <> ''").select("file", "line", "result_of", F.posexplode_outer("parts").alias("k", "p"))
        .select("file", "line", "result_of", "k", texts.alias("t"))
        .groupBy("file", "line", "result_of").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "t"))), lambda x: x["t"]), "\n").alias("content"))
        .groupBy("file", F.col("result_of").alias("call_id")).agg(F.max_by("content", "line").alias("content"))
    )
    return uses, results.withColumn("is_error", is_error_result(F.col("content"))), thoughts
