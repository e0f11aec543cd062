"""Logs read from files: line-delimited JSON, single JSON documents, plain text, and session records of any of their shapes."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.text import strip, truthy_coalesce

#: File names of each kind of log.
EVENT_LOGS, SESSION_LOGS = "*.trajectory.jsonl", "*.{jsonl,json,log,ndjson}"


def _files(spark: SparkSession, path: str, pattern: str, whole: bool) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("wholetext", str(whole).lower())
    return reader.format("text").load(path).select("value", F.col("_metadata.file_path").alias("file"))


def json_lines(spark: SparkSession, path: str, pattern: str = EVENT_LOGS) -> DataFrame:
    """`file`, `value` (text) and `v` (variant) of every non-blank line under `path`; `v` is null where a line is not JSON."""
    lines = _files(spark, path, pattern, False).filter(strip(F.col("value")) != "")
    return lines.withColumn("v", F.try_parse_json("value"))


def event_log(spark: SparkSession, path: str) -> DataFrame:
    """Raw events in the columns of the table `raw_events`, malformed lines passed over; `event_row` orders lines within their file."""
    v = json_lines(spark, path).filter("v is not null")
    get = lambda p, t="string": F.try_variant_get("v", p, t)
    return v.select(
        F.monotonically_increasing_id().alias("event_row"), F.col("file").alias("file_name"), get("$.sessionId").alias("session_id"), get("$.traceId").alias("trace_id"),
        get("$.seq", "bigint").alias("seq"), get("$.sourceSeq", "bigint").alias("source_seq"), get("$.type").alias("event_type"), get("$.ts").alias("ts"),
        get("$.agentId").alias("agent_id"), get("$.modelId").alias("model_id"), get("$.provider").alias("provider"), get("$.sessionKey").alias("session_key"),
        get("$.parentSessionId").alias("parent_session_id"), get("$.data").alias("data"),
    )


def json_documents(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """`file`, `v`: the elements of files that hold a JSON array, the whole of others; files that are not JSON have no row."""
    docs = _files(spark, path, pattern, True).withColumn("v", F.try_parse_json("value")).filter("v is not null")
    lists = F.try_variant_get("v", "$", "array<variant>")
    return docs.select("file", F.explode(F.coalesce(lists, F.array("v"))).alias("v"))


def text_logs(spark: SparkSession, path: str, pattern: str = "*.log") -> DataFrame:
    """`file`, `chunk`, `text`: plain logs cut before each mention of a session, blank pieces left out."""
    whole = _files(spark, path, pattern, True)
    pieces = whole.select("file", F.posexplode(F.split("value", r"(?i)(?=session[_-]?id[:\s])")).alias("chunk", "text"))
    return pieces.filter(strip(F.col("text")) != "")


def session_records(spark: SparkSession, path: str) -> DataFrame:
    """`file`, `at` and `v` of every record of all session logs under `path`, by the kind of file; `v` is null where a record is not JSON.

    Files of lines hold one record a line, as does any other file that shows an object at the start of a line among its first 200 characters; other
    .json files hold a list of records or one; other .log files are cut at each mention of a session, each piece a record of `text`.
    """
    files = _files(spark, path, SESSION_LOGS, True)
    name = F.lower("file")
    lined = name.rlike(r"\.(jsonl|ndjson)$") | F.left("value", F.lit(200)).contains("\n{")
    whole = files.filter(~name.rlike(r"\.(jsonl|ndjson)$"))
    rows = _files(spark, path, "*.{jsonl,ndjson}", False).select("file", F.monotonically_increasing_id().alias("at"), "value")
    odd = whole.filter(lined).select("file", F.posexplode(F.split("value", "\n")).alias("at", "value")).withColumn("at", F.col("at").cast("bigint"))
    lines = rows.unionByName(odd).filter(strip(F.col("value")) != "").select("file", "at", F.try_parse_json("value").alias("v"))
    docs = whole.filter(~lined & name.endswith(".json")).withColumn("v", F.try_parse_json("value"))
    lists = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    docs = docs.select("file", F.posexplode(lists).alias("at", "v")).withColumn("at", F.col("at").cast("bigint"))
    pieces = whole.filter(~lined & ~name.endswith(".json")).select("file", F.posexplode(F.split("value", r"(?i)(?=session[_-]?id[:\s])")).alias("at", "text")).filter(strip(F.col("text")) != "")
    texts = pieces.select("file", F.col("at").cast("bigint").alias("at"), F.to_variant_object(F.struct("text")).alias("v"))
    return lines.unionByName(docs).unionByName(texts)


def parse_errors(records: DataFrame) -> DataFrame:
    """`file`, `records`, `json_parse_error`: how many records of each file are not JSON."""
    return records.groupBy("file").agg(F.count("*").alias("records"), F.count_if(F.col("v").isNull()).alias("json_parse_error"))


def existing(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[str]]:
    """The paths that exist, and those that do not."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = [jvm.org.apache.hadoop.fs.Path(p).getFileSystem(conf).exists(jvm.org.apache.hadoop.fs.Path(p)) for p in paths]
    return [p for p, ok in zip(paths, there, strict=True) if ok], [p for p, ok in zip(paths, there, strict=True) if not ok]


def load_lines(spark: SparkSession, paths: list[str], strict: bool = False) -> DataFrame:
    """`file`, `v` of every line of the files `paths`.

    By default lines that are not JSON are passed over, and paths that do not exist are named in a warning. With `strict` either fails the query.
    """
    found, missing = existing(spark, paths)
    if missing and strict:
        raise FileNotFoundError(", ".join(missing))
    if missing:
        warnings.warn(f"no such path: {', '.join(missing)}", stacklevel=2)
    if not found:
        return spark.createDataFrame([], "file string").withColumn("v", F.parse_json(F.lit("null")))
    lines = spark.read.text(found).select(F.col("_metadata.file_path").alias("file"), "value").filter(strip(F.col("value")) != "")
    v = F.parse_json("value") if strict else F.try_parse_json("value")
    return lines.select("file", v.alias("v")).filter("v is not null")


def union_sources(parts: dict[str, DataFrame], rejected: str = "rejected") -> DataFrame:
    """The rows of all `parts` by name, columns missing in some being null, with `source_file` and `is_rejected`."""
    out = None
    for name, df in parts.items():
        own = df.withColumn("source_file", F.lit(name)).withColumn("is_rejected", F.lit(name == rejected))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def session_format(v: Column) -> Column:
    """structured, unstructured or lenient by the keys present; null where `v` is no object."""
    kind = F.schema_of_variant(v)
    has = lambda k: F.try_variant_get(v, f"$.{k}", "variant").isNotNull()
    return F.when(~kind.startswith("OBJECT"), None).when(has("trajectory"), "structured").when(has("log_lines") | has("text"), "unstructured").otherwise("lenient")


def user_input_text(v: Column, path: str = "$.user_input") -> Column:
    """A request that is a text, or an object with `raw` or `text`."""
    get = lambda p: F.try_variant_get(v, path + p, "string")
    return F.coalesce(truthy_coalesce(get(".raw"), get(".text")), get(""))


_SESSION, _USER = r"(?i)session[_-]?id[:\s]+(\S+)", r"(?i)user[_:](.+?)(?:\n|tool_call|\z)"
_CALL, _FINAL = r"(?i)tool_call[:\s]+(\w+)\s*\(([^)]*)\)", r"(?s)final_output[:\s]+(.+?)(?:\n\n|\z)"
_KWARG = r"""(\w+)\s*=\s*["']?([^,'"]+)["']?"""


def parse_text_session(text: Column) -> Column:
    """Session, request, calls with parameters, final output and outcome of a plain-text log; null where it shows no request."""
    part = lambda p: F.nullif(strip(F.regexp_extract(text, p, 1)), F.lit(""))
    names, args = F.regexp_extract_all(text, F.lit(_CALL), 1), F.regexp_extract_all(text, F.lit(_CALL), 2)

    def params(a: Column) -> Column:
        keys, values = F.regexp_extract_all(a, F.lit(_KWARG), 1), F.regexp_extract_all(a, F.lit(_KWARG), 2)
        pairs = F.zip_with(keys, values, lambda k, x: F.struct(k.alias("key"), strip(x).alias("value")))
        # A key that is given twice keeps its last value.
        return F.map_from_entries(F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(F.transform(pairs, lambda q: q["key"]), i + 2, 2**30), p["key"])))

    steps = F.zip_with(names, args, lambda n, a: F.struct(F.lit("tool_call").alias("step_type"), n.alias("tool_name"), params(a).alias("input_params")))
    outcome = F.when(text.rlike(r"(?i)error|failed|失败"), "likely_failure").otherwise("likely_success")
    session = F.struct(part(_SESSION).alias("session_id"), part(_USER).alias("user_input"), steps.alias("steps"), part(_FINAL).alias("final_output"), outcome.alias("outcome"))
    return F.when(part(_USER).isNotNull(), session)


def parse_lenient_session(v: Column) -> Column:
    """Session, request, output, outcome word and steps of an object of unknown shape; null where none of six keys holds a request.

    Messages of the assistant are thoughts, those of tools results; a step is numbered by its message.
    """
    get = lambda k: F.try_variant_get(v, f"$.{k}", "string")
    first = lambda *ks: truthy_coalesce(*[get(k) for k in ks])
    msgs = F.try_variant_get(v, "$.messages", "array<struct<role:string,content:string,tool_call_id:string>>")

    def step(m: Column, i: Column) -> Column:
        result = m["role"] == "tool"
        return F.struct(
            (i + 1).alias("step_id"), F.when(result, "tool_result").otherwise("reasoning").alias("step_type"),
            F.when(~result, m["content"]).alias("content"), F.when(result, m["content"]).alias("output"), F.when(result, m["tool_call_id"]).alias("call_id"),
            F.when(result, "success").alias("status"), m["role"].alias("role"),
        )

    steps = F.filter(F.transform(msgs, step), lambda s: s["role"].isin("assistant", "tool"))
    request = first("user_input", "query", "prompt", "input", "message", "content")
    own = F.struct(
        first("session_id", "id").alias("session_id"), request.alias("user_input"), first("final_output", "output", "response").alias("final_output"),
        first("outcome", "status").alias("outcome"), first("created_at", "timestamp").alias("created_at"), steps.alias("steps"),
    )
    return F.when(request.isNotNull(), own)
