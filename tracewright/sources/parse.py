"""Session records of any shape as one table of sessions and one of steps, routed by the keys that a record has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import steps as S
from tracewright.functions.text import contains_any, is_blank, truthy_coalesce
from tracewright.sources.logs import parse_lenient_session, parse_text_session, session_format, user_input_text

#: Name of the agent of records that name none, unless the caller has another.
UNNAMED = "unnamed"
_FALSY = ('""', "0", "0.0", "-0.0", "false", "null", "[]", "{}")
# Fixed value: the error text of results that only a flag marks as failed.
INFERRED_BY_FLAG = "inferred_error"
# Outcomes that an object may state.
_STATED = ("success", "failure", "partial", "abandoned")


def at(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def text_of(v: Column, key: str) -> Column:
    """The value of `key` as text (JSON text of arrays and objects), null where it is missing or null."""
    return F.try_variant_get(v, f"$.{key}", "string")


def first_of(v: Column, *keys: str) -> Column:
    """The first value among `keys` that is not null, empty, zero or false, as text."""
    return F.coalesce(*[F.when(~F.to_json(at(v, k)).isin(*_FALSY), text_of(v, k)) for k in keys])


def kind(v: Column) -> Column:
    """The type of a variant's top level: STRING, BIGINT, BOOLEAN, VOID, ARRAY…, OBJECT…; null where it is missing."""
    return F.schema_of_variant(v)


def layout_steps(v: Column) -> Column:
    """The array of step objects of a sample in any of its four layouts: a list, an object that holds one under either key, or beside; empty where there is none."""
    lists = lambda path: F.try_variant_get(v, path, "array<variant>")
    nested = F.when(at(v, "trajectory.trajectory").isNotNull(), lists("$.trajectory.trajectory")).when(at(v, "trajectory.steps").isNotNull(), lists("$.trajectory.steps")).otherwise(lists("$.steps"))
    return F.coalesce(F.when(kind(at(v, "trajectory")).startswith("ARRAY"), lists("$.trajectory")).otherwise(nested), F.array().cast("array<variant>"))


def layout_user_input(v: Column) -> Column:
    """The request of a sample: that of its trajectory object, else its own."""
    return F.coalesce(first_of(v, "trajectory.user_input"), text_of(v, "user_input"), F.lit(""))


def structured(records: DataFrame) -> DataFrame:
    """The records whose object `v` has all of session_id, trajectory and user_input, whatever they hold."""
    return records.filter((session_format(F.col("v")) == "structured") & at(F.col("v"), "session_id").isNotNull() & at(F.col("v"), "user_input").isNotNull())


def structured_sessions(records: DataFrame, keys: list[str], unnamed: str = UNNAMED) -> DataFrame:
    """`keys`, `session_id`, `user_input`, `final_output`, `agent`, `model_version`, `created_at` (as written) and `outcome` of structured records."""
    v = F.col("v")
    stated = F.lower(text_of(v, "session_outcome.status"))
    outcome = (
        F.when(kind(at(v, "session_outcome")) == "STRING", S.outcome(text_of(v, "session_outcome")))
        .when(stated.isin(*_STATED), stated).otherwise("unknown")
    )
    return structured(records).select(
        *keys, text_of(v, "session_id").alias("session_id"), user_input_text(v).alias("user_input"), text_of(v, "final_output").alias("final_output"),
        F.when(at(v, "agent").isNull(), unnamed).otherwise(text_of(v, "agent")).alias("agent"), text_of(v, "metadata.model_version").alias("model_version"), text_of(v, "created_at").alias("created_at"), outcome.alias("outcome"),
    )


def _step_number(s: Column, pos: Column) -> Column:
    """The number of a step: its own, cut to an integer, else its place; null where it is no number."""
    own, shape = text_of(s, "step_id"), kind(at(s, "step_id"))
    whole = F.when(shape == "STRING", F.when(own.rlike(r"^\s*[+-]?\d{1,18}\s*$"), F.trim(own).try_cast("bigint"))).when(shape == "BOOLEAN", F.when(own == "true", 1).otherwise(0))
    return F.when(at(s, "step_id").isNull(), pos).otherwise(F.coalesce(whole, F.when(shape.startswith("BIGINT") | shape.startswith("DECIMAL") | (shape == "DOUBLE"), own.try_cast("double").cast("bigint"))))


def structured_steps(records: DataFrame, keys: list[str]) -> DataFrame:
    """`keys`, `pos` (place in the record) and the fields of every step of structured records, by the names that each type of step goes by.

    A step that is no object, whose type is no text or whose number is no number is left out. A result without status, with an unknown one or with
    a clean success is checked for flags, error texts and the wording of its output; what is inferred is marked in `error`.
    """
    v = F.col("v")
    steps = structured(records).select(*keys, F.posexplode(F.try_variant_get(v, "$.trajectory", "array<variant>")).alias("p", "s"))
    s, pos = F.col("s"), (F.col("p") + 1).cast("bigint")
    named = F.when(at(s, "type").isNotNull(), at(s, "type")).otherwise(at(s, "step_type"))
    steps = steps.filter(kind(s).startswith("OBJECT")).withColumn("pos", pos).withColumn("named", named)
    steps = steps.filter(F.col("named").isNull() | (kind(F.col("named")) == "STRING"))
    steps = steps.withColumn("step_id", _step_number(s, F.col("pos"))).filter("step_id is not null").withColumn("step_type", S.step_type(F.col("named").cast("string")))
    is_ = lambda *kinds: F.col("step_type").isin(*kinds)
    content = F.when(is_("reasoning"), first_of(s, "content", "text", "thinking")).when(is_("output"), first_of(s, "content", "text", "output"))
    raw = text_of(s, "status")
    read = steps.select(
        *keys, "pos", "step_id", "step_type", text_of(s, "timestamp").alias("ts"), content.alias("content"),
        F.when(is_("tool_call"), first_of(s, "tool_name", "tool")).alias("tool_name"), F.when(is_("tool_call"), first_of(s, "skill_context", "skill")).alias("skill_context"),
        F.when(is_("tool_call"), F.coalesce(first_of(s, "input_params", "params", "arguments"), F.lit("{}"))).alias("input_params"),
        F.when(is_("tool_call"), first_of(s, "metadata.call_id", "call_id", "id")).when(is_("tool_result"), first_of(s, "call_id", "result_call_id")).alias("call_id"),
        raw.alias("raw"), at(s, "status").isNull().alias("unstated"),
        ((text_of(s, "isError") == "true") & (kind(at(s, "isError")) == "BOOLEAN")).alias("flag_a"), ((text_of(s, "is_error") == "true") & (kind(at(s, "is_error")) == "BOOLEAN")).alias("flag_b"),
        F.when(is_("tool_result"), first_of(s, "output", "result", "content")).alias("output"), F.when(is_("tool_result"), first_of(s, "error", "error_message")).alias("error"),
        F.when(is_("tool_result"), F.coalesce(first_of(s, "latency_ms"), first_of(s, "metadata.latency_ms")).try_cast("double")).alias("latency_ms"),
        F.when(is_("skill_route"), first_of(s, "skill_selected", "skill")).alias("skill_selected"), F.when(is_("skill_route"), F.try_variant_get(s, "$.skill_candidates", "array<string>")).alias("skill_candidates"),
        F.when(is_("skill_route"), first_of(s, "routing_reason", "reason")).alias("routing_reason"),
        F.when(is_("skill_route"), F.coalesce(first_of(s, "metadata.confidence"), first_of(s, "confidence")).try_cast("double")).alias("routing_confidence"),
    )
    written = F.when(F.col("unstated"), "success").otherwise(S.status(F.col("raw")))
    unsure = F.col("raw").isNull() | (written == "pending") | ((written == "success") & F.col("error").isNull())
    flagged = F.coalesce(F.col("flag_a"), F.lit(False)) | F.coalesce(F.col("flag_b"), F.lit(False)) | ~is_blank(F.col("error"))
    worded = contains_any(F.col("output"), S.ERROR_TEXTS)
    result = F.col("step_type") == "tool_result"
    status = F.when(result, F.when(unsure & (flagged | worded), "error").otherwise(written))
    error = F.when(result & unsure & flagged, F.coalesce("error", F.lit(INFERRED_BY_FLAG))).when(result & unsure & worded, F.coalesce("error", F.lit(S.INFERRED))).otherwise(F.col("error"))
    return read.withColumn("status", status).withColumn("error", error).drop("raw", "unstated", "flag_a", "flag_b")


_STEP = ("pos", "step_id", "step_type", "content", "tool_name", "input_params", "call_id", "status", "output")


def parsed(records: DataFrame, keys: list[str], unnamed: str = UNNAMED) -> tuple[DataFrame, DataFrame]:
    """Sessions and steps of all records (`v`, and `keys` that name them): structured, plain text and lenient ones, each by its own rules.

    Sessions have `format`; records that are no object, lack a needed key or show no request have no row. Sessions without a name get one from
    their keys, so that reruns agree.
    """
    v = F.col("v")
    name = lambda fmt: F.concat(F.lit(fmt + "_"), F.left(F.sha2(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]), 256), F.lit(16)))
    fmt = records.withColumn("format", session_format(v))
    whole = structured_sessions(records, keys, unnamed).withColumn("format", F.lit("structured"))
    lines = F.array_join(F.try_variant_get(v, "$.log_lines", "array<string>"), "\n")
    plain = fmt.filter("format = 'unstructured'").withColumn("text", F.coalesce(lines, text_of(v, "text"))).withColumn("s", parse_text_session(F.col("text"))).filter("s is not null")
    own = lambda k: F.coalesce(text_of(v, k), F.col(f"s.{k}"))
    plain_rows = plain.select(
        *keys, F.coalesce(own("session_id"), name("unstructured")).alias("session_id"), own("user_input").alias("user_input"), F.col("s.final_output").alias("final_output"),
        F.coalesce(text_of(v, "agent"), F.lit(unnamed)).alias("agent"), F.lit(None).cast("string").alias("model_version"), text_of(v, "created_at").alias("created_at"), F.col("s.outcome").alias("outcome"), "format",
    )
    loose = fmt.filter("format = 'lenient'").withColumn("s", parse_lenient_session(v)).filter("s is not null")
    loose_rows = loose.select(
        *keys, truthy_coalesce(F.col("s.session_id"), name("lenient")).alias("session_id"), "s.user_input", "s.final_output", F.coalesce(text_of(v, "agent"), F.lit(unnamed)).alias("agent"),
        F.lit(None).cast("string").alias("model_version"), "s.created_at", S.outcome(F.col("s.outcome")).alias("outcome"), "format",
    )
    none = lambda c: F.lit(None).cast("string").alias(c)
    a = structured_steps(records, keys).select(*keys, *_STEP)
    b = plain.select(*keys, F.posexplode("s.steps").alias("p", "x")).select(
        *keys, (F.col("p") + 1).cast("bigint").alias("pos"), (F.col("p") + 1).cast("bigint").alias("step_id"), "x.step_type", none("content"), "x.tool_name", F.to_json("x.input_params").alias("input_params"), none("call_id"), none("status"), none("output")
    )
    c = loose.filter("s.steps is not null").select(*keys, F.posexplode("s.steps").alias("p", "x")).select(
        *keys, (F.col("p") + 1).cast("bigint").alias("pos"), F.col("x.step_id").cast("bigint").alias("step_id"), "x.step_type", "x.content", none("tool_name"), none("input_params"), "x.call_id", "x.status", "x.output"
    )
    return whole.unionByName(plain_rows).unionByName(loose_rows), a.unionByName(b).unionByName(c)


def step_warnings(steps: DataFrame, keys: list[str]) -> DataFrame:
    """`keys`, `gap` (numbers do not run from 1) and `unpaired` (call ids of only calls or only results), for records with either."""
    per = steps.groupBy(*keys).agg(
        F.max(F.col("step_id") != F.col("pos")).alias("gap"),
        F.collect_set(F.when(F.col("step_type") == "tool_call", F.col("call_id"))).alias("c"), F.collect_set(F.when(F.col("step_type") == "tool_result", F.col("call_id"))).alias("r"),
    )
    unpaired = F.array_sort(F.array_union(F.array_except("c", "r"), F.array_except("r", "c")))
    return per.select(*keys, "gap", unpaired.alias("unpaired")).filter("gap or size(unpaired) > 0")
