"""Sessions assembled from raw events: attributes, artifacts matched to model turns, steps, outcome, links to subagents."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tracewright.functions.steps import ERROR_TEXTS
from tracewright.functions.text import contains_any, filled, fingerprint, is_blank, strip, truthy_coalesce
from tracewright.operators.facts import TASK_NOTE, session_name, session_rows
from tracewright.operators.ordered import look_around, with_position, with_running_sum
from tracewright.sources.tables import cut_lineage


def is_error_result(text: Column) -> Column:
    """Whether a tool's result shows an error: flags of its JSON object decide first, else the wording."""
    v = F.try_parse_json(text)
    get = lambda path: F.try_variant_get(v, path, "string")
    truthy = lambda path: F.coalesce(~get(path).isin("", "false", "0", "[]", "{}", "null"), F.lit(False))
    flagged = (get("$.isError") == "true") | (get("$.is_error") == "true") | truthy("$.error") | truthy("$.error_message") | (get("$.status") == "error")
    clean = truthy("$.success") | truthy("$.block_id") | truthy("$.blocks")
    said = contains_any(text, [*ERROR_TEXTS, "connection refused"])
    return F.when(is_blank(text), False).when(F.coalesce(flagged, F.lit(False)), True).when(clean, False).otherwise(said)


def thinking(text: Column) -> Column:
    """The closed thinking blocks of `text`, trimmed, joined by a blank line."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"(?s)<thinking>(.*?)</thinking>"), 1), strip), "\n\n")


def spoken(text: Column) -> Column:
    """`text` outside its thinking blocks: the pieces, trimmed, without empty ones, joined by a blank line."""
    pieces = F.transform(F.split(text, r"(?s)<thinking>.*?</thinking>"), strip)
    return F.array_join(F.filter(pieces, lambda p: p != ""), "\n\n")


def user_task(prompt: Column) -> Column:
    """The task in a prompt: a subagent's task block, else what the last Human or User says, else the prompt's first 5,000 characters."""
    block = F.regexp_extract(prompt, r"(?s)\[Subagent Task\](.*?)(?:\[|\z)", 1)
    turns = F.split(prompt, r"\n(?:Human|User):\s*")
    last = strip(F.split_part(F.element_at(turns, -1), F.lit("\nAssistant:"), F.lit(1)))
    text = F.when(prompt.contains("[Subagent Task]"), strip(block)).when((F.size(turns) > 1) & (last != ""), last).otherwise(prompt)
    return F.left(text, F.lit(5000))


def event_rows(events: DataFrame) -> DataFrame:
    """One row per event with the parsed payload fields that assembly reads; `no` is its number, `row` orders equal numbers.

    Only a redelivery, equal in all but row number and time of ingestion, counts once.
    """
    v = F.try_parse_json("data")
    same = [F.col(c).cast("string") for c in events.columns if c not in ("event_row", "ingested_at")]
    rows = events.select(
        F.coalesce(F.nullif("session_id", F.lit("")), F.nullif("trace_id", F.lit(""))).alias("sid"),
        F.coalesce("seq", "source_seq", F.lit(0)).cast("bigint").alias("no"),
        fingerprint(*same).alias("copy"), F.col("event_row").alias("row"), F.col("event_type").alias("type"), "ts", "agent_id", "model_id", "provider", "session_key", "parent_session_id",
        F.try_variant_get(v, "$.prompt", "string").alias("prompt"),
        F.try_variant_get(v, "$.assistantTexts", "array<string>").alias("texts"),
        F.try_variant_get(v, "$.toolMetas", "string").alias("metas"),
        truthy_coalesce(F.try_variant_get(v, "$.finalStatus", "string"), F.try_variant_get(v, "$.status", "string")).alias("final_status"),
        truthy_coalesce(F.try_variant_get(v, "$.parentSessionId", "string"), F.try_variant_get(v, "$.parent_session_id", "string"), F.col("parent_session_id")).alias("parent"),
    ).filter("sid is not null")
    cols = [c for c in rows.columns if c not in ("sid", "no", "copy")]
    return rows.groupBy("sid", "no", "copy").agg(F.min_by(F.struct(*cols), "row").alias("e")).select("sid", "no", "e.*")


def session_attributes(rows: DataFrame, unnamed: str = "unnamed") -> DataFrame:
    """Per session what its first and last events say: agent, model, provider, first prompt, last output, final status, rounds."""
    at = lambda c, when=None: F.col(c) if when is None else F.when(when, F.col(c))
    prompts = F.col("type").isin("context.compiled", "prompt.submitted") & (F.coalesce("prompt", F.lit("")) != "")
    order = F.struct("no", "row")
    first = lambda c: F.min_by(F.struct(F.col(c).alias("v")), order)["v"]
    last_text = F.try_element_at("texts", F.lit(-1))
    s = rows.groupBy("sid").agg(
        first("agent_id").alias("first_agent"), first("session_key").alias("key"), first("ts").alias("created_at"), first("provider").alias("provider"),
        F.coalesce(F.nullif(first("model_id"), F.lit("")), F.max_by(F.struct(F.col("model_id").alias("v")), order)["v"]).alias("model_version"),
        F.min_by(at("prompt", prompts), F.when(prompts, order)).alias("prompt"),
        F.max_by(F.struct(last_text.alias("v")), F.when(F.col("type") == "model.completed", order))["v"].alias("last_text"),
        F.max_by("final_status", F.when(F.col("type").isin("trace.artifacts", "session.ended") & F.col("final_status").isNotNull(), order)).alias("final_status"),
        F.max_by(F.struct(F.col("parent").alias("v")), F.when(F.col("type") == "session.started", order))["v"].alias("parent_session_id"),
        F.count_if(F.col("type").isin("context.compiled", "prompt.submitted")).alias("rounds"),
        F.count("*").alias("events"),
    )
    named = F.when(F.col("key").startswith("agent:"), F.split_part("key", F.lit(":"), F.lit(2)))
    out = spoken(F.col("last_text"))
    return s.select(
        "sid", F.coalesce(named, F.nullif("first_agent", F.lit("")), F.lit(unnamed)).alias("agent"), "model_version", "provider", "created_at",
        user_task(F.col("prompt")).alias("user_input"), F.left(F.when(out != "", out).otherwise(F.col("last_text")), F.lit(10000)).alias("final_output"),
        "final_status", "parent_session_id", "rounds", "events",
    )


#: Events of a chain up to which it is folded by built-ins, whose cost grows with the square of the chain; beyond, by a pass whose cost does not.
LONG_CHAIN = 1_000
_PLACE = "struct<no:bigint,row:bigint>"
_MATCHED = f"sid string, artifact {_PLACE}, model {_PLACE}"


def _fold_long(window: int):
    """Greedy matching of the arrays `models` and `arts` of each chain, artifacts looked up by number."""
    schema = to_arrow_schema(StructType.fromDDL(_MATCHED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, models, arts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                numbers, by = [a["no"] for a in arts], [None] * len(arts)
                for m in models:
                    lo, hi = bisect_left(numbers, m["no"] - window), bisect_right(numbers, m["no"] + window)
                    best = min(((abs(numbers[i] - m["no"]), i) for i in range(lo, hi) if by[i] is None), default=None)
                    if best is not None:
                        by[best[1]] = m
                yield pa.RecordBatch.from_pylist([{"sid": sid, "artifact": a, "model": m} for a, m in zip(arts, by, strict=True)], schema)

    return run


def match_artifacts(rows: DataFrame, window: int = 5, long_chain: int = LONG_CHAIN) -> DataFrame:
    """`sid`, `artifact_no`, `artifact_row`, `model_no`, `model_row`: each model turn with texts takes the nearest artifact left within `window` numbers; null where none took it.

    Turns choose in order and what one takes is gone for the next, so each chain of events is folded in order. A gap of more than
    `window` numbers parts chains, and only numbers are gathered, 16 bytes an event. The fold of a chain costs in proportion to its events.
    """
    own = rows.filter("type = 'trace.artifacts' or (type = 'model.completed' and size(texts) > 0)").select("sid", "no", "row", (F.col("type") == "model.completed").alias("model"))
    placed = with_position(own, "sid", "no", "row")
    near = look_around(placed, placed.select("sid", "pos", F.col("no").alias("prior")), "sid", "pos", -1, -1, ["prior"])
    before = F.get("near", F.lit(0))["prior"]
    opens = near.withColumn("opens", (before.isNull() | (F.col("no") - before > window)).cast("int")).drop("near")
    chains = with_running_sum(opens, "sid", "pos", F.col("opens"), "chain").groupBy("sid", "chain").agg(
        F.array_sort(F.collect_list(F.when(F.col("model"), F.struct("no", "row")))).alias("models"), F.array_sort(F.collect_list(F.when(~F.col("model"), F.struct("no", "row")))).alias("arts")
    )
    start = F.struct(F.col("arts").alias("left"), F.array().cast("array<struct<model:struct<no:bigint,row:bigint>,artifact:struct<no:bigint,row:bigint>>>").alias("taken"))

    def take(state: Column, m: Column) -> Column:
        close = F.filter(state["left"], lambda a: F.abs(a["no"] - m["no"]) <= window)
        best = F.array_min(F.transform(close, lambda a: F.struct(F.abs(a["no"] - m["no"]).alias("d"), a.alias("a"))))["a"]
        return F.when(best.isNull(), state).otherwise(
            F.struct(
                F.array_remove(state["left"], best).alias("left"),
                F.array_append(state["taken"], F.struct(m.alias("model"), best.alias("artifact"))).alias("taken"),
            )
        )

    size = F.size("models") + F.size("arts")
    # Three branches read the chains: they are written once.
    chains = cut_lineage(chains.select("sid", "models", "arts"))
    # Long chains are emptied, not only filtered: filters that the optimiser infers from what follows may come before.
    short = chains.select("sid", *[F.when(size <= long_chain, F.col(c)).otherwise(F.slice(c, 1, 0)).alias(c) for c in ("models", "arts")])
    folded = short.select("sid", F.aggregate("models", start, take).alias("r"))
    taken = folded.select("sid", F.explode("r.taken").alias("t")).select("sid", "t.artifact", "t.model")
    left = folded.select("sid", F.explode("r.left").alias("artifact")).withColumn("model", F.lit(None).cast("struct<no:bigint,row:bigint>"))
    named = [F.col(f"{x}.{c}").alias(f"{x}_{c}") for x in ("artifact", "model") for c in ("no", "row")]
    long, matched = chains.filter(size > long_chain), taken.unionByName(left)
    if not long.isEmpty():
        matched = matched.unionByName(long.mapInArrow(_fold_long(window), _MATCHED))
    return matched.select("sid", *named)


def assembled_steps(rows: DataFrame) -> DataFrame:
    """The steps of every session: `sid`, `step_id`, `step_type`, `tool_name`, `content`, `status`.

    The first prompt is noted as a thought, a model turn gives its thinking, the calls and results of its artifact and what it says;
    artifacts that no turn took come last.
    """
    attrs = session_attributes(rows).select("sid", "user_input")
    firsts = rows.filter("type in ('context.compiled', 'prompt.submitted')").groupBy("sid").agg(F.min(F.struct("no", "row")).alias("f")).select("sid", "f.*")
    none = F.lit(None).cast("string")
    big = F.lit(1 << 40)
    note = attrs.join(firsts, "sid").filter("user_input <> ''").select(
        "sid", F.col("no").alias("at"), "row", F.lit(0).alias("sub"), F.lit("reasoning").alias("step_type"), none.alias("tool_name"),
        F.concat(F.lit(TASK_NOTE + " "), F.left("user_input", F.lit(500))).alias("content"), none.alias("status"),
    )
    turns = rows.filter("type = 'model.completed' and size(texts) > 0").select("sid", F.col("no").alias("at"), "row", F.try_element_at("texts", F.lit(-1)).alias("t"))
    said = turns.select(
        "sid", "at", "row",
        F.explode(F.array(F.struct(F.lit(0).alias("sub"), F.lit("reasoning").alias("step_type"), thinking(F.col("t")).alias("c")), F.struct(F.lit(1 << 30).alias("sub"), F.lit("output").alias("step_type"), spoken(F.col("t")).alias("c")))).alias("x"),
    ).filter("x.c <> ''").select("sid", "at", "row", "x.sub", "x.step_type", none.alias("tool_name"), F.left("x.c", F.lit(8000)).alias("content"), none.alias("status"))
    metas = rows.filter("type = 'trace.artifacts' and metas is not null").select("sid", F.col("row").alias("artifact_row"), F.from_json("metas", "array<string>").alias("m"))
    placed = match_artifacts(rows).join(metas, ["sid", "artifact_row"])
    each = placed.select("sid", F.coalesce("model_no", F.col("artifact_no") + big).alias("at"), F.coalesce("model_row", "artifact_row").alias("row"), F.posexplode("m").alias("k", "text"))
    get = lambda p: F.get_json_object("text", p)
    tool = truthy_coalesce(get("$.toolName"), get("$.tool"))
    shown = F.coalesce(truthy_coalesce(get("$.meta"), get("$.output"), get("$.result")), F.lit(""))
    flagged = F.coalesce(get("$.isError") == "true", F.lit(False)) | F.coalesce(~get("$.error").isin("", "false", "null"), F.lit(False))
    each = each.select("sid", "at", "row", "k", tool.alias("tool"), shown.alias("shown"), (flagged | is_error_result(shown)).alias("bad")).filter("tool is not null")
    calls = each.select("sid", "at", "row", (F.col("k") * 2 + 1).alias("sub"), F.lit("tool_call").alias("step_type"), F.col("tool").alias("tool_name"), none.alias("content"), none.alias("status"))
    results = each.select(
        "sid", "at", "row", (F.col("k") * 2 + 2).alias("sub"), F.lit("tool_result").alias("step_type"), F.col("tool").alias("tool_name"),
        F.left("shown", F.lit(5000)).alias("content"), F.when(F.col("bad"), "error").otherwise("success").alias("status"),
    )
    steps = note.unionByName(said).unionByName(calls).unionByName(results).withColumn("at", F.col("at").cast("bigint"))
    return with_position(steps, "sid", "at", "row", "sub", name="step_id").select("sid", "step_id", "step_type", "tool_name", "content", "status")


def session_outcomes(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """Per session its outcome by final status, else by errors of its tools and whether it has an output."""
    per = steps.groupBy("sid").agg(F.count("*").alias("steps"), F.count_if(F.col("step_type") == "tool_call").alias("tool_count"),
        F.array_sort(F.collect_set(F.when(F.col("step_type") == "tool_call", F.col("tool_name")))).alias("unique_tools"),
        F.count_if((F.col("step_type") == "tool_call") & F.lower("tool_name").contains("spawn")).alias("spawn_count"), F.coalesce(F.max(F.col("status") == "error"), F.lit(False)).alias("failed"))
    a = session_attributes(rows).join(per, "sid").filter("steps >= 2")
    outcome = (
        F.when(F.col("final_status") == "success", "success").when(F.col("final_status").isin("error", "failed"), "failure")
        .when(F.col("failed"), "likely_failure").when(F.coalesce("final_output", F.lit("")) != "", "likely_success").otherwise("unknown")
    )
    return a.select("sid", "agent", "model_version", "rounds", "steps", "tool_count", F.array_join("unique_tools", ",").alias("unique_tools"), "spawn_count", "parent_session_id", outcome.alias("outcome"))


def no_params(text: Column) -> Column:
    """Whether the JSON object `text` holds no parameter that says anything; true also for blank and damaged texts."""
    values = F.map_values(F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>"))
    says = F.exists(values, lambda v: ~F.coalesce(F.to_json(v), F.lit("null")).isin('""', "0", "0.0", "false", "null", "[]", "{}"))
    return ~F.coalesce(says, F.lit(False))


def backfilled(calls: DataFrame, uses: DataFrame) -> DataFrame:
    """`calls` (`sid`, `pos`, `tool`, `params`) with empty parameters taken from the use of the same tool and ordinal in `uses` (`sid`, `pos`, `tool`, `params`).

    Other columns of `uses` come along as `use_` and their name, `nth` is the ordinal.
    """
    numbered = lambda df: with_position(df.withColumn("_t", F.concat_ws("\u0001", "sid", "tool")), "_t", "pos", name="nth")
    more = [F.col(c).alias(f"use_{c}") for c in uses.columns if c not in ("sid", "pos", "tool", "params")]
    u = numbered(uses).select("_t", "nth", F.col("params").alias("_params"), *more)
    j = numbered(calls).join(u, ["_t", "nth"], "left")
    given = F.when(~no_params(F.col("_params")), F.col("_params"))
    return j.withColumn("params", F.when(no_params(F.col("params")), F.coalesce(given, filled(F.col("params")), F.lit("{}"))).otherwise(F.col("params"))).drop("_t", "_params")


def tool_uses(rows: DataFrame) -> DataFrame:
    """The uses of tools in the artifacts of `event_rows`: `sid` (the session's name), `pos`, `tool`, `params`, `output`, `bad`."""
    metas = rows.filter("type = 'trace.artifacts' and metas is not null").select(session_name(F.col("sid")).alias("sid"), "no", "row", F.posexplode(F.from_json("metas", "array<string>")).alias("k", "text"))
    get = lambda p: F.get_json_object("text", p)
    shown = F.coalesce(truthy_coalesce(get("$.meta"), get("$.output"), get("$.result")), F.lit(""))
    flagged = F.coalesce(get("$.isError") == "true", F.lit(False)) | F.coalesce(~get("$.error").isin("", "false", "null"), F.lit(False))
    each = metas.select(
        "sid", "no", "row", "k", truthy_coalesce(get("$.toolName"), get("$.tool")).alias("tool"), truthy_coalesce(get("$.input"), get("$.args"), get("$.arguments")).alias("params"),
        filled(shown).alias("output"), (flagged | is_error_result(shown)).alias("bad"),
    )
    return with_position(each.filter("sid is not null and tool is not null"), "sid", "no", "row", "k").drop("no", "row", "k")


def filled_calls(calls: DataFrame, results: DataFrame, uses: DataFrame) -> DataFrame:
    """Every call of `calls` (`sid`, `pos`, `tool`, `call`, `params`) with its result of `results` (`sid`, `pos`, `call`, `output`, `status`), filled from `uses`.

    Parameters are filled where they say nothing; a result's output where it is empty, and only then its status becomes error if the use failed.
    A call id answers the first result that bears it. `params_missing` and `output_missing` name what no use could fill.
    """
    first = results.filter("call is not null").groupBy("sid", "call").agg(F.min_by(F.struct("pos", "output", "status"), "pos").alias("r"))
    own = backfilled(calls, uses).withColumn("was_empty", no_params(F.col("own_params")))
    j = own.join(first, ["sid", "call"], "left")
    bare = F.col("r").isNotNull() & (F.coalesce(F.col("r.output"), F.lit("")) == "")
    return j.select(
        "sid", "pos", "tool", "call", "nth", "params", (F.col("was_empty") & ~no_params(F.col("params"))).alias("params_filled"), no_params(F.col("params")).alias("params_missing"),
        F.col("r.pos").alias("result_pos"), F.when(bare, F.col("use_output")).otherwise(F.col("r.output")).alias("output"),
        F.when(bare & F.coalesce("use_bad", F.lit(False)), "error").otherwise(F.col("r.status")).alias("status"),
        (bare & F.col("use_output").isNotNull()).alias("output_filled"), (F.col("r").isNull() | (bare & F.col("use_output").isNull())).alias("output_missing"),
    )


def subagent_spawns(rows: DataFrame) -> DataFrame:
    """`sid`, `no`, `k` (place in its artifact), `child_session_id` and `task` of every spawn of a subagent, the child as the spawn's result names it."""
    metas = rows.filter("type = 'trace.artifacts' and metas is not null").select("sid", "no", F.posexplode(F.from_json("metas", "array<string>")).alias("k", "text"))
    get = lambda p: F.get_json_object("text", p)
    meta = truthy_coalesce(get("$.meta"), get("$.output"))
    named = lambda k: F.try_variant_get(F.try_parse_json(meta), f"$.{k}", "string")
    given = truthy_coalesce(get("$.input"), get("$.args"))
    task = F.coalesce(truthy_coalesce(F.get_json_object(given, "$.task"), F.get_json_object(given, "$.prompt")), given, F.lit("{}"))
    spawns = metas.filter(F.lower(F.coalesce(truthy_coalesce(get("$.toolName"), get("$.tool")), F.lit(""))).contains("spawn"))
    return spawns.select("sid", "no", "k", truthy_coalesce(named("sessionId"), named("childSessionId"), named("id")).alias("child_session_id"), F.left(task, F.lit(300)).alias("task"))


def parent_links(trajectories: DataFrame) -> DataFrame:
    """`child`, `parent`, `known`: the parent that a session names and whether it is among the sessions (one hop)."""
    s = session_rows(trajectories)
    kids = s.select(F.col("sid").alias("child"), session_name(F.col("parent_session_id")).alias("parent")).filter("parent is not null")
    return kids.join(s.select(F.col("sid").alias("parent"), F.lit(True).alias("known")), "parent", "left").select("child", "parent", F.coalesce("known", F.lit(False)).alias("known"))
