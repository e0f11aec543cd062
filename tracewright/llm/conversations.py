"""Conversations rebuilt from message rows: order, roles, and the defects that leave a conversation out.

A conversation is named by its session. Rows that name none are grouped by channel and cut where the silence between two rows
exceeds a gap calibrated on all rows (`assembled`), and take part like any other conversation; `agreement` measures how often the cut finds
the sessions that are written. Every figure that a defect rests on is decomposable, so rows are first reduced per (conversation, number)
and then per (conversation, run of numbers), and a conversation of any length is never gathered into one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewright.functions.steps import step_type
from tracewright.functions.text import filled, fingerprint, is_blank, strip
from tracewright.operators.facts import session_name
from tracewright.operators.ordered import with_position
from tracewright.sources import cut_lineage

#: Numbers per run: the most turns that one array holds.
RUN = 1024


def well_formed(c: Column) -> Column:
    """True where `c` is one JSON value and nothing else; false for a blank text; null for null.

    Repeated keys within one object count as damage.
    """
    boxed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    alone = F.try_variant_get(boxed, "$[1]", "variant").isNull() & F.try_variant_get(boxed, "$[0]", "variant").isNotNull()
    return F.when(c.isNotNull(), F.coalesce(alone, F.lit(False)))


def without_thinking(c: Column) -> Column:
    """`c` without its closed thinking blocks."""
    return F.regexp_replace(c, r"(?s)<thinking>.*?</thinking>", "")


def event_turns(events: DataFrame, *keep: Column) -> DataFrame:
    """Raw events as rows (`conv`, `no`, `mark`, `bad`, `role`, `text`, and `keep`), the role inferred from type and payload.

    `conv` is `session_id`, or `trace_id` where that is blank, or null where both are; `no` is `seq`, or
    `source_seq`; `role` is user, assistant, system, tool or null for rows that hold no turn.
    """
    data = F.col("data")
    parsed = F.try_parse_json(data)
    kind = F.col("event_type")
    ok = well_formed(data)
    prompt = F.when(ok & kind.isin("prompt.submitted", "context.compiled"), F.try_variant_get(parsed, "$.prompt", "string"))
    texts = F.when(ok & (kind == "model.completed"), F.try_variant_get(parsed, "$.assistantTexts", "array<string>"))
    answer = F.try_element_at(texts, F.lit(-1))
    metas = F.when(ok & (kind == "trace.artifacts"), F.try_variant_get(parsed, "$.toolMetas", "variant"))
    role = (
        F.when((kind == "prompt.submitted") & ~is_blank(prompt), "user")
        .when((kind == "model.completed") & ~is_blank(without_thinking(answer)), "assistant")
        .when((kind == "context.compiled") & ~is_blank(prompt), "system")
        .when(metas.isNotNull(), "tool")
    )
    return events.select(
        coalesced_name().alias("conv"),
        F.coalesce("seq", "source_seq").alias("no"),
        fingerprint(kind, data).alias("mark"),
        F.coalesce(~ok, F.lit(False)).alias("bad"),
        role.alias("role"),
        F.coalesce(prompt, answer, metas.cast("string")).alias("text"),
        *keep,
    )


#: What the name of a conversation begins with that silence, and no written session, sets apart.
SILENCE = "silence:"


def _timed(events: DataFrame) -> list[Column]:
    us = F.unix_micros(F.expr("try_to_timestamp(ts)"))
    same = [F.col(c).cast("string") for c in events.columns if c not in ("event_row", "ingested_at")]
    return [F.col("event_row").alias("row"), F.col("session_key").alias("channel"), us.alias("us"), fingerprint(*same).alias("copy")]


def assembled(events: DataFrame, gap_us: int | None = None) -> DataFrame:
    """The rows of `event_turns`, those without a written name put into sessions of their channel by silence and numbered by their time there.

    The gap is calibrated on the rows of all sessions. A row without name, and without channel or time, stays without a conversation; of
    repeated rows without a name the first counts. Tables without `ts` or `session_key` have no such sessions.
    """
    if not {"ts", "session_key"} <= set(events.columns):
        return event_turns(events)
    named = coalesced_name()
    loose = events.filter(named.isNull() & filled(F.col("session_key")).isNotNull() & F.expr("try_to_timestamp(ts)").isNotNull())
    if loose.isEmpty():
        return event_turns(events)
    if gap_us is None:
        us = F.unix_micros(F.expr("try_to_timestamp(ts)"))
        gap_us = calibrated_gap(events.select(F.col("event_row").alias("row"), F.col("session_key").alias("channel"), us.alias("us")).filter("channel is not null and us is not null"))
    turns = cut_lineage(event_turns(loose, *_timed(loose)))
    once = turns.groupBy("channel", "copy").agg(F.min("row").alias("row"), F.first("us").alias("us"))
    placed = with_position(
        sessionize(once, gap_us).withColumn("conv", F.concat(F.lit(SILENCE), "channel", F.lit(":"), F.col("session_no").cast("string"))), "conv", "us", "row", name="no"
    ).select("row", "conv", "no")
    cut = turns.drop("conv", "no", "channel", "us", "copy").join(placed, "row").select("conv", "no", "mark", "bad", "role", "text")
    return event_turns(events.filter(named.isNotNull())).unionByName(cut)


def coalesced_name() -> Column:
    """The written name of an event's conversation: the session, or the trace where that is blank; null where both are."""
    return F.coalesce(filled(F.col("session_id")), filled(F.col("trace_id")))


def agreement(events: DataFrame, gap_us: int | None = None) -> DataFrame:
    """`gap_us`, `written` and `by_silence` sessions of all rows with a name, a channel and a time, and `equal`, those that hold the same rows in both."""
    rows = events.select(coalesced_name().alias("conv"), *_timed(events)).filter("conv is not null")
    rows = cut_lineage(rows.groupBy("channel", "copy").agg(F.min("row").alias("row"), F.first("us").alias("us"), F.first("conv").alias("conv")))
    gap_us = calibrated_gap(rows.filter("channel is not null and us is not null")) if gap_us is None else gap_us
    placed = sessionize(rows, gap_us).join(rows.select("row", "conv"), "row").groupBy("conv", "channel", "session_no").agg(F.lit(1).alias("one"))
    per_silence = placed.groupBy("channel", "session_no").agg(F.count("*").alias("convs"), F.min("conv").alias("conv"))
    per_conv = placed.groupBy("conv").agg(F.count("*").alias("parts"))
    alone = per_silence.filter("convs = 1").join(per_conv.filter("parts = 1"), "conv").agg(F.count("*").alias("equal"))
    none = F.lit(None).cast("bigint")
    parts = per_conv.agg(F.count("*").alias("written")).select("written", none.alias("by_silence"), none.alias("equal"))
    parts = parts.unionByName(per_silence.agg(F.count("*").alias("by_silence")).select(none.alias("written"), "by_silence", none.alias("equal")))
    parts = parts.unionByName(alone.select(none.alias("written"), none.alias("by_silence"), "equal"))
    return parts.agg(F.max("written").alias("written"), F.max("by_silence").alias("by_silence"), F.max("equal").alias("equal")).select(
        F.lit(gap_us).cast("bigint").alias("gap_us"), "written", "by_silence", "equal"
    )


def _by_number(turns: DataFrame) -> DataFrame:
    """One row per (conversation, number): whether its rows disagree, any damage, and the one role."""
    return turns.groupBy("conv", "no").agg(
        (F.min("mark") != F.max("mark")).alias("clash"),
        F.max("bad").alias("bad"),
        F.max(F.when(F.col("role").isin("user", "assistant"), F.col("role"))).alias("role"),
    )


def event_defects(turns: DataFrame) -> DataFrame:
    """`conv` and `defect` of every conversation of `event_turns` rows that must be left out.

    broken, empty, broken, missing_reply in the order of the rules: contradictory or damaged rows; no turn; a gap in the
    numbers or a first turn that is not the user's; a user turn that no assistant turn follows. Rows without a
    conversation or number belong to none. Repeated rows count once. An empty table gives an empty result.
    """
    numbers = _by_number(turns.filter("conv is not null and no is not null"))
    runs = numbers.groupBy("conv", F.expr(f"no div {RUN}").alias("run")).agg(
        F.max("clash").alias("clash"),
        F.max("bad").alias("bad"),
        F.count("*").alias("n"),
        F.min("no").alias("lo"),
        F.max("no").alias("hi"),
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("role").isNotNull(), F.struct("no", "role")))), lambda x: x["role"]
        ).alias("roles"),
    )
    roles = F.col("roles")
    runs = runs.select(
        "conv", "run", "clash", "bad", "n", "lo", "hi",
        F.get(roles, F.lit(0)).alias("first_role"),
        F.try_element_at(roles, F.lit(-1)).alias("last_role"),
        F.exists(
            F.zip_with(roles, F.slice(roles, 2, RUN), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: (p["a"] == "user") & (p["b"] == "user")
        ).alias("unanswered"),
    )
    # Runs are a thousandth of the rows; between them only the roles at their ends matter.
    spoken = F.struct("run", "first_role", "last_role")
    whole = runs.groupBy("conv").agg(
        F.max("clash").alias("clash"),
        F.max("bad").alias("bad"),
        F.sum("n").alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.max("unanswered").alias("unanswered"),
        F.array_sort(F.collect_list(F.when(F.col("first_role").isNotNull(), spoken))).alias("ends"),
    )
    ends = F.col("ends")
    across = F.exists(
        F.zip_with(ends, F.slice(ends, 2, 2**30), lambda a, b: (a["last_role"] == "user") & (b["first_role"] == "user")), lambda x: F.coalesce(x, F.lit(False))
    )
    silent = F.size(ends) == 0
    defect = (
        F.when(F.col("clash") | F.col("bad"), "broken")
        .when(silent, "empty")
        .when((F.col("hi") - F.col("lo") + 1 != F.col("n")) | (F.get(ends, F.lit(0))["first_role"] != "user"), "broken")
        .when(F.col("unanswered") | across | (F.try_element_at(ends, F.lit(-1))["last_role"] == "user"), "missing_reply")
    )
    return whole.select("conv", defect.alias("defect")).filter("defect is not null")


def step_defects(steps: DataFrame) -> DataFrame:
    """`conv` and `defect` of every session of step rows that must be left out, by the same order of rules.

    A call id that is blank belongs to no pair. Rows with a null session or step number are ignored; repeated rows count once.
    """
    kind = step_type(F.col("step_type"))
    worded = ~(is_blank(F.col("content")) & is_blank(F.col("tool_name")) & is_blank(F.col("output")) & is_blank(F.col("error")))
    rows = steps.filter("session_id is not null and step_id is not null").select(
        F.col("session_id").alias("conv"),
        F.col("step_id").cast("bigint").alias("no"),
        fingerprint(F.col("step_type"), F.col("content"), F.col("call_id"), F.col("output")).alias("mark"),
        worded.alias("worded"),
        (kind == "tool_result").alias("result"),
        ((kind == "output") & ~is_blank(F.col("content"))).alias("answer"),
        F.when(kind.isin("tool_call", "tool_result"), filled(F.col("call_id"))).alias("call"),
        (kind == "tool_call").alias("is_call"),
    )
    # Either reduction is keyed finer than the session; both are unioned so that one shuffle by session follows.
    none = F.lit(None)
    numbers = rows.groupBy("conv", "no").agg(
        (F.min("mark") != F.max("mark")).alias("clash"), F.max("worded").alias("worded"), F.max("result").alias("result"), F.max("answer").alias("answer")
    ).select("conv", "no", "clash", "worded", "result", "answer", none.cast("boolean").alias("unpaired"))
    calls = rows.filter("call is not null").groupBy("conv", "call").agg(
        (F.max("is_call") != F.max(~F.col("is_call"))).alias("unpaired")
    ).select("conv", none.cast("bigint").alias("no"), *[none.cast("boolean").alias(c) for c in ("clash", "worded", "result", "answer")], "unpaired")
    whole = numbers.unionByName(calls.filter("unpaired")).groupBy("conv").agg(
        F.coalesce(F.max("clash"), F.lit(False)).alias("clash"),
        F.coalesce(F.max("worded"), F.lit(False)).alias("worded"),
        F.count("no").alias("n"),
        F.min("no").alias("lo"),
        F.max("no").alias("hi"),
        F.coalesce(F.max("unpaired"), F.lit(False)).alias("unpaired"),
        F.max(F.when(F.col("result"), F.col("no"))).alias("last_result"),
        F.max(F.when(F.col("answer"), F.col("no"))).alias("last_answer"),
    )
    answered = F.col("last_answer").isNotNull() & (F.col("last_result").isNull() | (F.col("last_answer") > F.col("last_result")))
    defect = (
        F.when(F.col("clash"), "broken")
        .when(~F.col("worded"), "empty")
        .when((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | F.col("unpaired"), "broken")
        .when(~answered, "missing_reply")
    )
    return whole.select("conv", defect.alias("defect")).filter("defect is not null")


def left_out(events: DataFrame, steps: DataFrame) -> DataFrame:
    """`stored_in`, `session_id`, `defect` of the conversations left out of either table; sessions that only silence sets apart begin with SILENCE."""
    a = event_defects(assembled(events)).select(F.lit("raw_events").alias("stored_in"), F.col("conv").alias("session_id"), "defect")
    b = step_defects(steps).select(F.lit("steps").alias("stored_in"), F.col("conv").alias("session_id"), "defect")
    return a.unionByName(b)


def step_turns(steps: DataFrame, trajectories: DataFrame) -> DataFrame:
    """Step rows as rows (`conv`, `no`, `role`, `text`), the role inferred from the normal step type, and the request before them as number 0.

    Thoughts, calls and outputs are the assistant's, results the tool's, routes the system's; steps of unknown type, and thoughts, outputs and routes
    without words, hold no turn. The user's turn is the first request that is not blank among the rows of `trajectories` of that session name.
    """
    kind, content = step_type(F.col("step_type")), filled(F.col("content"))
    role = (
        F.when(kind == "tool_result", "tool")
        .when((kind == "skill_route") & F.coalesce(content, filled(F.col("skill_context"))).isNotNull(), "system")
        .when((kind == "tool_call") | (kind.isin("reasoning", "output") & content.isNotNull()), "assistant")
    )
    text = (
        F.when(kind == "tool_call", F.concat_ws(" ", content, filled(F.col("tool_name")), filled(F.col("input_params"))))
        .when(kind == "tool_result", F.coalesce(filled(F.col("output")), filled(F.col("error")), content, F.lit("")))
        .when(kind == "skill_route", F.coalesce(content, filled(F.col("skill_context"))))
        .otherwise(content)
    )
    own = steps.filter("session_id is not null and step_id is not null")
    turns = own.select(F.col("session_id").alias("conv"), F.col("step_id").cast("bigint").alias("no"), role.alias("role"), text.alias("text"))
    asked = trajectories.select(session_name(F.col("session_id")).alias("sid"), "traj_id", filled(F.col("user_input")).alias("text")).filter("text is not null")
    asked = asked.groupBy("sid").agg(F.min_by("text", "traj_id").alias("text"))
    names = own.select(F.col("session_id").alias("conv")).distinct().withColumn("sid", session_name(F.col("conv")))
    requests = names.join(asked, "sid").select("conv", F.lit(0).cast("bigint").alias("no"), F.lit("user").alias("role"), "text")
    return turns.filter("role is not null").unionByName(requests)


def rebuilt(events: DataFrame, steps: DataFrame | None = None, trajectories: DataFrame | None = None) -> DataFrame:
    """The turns of every sound conversation: `stored_in`, `session_id`, `turn_no` (from 1), `role`, `text`.

    Turns are system, user, assistant and tool; a turn's number counts the turns before it, first per run of numbers,
    then over the runs, so no conversation is sorted as a whole. With `steps` and `trajectories` the conversations of steps come as well;
    a session stored in both tables is a conversation in each.
    """
    turns = assembled(events).filter("conv is not null and no is not null")
    spoken = _sound(turns.filter("role is not null"), event_defects(turns), "raw_events")
    if steps is not None:
        spoken = spoken.unionByName(_sound(step_turns(steps, trajectories), step_defects(steps), "steps"))
    key = ["stored_in", "conv"]
    spoken = spoken.withColumn("run", F.expr(f"no div {RUN}"))
    counts = spoken.groupBy(*key, "run").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy(*key).orderBy("run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inside = F.row_number().over(W.partitionBy(*key, "run").orderBy("no"))
    numbered = spoken.withColumn("inside", inside).join(before.drop("n"), [*key, "run"])
    return numbered.select("stored_in", F.col("conv").alias("session_id"), (F.col("inside") + F.col("before")).alias("turn_no"), "role", strip(F.col("text")).alias("text"))


def _sound(turns: DataFrame, bad: DataFrame, stored_in: str) -> DataFrame:
    """One row per (conversation, number) of `turns`, without the conversations of `bad`."""
    once = turns.groupBy("conv", "no").agg(F.min("role").alias("role"), F.min("text").alias("text"))
    return once.join(bad, "conv", "left_anti").select(F.lit(stored_in).alias("stored_in"), "conv", "no", "role", "text")


def calibrated_gap(rows: DataFrame, bins: int = 64) -> int:
    """The silence in microseconds that best parts gaps within a session from gaps between sessions.

    `rows` has `channel` and `us`. The gaps of all rows are counted in bins of their logarithm (at most `bins` rows come to
    the driver), and the cut is the one of largest variance between the two sides. Two hours where there are no gaps.
    """
    gaps = _with_gaps(rows).filter("gap > 0").select(F.least(F.lit(bins - 1), F.floor(F.log2("gap")).cast("int")).alias("b"))
    counts = {r["b"]: r["n"] for r in gaps.groupBy("b").agg(F.count("*").alias("n")).collect()}
    total, mass = sum(counts.values()), sum(b * n for b, n in counts.items())
    best, at, n, m = -1.0, None, 0, 0
    for b in range(bins - 1):
        n, m = n + counts.get(b, 0), m + b * counts.get(b, 0)
        if 0 < n < total:
            score = n * (total - n) * (m / n - (mass - m) / (total - n)) ** 2
            if score > best + 1e-9:
                best, at = score, b
    return 2 * 3_600_000_000 if at is None else int(math.pow(2, at + 1))


_DAY = 86_400_000_000


def _with_gaps(rows: DataFrame) -> DataFrame:
    """`rows` with the microseconds since the row before of the channel, looked up per day and then across days."""
    keyed = rows.withColumn("day", F.expr(f"us div {_DAY}"))
    days = keyed.groupBy("channel", "day").agg(F.max("us").alias("day_end"))
    prior = F.lag("day_end").over(W.partitionBy("channel").orderBy("day"))
    days = days.select("channel", "day", prior.alias("prior"))
    before = F.lag("us").over(W.partitionBy("channel", "day").orderBy("us", "row"))
    return keyed.withColumn("before", before).join(days, ["channel", "day"]).withColumn("gap", F.col("us") - F.coalesce("before", "prior"))


def sessionize(rows: DataFrame, gap_us: int | None = None) -> DataFrame:
    """`row`, `channel`, `us` and `session_no` (from 1 per channel): a session ends where the silence exceeds `gap_us`.

    Without `gap_us` the gap is calibrated on the rows. Running numbers are summed per day and then over days, so a channel
    with any share of the rows is spread over its days. Rows without channel or time are left out; rows with equal times keep
    the order of `row`.
    """
    rows = rows.filter("channel is not null and us is not null").select("row", "channel", "us")
    gap_us = calibrated_gap(rows) if gap_us is None else gap_us
    cut = _with_gaps(rows).withColumn("opens", (F.col("gap").isNull() | (F.col("gap") > gap_us)).cast("int"))
    days = cut.groupBy("channel", "day").agg(F.sum("opens").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("channel").orderBy("day").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    days = days.select("channel", "day", before.alias("earlier"))
    inside = F.sum("opens").over(W.partitionBy("channel", "day").orderBy("us", "row").rowsBetween(W.unboundedPreceding, 0))
    return cut.withColumn("inside", inside).join(days, ["channel", "day"]).select("row", "channel", "us", (F.col("inside") + F.col("earlier")).alias("session_no"))


def by_silence(events: DataFrame, gap_us: int | None = None) -> DataFrame:
    """The turns of the sessions that silence parts: `row`, `channel`, `us`, `session_no`, `role`, `text`.

    All rows take part, those without a session's name too, and a row delivered twice counts once. Sessions without a user turn that an assistant turn
    follows are left out. Sessions are cut on narrow rows; texts join them by row number.
    """
    turns = event_turns(events, *_timed(events))
    narrow = turns.groupBy("channel", "copy").agg(F.min("row").alias("row"), F.first("us").alias("us"), F.first("role").alias("role"))
    narrow = cut_lineage(narrow.select("row", "channel", "us", "role"))
    placed = sessionize(narrow.drop("role"), gap_us).join(narrow.filter("role is not null").select("row", "role"), "row")
    at = F.struct("us", "row")
    asked, replied = F.min(F.when(F.col("role") == "user", at)), F.max(F.when(F.col("role") == "assistant", at))
    sound = placed.groupBy("channel", "session_no").agg(asked.alias("asked"), replied.alias("replied")).filter("asked < replied").select("channel", "session_no")
    kept = placed.join(sound, ["channel", "session_no"], "left_semi")
    texts = turns.filter("role is not null").select("row", strip(F.col("text")).alias("text"))
    return kept.join(texts, "row").select("row", "channel", "us", "session_no", "role", "text")
