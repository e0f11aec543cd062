"""The canonical layer: one row per step and per session, with what later operators ask of texts already decided.

Texts stay in the scan: classes, flags and lengths are computed row by row before the first shuffle, which then moves
narrow rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import steps as S
from tracewright.functions.errors import PIPELINE_ERRORS, TAXONOMY_ERRORS, announces_retry, error_class
from tracewright.functions.pieces import TASK_NOTE, piece_mark, piece_size
from tracewright.functions.text import fingerprint, holds_any, strip, truthy_coalesce
from tracewright.operators.ordered import changes, with_position
from tracewright.sources.tables import cut_lineage

BUSINESS = [
    "session_key", "source", "step_id", "step_type", "ts", "content", "tool_name", "skill_context", "input_params", "call_id", "status", "output",
    "error", "latency_ms",
]
#: Characters of a result that its piece shows.
PIECE = 2000
# Parameters that name the item a call is about.
ITEM_KEYS = ("block_id", "doc_token", "url", "path", "file_id", "message_id", "page_id")
# Fixed value: wordings of a plan.
PLANNING = r"(?i)(\d+[.、)）]|步骤|第[一二三四五六七八九十\d]+步|plan|step \d|first|then|next|finally)"


def session_name(c: Column) -> Column:
    """A session's name without regard to case and outer blanks; null where blank."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


def step_facts(steps: DataFrame) -> DataFrame:
    """One narrow row per step: `sid`, `pos` (1-based), `step_id`, `row`, `kind`, `st` (results only) and flags of its texts.

    Lower-case texts, then kinds and statuses, then classes are projections of their own, so that nothing is computed twice.
    """
    named = steps.withColumn("sid", session_name(F.col("session_id"))).filter("sid is not null and step_id is not null")
    content = F.col("content")
    lowered = named.select(
        "sid", F.col("step_id").cast("bigint").alias("step_id"), F.col("step_row").alias("row"), fingerprint(*[F.col(c) for c in BUSINESS]).alias("_mark"),
        S.step_type(F.col("step_type")).alias("kind"), "content", "tool_name", "skill_context", "input_params", "call_id", "status", "output", "error",
        F.lower("content").alias("lc"), F.lower(F.when(F.col("output") != "", F.col("output"))).alias("lo"),
    )
    result, call = F.col("kind") == "tool_result", F.col("kind") == "tool_call"
    shows = holds_any(F.col("lo"), S.ERROR_TEXTS)
    st = F.when(result, S.resolved_status(F.col("status"), F.col("output"), F.col("error"), shows))
    told_error = F.when(result, S.resolved_error(F.col("status"), F.col("output"), F.col("error"), shows)).otherwise(F.col("error"))
    # The text that tells of a recovery is the content, of a result without one its error and output.
    both = F.lower(F.concat(F.coalesce("error", F.lit("")), F.coalesce("output", F.lit(""))))
    told = F.when(F.coalesce(content, F.lit("")) != "", F.col("lc")).when(result, both)
    judged = lowered.withColumn("st", st).withColumn("told", told).withColumn("error", told_error).withColumn("params", F.when(call, F.from_json("input_params", "map<string,string>")))
    shown = truthy_coalesce(F.col("error"), F.col("output"))
    failed = F.col("st") == "error"
    param = lambda k: F.try_element_at("params", F.lit(k))
    facts = judged.select(
        "sid", "step_id", "row", "_mark", "kind", "st",
        F.nullif("tool_name", F.lit("")).alias("tool"), F.nullif("skill_context", F.lit("")).alias("skill"),
        F.length(F.coalesce(content, F.lit(""))).alias("chars"),
        holds_any(F.col("told"), S.RECOVERY_TEXTS).alias("recovers"),
        F.when(failed & shown.isNull(), "unknown").when(failed, error_class(shown, PIPELINE_ERRORS, "other_error")).alias("error_class"),
        F.when(failed, error_class(F.concat_ws(" ", "error", "output"), PIPELINE_ERRORS, "other_error")).alias("error_bucket"),
        F.when(failed, error_class(shown, TAXONOMY_ERRORS, "other")).alias("error_kind"),
        announces_retry(content, F.col("lc")).alias("announces"),
        F.coalesce(content.startswith(TASK_NOTE), F.lit(False)).alias("task_note"),
        holds_any(F.col("lc"), ["error", "失败", "exception"]).alias("speaks_error"),
        F.when(call, item_marks(F.col("params"))).alias("items"), F.when(call, F.coalesce(param("command"), F.lit(""))).alias("command"), F.when(call, F.coalesce(param("action"), F.lit(""))).alias("action"), params_key(F.col("params")).alias("params"),
        F.nullif("call_id", F.lit("")).alias("call"), piece_size(PIECE).alias("size"), piece_mark(PIECE).alias("mark"),
        (F.coalesce(content, F.lit("")) != "").alias("says"),
        F.coalesce(F.when(F.col("kind") == "reasoning", content.rlike(PLANNING)), F.lit(False)).alias("plans"),
    )
    cols = [c for c in facts.columns if c not in ("sid", "step_id", "_mark", "row")]
    once = facts.groupBy("sid", "step_id", "_mark").agg(F.min("row").alias("row"), *[F.first(c).alias(c) for c in cols]).drop("_mark")
    # Texts are read once; positions and all that follows read the narrow rows.
    return with_position(cut_lineage(once), "sid", "step_id", "row")


def item_marks(params: Column) -> Column:
    """What of ITEM_KEYS the parameters hold, in the order of the keys: key and value, or the key alone where its value is null; null where they hold none."""
    value = lambda k: F.try_element_at(params, F.lit(k))
    mark = lambda k: F.when(F.map_contains_key(params, F.lit(k)), F.coalesce(F.concat(F.lit(k + "\u0001"), value(k)), F.lit(k)))
    marks = F.array_compact(F.array(*[mark(k) for k in ITEM_KEYS]))
    return F.when(F.size(marks) > 0, marks)


def params_key(params: Column) -> Column:
    """Parameters in comparable form: sorted `key=value` texts, values cut at 200, call ids left out; null where there are none."""
    pairs = F.filter(F.map_entries(params), lambda e: ~e["key"].isin("call_id", "result_call_id"))
    texts = F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), F.left(F.coalesce(e["value"], F.lit("")), F.lit(200))))
    return F.when(F.size(params) > 0, F.array_join(F.array_sort(texts), "\u0001"))


def session_rows(trajectories: DataFrame) -> DataFrame:
    """One row per session name, the one ingested last (of equals that of the largest `traj_id`), with the normal `outcome`.

    A row delivered again replaces what was delivered before; `redeliveries` reports sessions whose rows differ.
    """
    named = trajectories.withColumn("sid", session_name(F.col("session_id"))).filter("sid is not null")
    cols = [c for c in trajectories.columns if c not in ("session_id", "traj_id")]
    last = named.groupBy("sid").agg(F.max_by(F.struct("traj_id", *cols), F.struct("ingested_at", "traj_id")).alias("t")).select("sid", "t.*")
    return last.withColumn("outcome", S.outcome(F.col("session_outcome")))


def redeliveries(trajectories: DataFrame) -> DataFrame:
    """`sid`, `rows`, `contents`: sessions of more than one row, and how many of their rows differ in more than number, spelling of the name and time of ingestion."""
    same = [F.col(c).cast("string") for c in trajectories.columns if c not in ("session_id", "traj_id", "ingested_at")]
    marked = trajectories.select(session_name(F.col("session_id")).alias("sid"), fingerprint(*same).alias("mark")).filter("sid is not null")
    per = marked.groupBy("sid", "mark").agg(F.count("*").alias("n")).groupBy("sid").agg(F.sum("n").alias("rows"), F.count("*").alias("contents"))
    return per.filter("rows > 1")


def session_stats(facts: DataFrame) -> DataFrame:
    """Per session: steps, calls, results, errors, thoughts, tools and skills (sorted), switches, recoveries and violations."""
    call, thought, error = F.col("kind") == "tool_call", F.col("kind") == "reasoning", F.col("st") == "error"
    owned = S.owned_by_skill(F.col("tool"), F.col("skill"))
    stats = facts.groupBy("sid").agg(
        F.count("*").alias("steps"),
        F.count_if(call).alias("tool_calls"),
        F.count_if(F.col("kind") == "tool_result").alias("tool_results"),
        F.count_if(error).alias("error_steps"),
        F.count_if(thought).alias("thoughts"),
        F.count_if(thought & F.col("recovers")).alias("recoveries"),
        F.coalesce(F.sum(F.when(thought, F.col("chars"))), F.lit(0)).alias("thought_chars"),
        F.array_sort(F.collect_set(F.when(call, F.col("tool")))).alias("tools"),
        F.array_sort(F.collect_set("skill")).alias("skills"),
        F.coalesce(F.max(call & F.col("tool").isNotNull() & F.col("skill").isNotNull() & ~owned), F.lit(False)).alias("violates"),
        F.max_by(F.struct("kind", "speaks_error"), "pos").alias("last"),
    )
    switched = changes(facts.filter(call), "sid", "pos", "skill", "switches")
    return stats.join(switched, "sid", "left").withColumn("switches", F.coalesce("switches", F.lit(0)))
