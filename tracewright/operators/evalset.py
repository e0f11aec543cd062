"""Evaluation sets: strata, criteria, difficulty, reproducible samples and the queue for labelling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewright.operators.pairing import domain


def primary_domain(sessions: DataFrame) -> DataFrame:
    """`sid`, `domain`: the most frequent domain of a session's tools, the first by name of equals, other without tools."""
    per = sessions.select("sid", F.explode("tools").alias("t")).groupBy("sid", domain(F.col("t")).alias("domain")).agg(F.count("*").alias("n"))
    top = per.groupBy("sid").agg(F.min_by("domain", F.struct((-F.col("n")).alias("n"), "domain")).alias("domain"))
    return sessions.select("sid").join(top, "sid", "left").select("sid", F.coalesce("domain", F.lit("other")).alias("domain"))


def strata(sessions: DataFrame) -> DataFrame:
    """One row per session and stratum it belongs to."""
    calls, agents = F.col("tool_calls"), F.arrays_overlap("tools", F.array(F.lit("sessions_spawn"), F.lit("sessions_yield")))
    names = F.array(
        F.when(calls.between(1, 3), "tool_light").when(calls.between(4, 10), "tool_medium").when(calls > 10, "tool_heavy"),
        F.when(F.col("steps") >= 20, "long_plan"),
        F.when(F.col("recoveries") > 0, "error_recovery"),
        F.when(F.col("use") == "graceful_abort", "graceful_abort"),
        F.when(agents, "multi_agent"),
        F.concat(F.lit("domain_"), F.col("domain")),
    )
    with_domain = sessions.join(primary_domain(sessions), "sid")
    return with_domain.select("sid", "use", "outcome", F.explode(F.array_compact(names)).alias("stratum"))


def stratified(rows: DataFrame, per_stratum: int = 10, seed: int = 42) -> DataFrame:
    """At most `per_stratum` rows of each stratum by a hash of `seed` and the session, the same in every run and engine."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("sid")))
    return rows.withColumn("rank", F.row_number().over(W.partitionBy("stratum").orderBy(draw, "sid"))).filter(F.col("rank") <= per_stratum)


def difficulty(sessions: DataFrame) -> DataFrame:
    score = F.col("steps") * 0.4 + F.col("tool_calls") * 0.6
    return sessions.withColumn("difficulty", F.when(score >= 20, "hard").when(score >= 8, "medium").otherwise("easy"))


def criteria(sessions: DataFrame) -> DataFrame:
    """Per session what an answer is judged by: expected outcome, dimensions, difficulty and the judge's prompt."""
    agents = F.arrays_overlap("tools", F.array(F.lit("sessions_spawn"), F.lit("sessions_yield")))
    abort = F.col("use") == "graceful_abort"
    expected = (
        F.when(F.col("outcome").isin("success", "likely_success"), "task_completed").when(F.col("outcome").isin("failure", "likely_failure"), "task_failed")
        .when(abort, "graceful_abort_with_reason").otherwise("unknown")
    )
    dims = F.array_compact(
        F.array(
            F.lit("task_completion"), F.when(F.col("tool_calls") > 0, "tool_call_accuracy"), F.when(F.col("recoveries") > 0, "error_recovery_quality"),
            F.when(F.col("steps") >= 20, "planning_coherence"), F.when(agents, "subagent_delegation_quality"),
            F.when(abort, "boundary_recognition"), F.when(abort, "user_communication_quality"),
        )
    )
    head = lambda c: F.left(F.coalesce(F.col(c), F.lit("")), F.lit(200))
    joined = F.array_join(dims, "、")
    # Fixed value: the wording of the judge's prompt.
    prompt = F.concat(
        F.lit("任务描述："), head("user_input"), F.lit("\n预期结果："), expected, F.lit("\n实际输出："), head("final_output"),
        F.lit("\n请从以下维度评估（1-5分）："), joined, F.lit("\n输出格式：JSON，每个维度一个字段，外加 overall_score 和 reasoning。"),
    )
    return difficulty(sessions).select("sid", expected.alias("expected_outcome"), joined.alias("dimensions"), "difficulty", prompt.alias("judge_prompt"))


def label_queue(sessions: DataFrame, most: int = 200, seed: int = 42) -> DataFrame:
    """The sessions to label first: unknown outcomes, then hard ones by a hash, at most `most` (a top-k report)."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("sid")))
    ranked = difficulty(sessions).withColumn("priority", F.when(F.col("outcome") == "unknown", 0).when(F.col("difficulty") == "hard", 1))
    queue = ranked.filter("priority is not null").withColumn("draw", draw).orderBy("priority", "draw", "sid").limit(most)
    return queue.select("sid", "priority", "outcome", "difficulty")
