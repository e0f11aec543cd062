"""Training samples: what each data set keeps of a session besides its messages, and single decisions with what led to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.operators.ordered import look_around, with_position
from tracewright.operators.preferences import head_texts, with_texts
from tracewright.operators.specialist import abort_reason
from tracewright.sources.tables import cut_lineage, lookup

#: Data sets whose samples hold messages, and the shortest conversation that is exported.
WITH_MESSAGES, LEAST_MESSAGES = ("sft_positive", "recovery_training", "graceful_abort"), 3


def _ids(kept: Column) -> Column:
    return F.array_sort(F.collect_list(F.when(kept, F.col("step_id"))))


def last_said(facts: DataFrame, steps: DataFrame, sids: DataFrame) -> DataFrame:
    """`sid`, `said`: the content of the last output step of each session, null where that says nothing."""
    last = facts.filter("kind = 'output'").join(sids, "sid", "left_semi").groupBy("sid").agg(F.max_by("row", "pos").alias("row"))
    texts = steps.select(F.col("step_row").alias("row"), F.col("content").alias("said")).join(lookup(last), "row")
    return texts.select("sid", "said").dropDuplicates(["sid"])


def training_samples(routed: DataFrame, facts: DataFrame, steps: DataFrame) -> DataFrame:
    """One row per routed session with a use: shape, scores and what its data set adds.

    Recoveries name the steps that failed and those that recovered, violations all calls, aborts what was said last and why. Step numbers are
    arrays, null where the data set has none.
    """
    kept = routed.filter("bucket is not null and bucket <> 'rejected'")
    use = lambda u: F.col("use") == u
    thought = F.col("kind").isin("reasoning", "output") & F.col("recovers")
    per = facts.join(kept.select("sid"), "sid", "left_semi").groupBy("sid").agg(
        F.coalesce(F.max(thought), F.lit(False)).alias("any_recovery"), _ids(F.col("st") == "error").alias("errors"), _ids(thought).alias("recoveries_at"), _ids(F.col("kind") == "tool_call").alias("calls")
    )
    said = last_said(facts, steps, kept.filter(use("graceful_abort")).select("sid"))
    j = kept.join(per, "sid").join(said.withColumn("has_output", F.lit(True)), "sid", "left")
    text = F.coalesce(F.when(F.col("has_output"), F.col("said")).otherwise(F.col("final_output")), F.lit(""))
    when = lambda u, c: F.when(use(u), c)
    return j.select(
        "sid", F.col("use").alias("training_use"), "outcome", "agent", "model_version", "total", "steps", "tool_calls", "switches", F.col("error_steps").alias("errors"), "any_recovery",
        when("recovery_training", F.col("errors")).alias("error_steps"), when("recovery_training", F.col("recoveries_at")).alias("recovery_steps"),
        when("recovery_training", F.size("recoveries_at") > 0).alias("has_recovery"), when("skill_violation_neg", F.col("calls")).alias("violation_steps"),
        when("graceful_abort", F.left(text, F.lit(500))).alias("abort_signal"), when("graceful_abort", abort_reason(text)).alias("abort_reason"),
    )


def with_messages(sessions: DataFrame, conversations: DataFrame) -> DataFrame:
    """`sessions` with their `messages` in order."""
    own = conversations.groupBy("sid").agg(F.transform(F.array_sort(F.collect_list(F.struct("msg_no", "role", "content"))), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))
    return sessions.join(own, "sid")


def tool_call_samples(chosen: DataFrame, facts: DataFrame, steps: DataFrame) -> DataFrame:
    """`specialist.tool_call_pairs` with texts: `context` (all pieces before the call), `chosen` (the call and its result) and the call's parameters.

    A session's pieces up to its last chosen call are gathered once, and each sample is a slice of them.
    """
    ends = chosen.withColumn("pos", F.col("context_steps") + 1)
    near = look_around(ends.select("sid", "pos"), facts, "sid", "pos", 1, 2, ["kind"])
    after = F.get(F.filter("near", lambda x: x["kind"] == "tool_result"), F.lit(0))["at"]
    ends = ends.join(near.select("sid", "pos", (F.col("pos") + after).alias("result_pos")), ["sid", "pos"])
    upto = ends.groupBy("sid").agg(F.max("result_pos").alias("upto"))
    needed = facts.filter("size is not null").select("sid", "pos", "row").join(upto, "sid").filter("pos <= upto").select("sid", "pos", "row")
    pieces = with_texts(needed, steps).groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("p"))
    text = lambda keep: F.array_join(F.transform(F.filter("p", keep), lambda x: x["piece"]), "\n")
    params = steps.select(F.col("step_row").alias("row"), "input_params").join(lookup(ends.select("sid", "pos").join(facts.select("sid", "pos", "row"), ["sid", "pos"])), "row").select("sid", "pos", "input_params").dropDuplicates(["sid", "pos"])
    j = ends.join(pieces, "sid").join(params, ["sid", "pos"], "left")
    return j.select(
        "sid", "call_index", "tool_name", "result_status", "context_steps", F.coalesce(F.nullif("input_params", F.lit("")), F.lit("{}")).alias("input_params"),
        text(lambda x: x["pos"] < F.col("pos")).alias("context"), text(lambda x: (x["pos"] == F.col("pos")) | (x["pos"] == F.col("result_pos"))).alias("chosen"),
    )


def retry_preferences(sequences: DataFrame, facts: DataFrame, steps: DataFrame, last: int = 10) -> DataFrame:
    """`specialist.retry_sequences` as preferences: `chosen` and `rejected`, the first steps of the later and of the earlier attempt."""
    sids = sequences.select(F.col("failed_session").alias("sid")).unionByName(sequences.select(F.col("success_session").alias("sid"))).distinct()
    text = cut_lineage(head_texts(facts, steps, sids, last))
    return (
        sequences.join(text.toDF("success_session", "chosen"), "success_session", "left").join(text.toDF("failed_session", "rejected"), "failed_session", "left")
        .select("failed_session", "success_session", "time_gap_sec", "input_similarity", F.coalesce("chosen", F.lit("")).alias("chosen"), F.coalesce("rejected", F.lit("")).alias("rejected"))
    )


def switch_points(facts: DataFrame, used: DataFrame) -> DataFrame:
    """`sid`, `pos`, `from_skill` (null at the first), `to_skill`: where the skill changes within the first `used` steps of each session of `used`, steps without one passed over."""
    own = with_position(facts.filter("skill is not null").join(used, "sid").filter("pos <= used").select("sid", "pos", "skill"), "sid", "pos", name="nth")
    before = own.select("sid", (F.col("nth") + 1).alias("nth"), F.col("skill").alias("from_skill"))
    j = own.join(before, ["sid", "nth"], "left").filter(F.col("from_skill").isNull() | (F.col("from_skill") != F.col("skill")))
    return j.select("sid", "pos", "from_skill", F.col("skill").alias("to_skill"))
