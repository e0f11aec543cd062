"""Worth of sessions: outcome, scores and the training use that follows from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.text import contains_any, quantise

# Weights of complexity, novelty, recovery, planning and compliance, and the novelty of sessions without a vector store.
WEIGHTS, NOVELTY = (0.20, 0.25, 0.25, 0.15, 0.15), 0.5
# What a following user message says of the work, and what an output admits.
UNHAPPY = ["不对", "重做", "错了", "不是", "再来", "wrong", "redo", "incorrect", "try again", "not right"]
HAPPY = ["谢谢", "好的", "完美", "正确", "不错", "done", "thanks", "perfect", "great", "looks good"]
ADMITS = r"无法完成|任务失败|i(?: am| 'm)? unable|could not complete"


def scored(sessions: DataFrame, stats: DataFrame, next_message: str | None = None, min_score: float = 0.5) -> DataFrame:
    """Every session with steps: `outcome` (inferred where unknown), the five scores, `total` and `use`.

    Supervised positives need `min_score`, recoveries a recovery value above six tenths of it.
    """
    s = sessions.join(stats, "sid")
    share = lambda c, n: F.least(F.lit(1.0), F.col(c) / F.lit(float(n)))
    size = lambda c, n: F.least(F.lit(1.0), F.size(c) / F.lit(float(n)))
    complexity = quantise(share("steps", 15) * 0.4 + size("tools", 5) * 0.3 + size("skills", 3) * 0.2 + share("switches", 3) * 0.1)
    recovery = F.when((F.col("error_steps") > 0) & (F.col("recoveries") > 0), 1.0).when(F.col("error_steps") > 0, 0.3).otherwise(0.0)
    planning = F.when(F.col("thoughts") > 0, F.least(F.lit(1.0), F.col("thought_chars") / F.col("thoughts") / 200.0)).otherwise(0.0)
    s = s.withColumn("complexity", complexity).withColumn("recovery_value", recovery).withColumn("planning", planning)
    s = s.withColumn("compliance", F.when(F.col("violates"), 0.0).otherwise(1.0))
    wc, wn, wr, wp, wk = WEIGHTS
    total = F.col("complexity") * wc + NOVELTY * wn + F.col("recovery_value") * wr + F.col("planning") * wp + F.col("compliance") * wk
    s = s.withColumn("total", quantise(total))
    unhandled = F.col("error_steps") > F.col("recoveries")
    clean = (F.col("last.kind") == "output") & ~F.col("last.speaks_error")
    said = F.col(next_message) if next_message else F.lit(None).cast("string")
    has_output = F.coalesce(F.col("final_output"), F.lit("")) != ""
    inferred = (
        F.when(contains_any(said, UNHAPPY), "failure")
        .when(contains_any(said, HAPPY), "success")
        .when(F.coalesce(F.lower("final_output").rlike(ADMITS), F.lit(False)), "failure")
        .when(clean & ~unhandled, "likely_success")
        .when(unhandled, "likely_failure")
        .when(has_output, "likely_success")
        .otherwise("unknown")
    )
    s = s.withColumn("outcome", F.when(F.col("outcome") == "unknown", inferred).otherwise(F.col("outcome")))
    good, bad = F.col("outcome").isin("success", "likely_success"), F.col("outcome").isin("failure", "likely_failure")
    use = (
        F.when(F.col("violates"), "skill_violation_neg")
        .when(F.col("outcome").isin("abandoned", "partial") & (F.col("tool_calls") >= 1) & (F.col("error_steps") == 0) & (F.col("steps") >= 3), "graceful_abort")
        .when((F.col("recovery_value") > min_score * 0.6) & (F.col("error_steps") > 0), "recovery_training")
        .when(good & (F.col("compliance") == 1.0) & (F.col("total") >= min_score), "sft_positive")
        .when((good | bad) & (F.col("total") >= 0.35), "dpo_candidate")
        .otherwise("low_value")
    )
    return s.withColumn("use", use)


def routed(sessions: DataFrame, min_steps: int = 2, max_steps: int | None = None, include_unknown: bool = False) -> DataFrame:
    """`scored` sessions of fitting length with `bucket` (null where none) and `review`.

    Low value goes to rejected; an unknown outcome is also put up for review and stays in a bucket only by `include_unknown` or where its use
    does not rest on the outcome.
    """
    fits = F.col("steps") >= min_steps
    fits = fits & (F.col("steps") <= max_steps) if max_steps else fits
    unknown = F.col("outcome") == "unknown"
    kept = ~unknown | F.lit(include_unknown) | F.col("use").isin("dpo_candidate", "recovery_training", "skill_violation_neg", "graceful_abort")
    bucket = F.when(F.col("use") == "low_value", "rejected").when(kept, F.col("use"))
    return sessions.filter(fits).withColumn("bucket", bucket).withColumn("review", unknown & (F.col("use") != "low_value"))


def counters(sessions: DataFrame, min_steps: int = 2) -> DataFrame:
    """`counter`, `n`, `share` (percent of all) over `scored` sessions: all, filtered by length, per use, put up for review and extracted."""
    own = routed(sessions, 0).withColumn("short", F.col("steps") < min_steps)
    kept = ~F.col("short")
    names = F.array_compact(
        F.array(
            F.lit("total"), F.when(F.col("short"), "filtered_min_steps"), F.when(kept, F.concat(F.lit("use."), F.col("use"))), F.when(kept & F.col("review"), "needs_review"),
            F.when(kept & F.col("bucket").isNotNull() & (F.col("bucket") != "rejected"), "extracted"),
        )
    )
    per = own.select(F.explode(names).alias("counter")).groupBy("counter").agg(F.count("*").alias("n"))
    total = per.filter("counter = 'total'").select(F.lit(1).alias("_one"), F.col("n").alias("_all"))
    return per.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").select("counter", "n", quantise(F.col("n") * 100 / F.col("_all"), 2).alias("share"))
