"""Errors by class: how often they occur and recover, with which tools, and what to train against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewright.functions.text import quantise
from tracewright.operators.ordered import look_around
from tracewright.operators.preferences import with_texts

# Advice per class of error, and the remark on classes that recover already.
ADVICE = {
    "rate_limit": "注入429错误，训练 sleep+retry 策略；目标恢复率 >80%",
    "timeout": "注入连接超时，训练检查服务状态后决策是否重试",
    "auth_error": "注入401/403，训练识别权限问题后主动中止（不重试）",
    "not_found": "注入404，训练区分资源不存在和路径错误两种场景",
    "server_error": "注入5xx，训练指数退避重试策略",
    "parse_error": "注入格式错误，训练fallback解析和格式纠正",
    "network_error": "注入网络中断，训练等待后重试 vs 主动上报的决策",
    "data_error": "注入类型错误，训练参数校验和类型转换",
    "tool_missing": "训练识别工具不可用后的替代路径",
    "other": "人工分析样本后定制训练策略",
}
RECOVERS_WELL = "（当前模型已有较好恢复能力，可降低优先级）"


def recovery_by_class(facts: DataFrame, reach: int = 4) -> DataFrame:
    """Per class of error: `count`, `recovered` (a call or a recovering thought within the next `reach` step numbers), `rate`, `level`.

    Each error asks for its next numbers by equi-join with the numbers that hold such a step.
    """
    errors = facts.filter("st = 'error'").select("sid", "pos", "step_id", "error_bucket")
    helps = (F.col("kind") == "tool_call") | ((F.col("kind") == "reasoning") & F.col("recovers"))
    marks = facts.filter(helps).select("sid", F.col("step_id").alias("_at")).distinct()
    asked = errors.withColumn("_at", F.explode(F.sequence(F.col("step_id") + 1, F.col("step_id") + reach)))
    hit = asked.join(marks, ["sid", "_at"]).select("sid", "pos").distinct().withColumn("hit", F.lit(1))
    rate = F.col("recovered") / F.col("count")
    return (
        errors.join(hit, ["sid", "pos"], "left")
        .groupBy(F.col("error_bucket").alias("error_type"))
        .agg(F.count("*").alias("count"), F.count("hit").alias("recovered"))
        .withColumn("rate", quantise(rate))
        .withColumn("level", F.when(1 - rate >= 0.7, "critical").when(1 - rate >= 0.4, "high").when(1 - rate >= 0.15, "medium").otherwise("low"))
    )


def error_events(facts: DataFrame) -> DataFrame:
    """Every error with `tool` (of the nearest call among the two steps before) and `recovered`.

    It recovers where one of the next four steps is a successful result with a call of the same tool among the two steps before it.
    """
    errors = facts.filter("st = 'error'").select("sid", "pos", "row", "step_id", "error_kind")
    near = look_around(errors, facts, "sid", "pos", -2, 4, ["kind", "st", "tool"])
    calls = F.filter("near", lambda x: (x["at"] < 0) & (x["kind"] == "tool_call"))
    named = near.withColumn("tool", F.coalesce(F.try_element_at(calls, F.lit(-1))["tool"], F.lit("")))

    def same_tool_before(result):
        return F.exists(
            "near",
            lambda c: (c["kind"] == "tool_call") & (F.coalesce(c["tool"], F.lit("")) == F.col("tool")) & (c["at"] < result["at"]) & (c["at"] >= result["at"] - 2),
        )

    ok = F.exists("near", lambda x: (x["at"] >= 1) & (x["kind"] == "tool_result") & (x["st"] == "success") & same_tool_before(x))
    return named.withColumn("recovered", ok).drop("near")


def taxonomy(events: DataFrame) -> DataFrame:
    """Per finer class: counts, sessions, recovery rate, the five most frequent tools, priority and advice."""
    per_tool = events.groupBy("error_kind", "tool").agg(F.count("*").alias("n"), F.sum(F.col("recovered").cast("int")).alias("r"))
    top = W.partitionBy("error_kind").orderBy(F.desc("n"), "tool")
    ranked = per_tool.withColumn("rank", F.row_number().over(top))
    tools = ranked.filter("rank <= 5").groupBy("error_kind").agg(F.array_sort(F.collect_list(F.struct("rank", "tool", "n"))).alias("t"))
    text = F.array_join(F.transform("t", lambda x: F.concat(x["tool"], F.lit("="), x["n"].cast("string"))), ",")
    totals = per_tool.groupBy("error_kind").agg(F.sum("n").alias("count"), F.sum("r").alias("recovery_count"))
    sessions = events.select("error_kind", "sid").distinct().groupBy("error_kind").agg(F.count("*").alias("session_count"))
    rate = F.col("recovery_count") / F.col("count")
    advice = F.create_map(*[F.lit(x) for kv in ADVICE.items() for x in kv])
    said = F.coalesce(F.try_element_at(advice, F.col("error_kind")), F.lit("人工分析"))
    return (
        totals.join(sessions, "error_kind")
        .join(tools.select("error_kind", text.alias("top_tools")), "error_kind")
        .select(
            F.col("error_kind").alias("error_type"), "count", "session_count", "recovery_count", quantise(rate, 3).alias("recovery_rate"), "top_tools",
            F.when((F.col("count") >= 10) & (rate < 0.3), "high").when(F.col("count") >= 5, "medium").otherwise("low").alias("rl_priority"),
            F.when(rate > 0.7, F.concat(said, F.lit(RECOVERS_WELL))).otherwise(said).alias("fi_recommendation"),
        )
        .orderBy(F.desc("count"), "error_type")
    )


def samples(events: DataFrame, facts: DataFrame, most: int = 5) -> DataFrame:
    """The first `most` errors of each class by session and position, with the kinds of the two steps before and after."""
    first = W.partitionBy("error_kind").orderBy("sid", "pos")
    chosen = events.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= most)
    near = look_around(chosen, facts, "sid", "pos", -2, 2, ["kind"])
    context = F.array_join(F.transform("near", lambda x: x["kind"]), ">")
    return near.select(F.col("error_kind").alias("error_type"), "rank", "sid", "pos", "tool", "recovered", context.alias("context"))


def injection_targets(table: DataFrame) -> DataFrame:
    """Per class of error the rate at which to inject it and the gap to a recovery rate of 0.8."""
    rate = F.when(F.col("rl_priority") == "high", 0.3).when(F.col("rl_priority") == "medium", 0.15).otherwise(0.05)
    return table.select(
        "error_type", F.col("count").alias("occurrence_count"), "session_count", "recovery_rate", "rl_priority", rate.alias("injection_rate"),
        quantise(F.lit(0.8) - F.col("recovery_rate"), 3).alias("gap"),
    ).orderBy(F.when(F.col("rl_priority") == "high", 0).when(F.col("rl_priority") == "medium", 1).otherwise(2), F.desc("occurrence_count"), "error_type")


def injection_contexts(events: DataFrame, facts: DataFrame, steps: DataFrame, most: int = 3) -> DataFrame:
    """The first `most` errors of each class with what they show and the pieces of the two steps before and after, as samples to inject from."""
    chosen = samples(events, facts, most).select("error_type", "rank", "sid", "pos")
    around = chosen.select("error_type", "rank", "sid", F.explode(F.sequence(F.lit(-2), F.lit(2))).alias("at"), "pos").withColumn("pos", F.col("pos") + F.col("at"))
    rows = around.join(facts.select("sid", "pos", "row"), ["sid", "pos"]).select("error_type", "rank", "at", "row")
    texts = with_texts(rows, steps).groupBy("error_type", "rank").agg(
        F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("at", "piece")))).alias("p"), F.max(F.when(F.col("at") == 0, F.left("failure", F.lit(300)))).alias("error_text")
    )
    return texts.select("error_type", "rank", F.coalesce("error_text", F.lit("")).alias("error_text"), F.array_join(F.transform("p", lambda x: x["piece"]), "\n").alias("context"))
