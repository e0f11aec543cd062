"""Preference pairs with their texts: prompt, chosen and rejected, built for the sessions that ranks have let through.

Ranks, similarities and lengths are decided on narrow rows; texts are read for at most fifteen sessions of a task and for the pairs
that stand, by their row numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewright.functions import steps as S
from tracewright.functions.pieces import piece, within
from tracewright.functions.text import fingerprint_pair, quantise, truthy_coalesce
from tracewright.operators.facts import PIECE
from tracewright.operators.ordered import with_running_sum
from tracewright.operators.pairing import capped_groups, jaccard, pools
from tracewright.sources.tables import cut_lineage, lookup

#: What a prompt opens with unless the caller has a text of their own.
SYSTEM = "You are an agent with skills and tools. Reason step by step, stay within the skill at hand and handle errors with care."
# Characters of a rendered side, of a declared intent and of the error in a prompt; steps of a global and of a quality side.
BUDGET, DECLARED, SHOWN_ERROR, GLOBAL_STEPS, QUALITY_STEPS = 6000, 2000, 1000, 12, 10
# Steps after an error that hold the recovery, a loop of retries, and what stands in for a call.
AHEAD, LOOP, INSTEAD = 8, 4, 2
# Reasons of divergence by class of error; others are generic.
REASONS = {
    "rate_limit": "rate_limit_retry", "timeout": "timeout_recovery", "auth_error": "auth_error_handling", "not_found": "not_found_recovery",
    "server_error": "server_error_recovery",
}
GENERIC = "generic_error_recovery"
# Classes of error that a plain retry does not mend.
PLAIN_BAD = ("rate_limit", "not_found", "auth_error", "parse_error")
RETRY_TYPES = {"backoff_retry": "backoff", "adaptive_retry": "param_change", "plain_retry": "same_tool", "no_retry": "none"}


def _map(c: Column, table: dict[str, str], default: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c), F.lit(default))


def heads(facts: DataFrame, sids: DataFrame, last: int) -> DataFrame:
    """`sid`, `pos`, `row`, `mark` of the pieces among the first `last` steps of the sessions `sids` that fit the budget."""
    own = facts.filter((F.col("pos") <= last) & F.col("size").isNotNull()).join(sids, "sid", "left_semi")
    upto = F.sum("size").over(W.partitionBy("sid").orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    return own.select("sid", "pos", "row", "mark", upto.alias("upto")).filter(F.col("upto") <= BUDGET).drop("upto")


def with_texts(needed: DataFrame, steps: DataFrame) -> DataFrame:
    """`needed` (with `row`) and the texts of those steps: `piece`, `content`, `failure` (what a result shows).

    Few rows are needed, so they are sent to the texts where their count allows, and not the texts to them.
    """
    rows = lookup(needed)
    texts = steps.select(F.col("step_row").alias("row"), "step_type", "content", "tool_name", "input_params", "status", "output", "error")
    own = texts.join(rows, "row").withColumn("kind", S.step_type(F.col("step_type"))).withColumn("st", S.resolved_status(F.col("status"), F.col("output"), F.col("error")))
    out = own.select(*needed.columns, "kind", piece(PIECE).alias("piece"), F.left("content", F.lit(DECLARED)).alias("content"), F.left(truthy_coalesce(F.col("output"), F.col("error")), F.lit(SHOWN_ERROR)).alias("failure"))
    return out.dropDuplicates(needed.columns)


def head_texts(facts: DataFrame, steps: DataFrame, sids: DataFrame, last: int) -> DataFrame:
    """`sid`, `text` of the first `last` steps of each session; sessions without a piece are left out."""
    parts = with_texts(heads(facts, sids, last).select("sid", "pos", "row"), steps).groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("p"))
    return parts.select("sid", F.array_join(F.transform("p", lambda x: x["piece"]), "\n").alias("text"))


def error_texts(facts: DataFrame, steps: DataFrame, diverged: DataFrame) -> DataFrame:
    """`sid` and the texts around the error that `diverged` (`sid`, `pos`) names: `before`, `error`, `chosen`, `declared`, `loop`, `call`, `instead`, and the call's `tool` and `action`.

    What stood before is the longest beginning of the session within the budget, so at most that many characters of a session meet.
    """
    at = diverged.select("sid", F.col("pos").alias("_e"))
    own = with_running_sum(facts.filter("size is not null").join(at.select("sid"), "sid", "left_semi").select("sid", "pos", "row", "size"), "sid", "pos", F.col("size"), "upto")
    before = own.filter(F.col("upto") <= BUDGET).join(at, "sid").filter("pos < _e").select("sid", F.lit("before").alias("use"), F.col("pos").cast("bigint").alias("at"), "row")
    asked = at.select("sid", F.explode(F.sequence(F.lit(-1).cast("bigint"), F.lit(AHEAD).cast("bigint"))).alias("at"), "_e").withColumn("pos", F.col("_e") + F.col("at"))
    near = asked.join(facts.select("sid", "pos", "row", "kind", "tool", "action"), ["sid", "pos"])
    cause = near.filter("at = -1 and kind = 'tool_call'").select("sid", "tool", "action")
    parts = with_texts(before.unionByName(near.select("sid", F.lit("near").alias("use"), "at", "row")), steps)
    x = parts.groupBy("sid").agg(
        F.array_sort(F.collect_list(F.when(F.col("use") == "before", F.struct("at", "piece")))).alias("b"),
        F.array_sort(F.collect_list(F.when(F.col("use") == "near", F.struct("at", "kind", "piece", "content", "failure")))).alias("n"),
    )
    n = F.col("n")
    seen = lambda first, last: F.filter(n, lambda s: s["at"].between(first, last) & s["piece"].isNotNull())
    acts = F.filter(n, lambda s: (s["at"] >= 1) & s["piece"].isNotNull() & s["kind"].isin("tool_call", "output"))
    said = F.get(F.filter(n, lambda s: s["at"].between(1, 4) & s["kind"].isin("reasoning", "output")), F.lit(0))
    return x.select(
        "sid", F.array_join(F.transform("b", lambda s: s["piece"]), "\n").alias("before"),
        F.coalesce(F.get(F.filter(n, lambda s: s["at"] == 0), F.lit(0))["failure"], F.lit("")).alias("error"),
        within(acts, BUDGET).alias("chosen"), F.coalesce(said["content"], F.lit("")).alias("declared"), within(seen(1, LOOP), BUDGET).alias("loop"),
        F.get(F.filter(n, lambda s: (s["at"] == -1) & (s["kind"] == "tool_call")), F.lit(0))["piece"].alias("call"), within(seen(1, INSTEAD), BUDGET).alias("instead"),
    ).join(cause, "sid", "left")


def error_pairs(cands: DataFrame, facts: DataFrame, steps: DataFrame, diverged: DataFrame, resolved: DataFrame, least: float = 0.5, cap: int = 10) -> DataFrame:
    """Each of a task's ten poorest error states with the most similar of its five best successes that makes a pair with it.

    A pair at an error sets the recovery against what should not have been done; where there is no error, or one side is empty, the
    beginnings of both sessions are compared. Sides of equal text make no pair. Both sides are cut by rank before they meet. A session that is
    both a recovery and a failure counts once.
    """
    good, bad = pools(cands)
    rank = lambda order: F.row_number().over(W.partitionBy("fp").orderBy(order, "sid"))
    # Tables with texts are written once but never broadcast: their rows are few, their size is not bounded.
    best = cut_lineage(good.withColumn("rank", rank(F.desc("total"))).filter("rank <= 5"))
    worst = cut_lineage(bad.withColumn("rank", rank(F.asc("total"))).filter("rank <= 10"))
    sides = best.select("sid").unionByName(worst.select("sid")).distinct()
    text = cut_lineage(head_texts(facts, steps, sides, GLOBAL_STEPS))
    errors = diverged.join(worst.select("sid"), "sid", "left_semi").join(resolved.withColumn("item_resolved", F.lit(True)), ["sid", "pos"], "left")
    errors = lookup(errors.withColumn("item_resolved", F.coalesce("item_resolved", F.lit(False))))
    around = cut_lineage(error_texts(facts, steps, errors))
    better = F.col("recovery_kind").isin("adaptive_retry", "backoff_retry")
    quality = (
        F.when(F.col("retry_loop") & ~F.col("resolved"), "low").when(F.col("intent_only"), "high")
        .when(better & F.col("resolved") & (F.col("error_class") == "rate_limit") & ~F.col("item_resolved"), "medium")
        .when(better & F.col("resolved"), "high").otherwise("medium")
    )
    source = F.when(F.col("intent_only"), "intent_without_action").when(F.col("retry_loop"), "real_retry_loop").when(F.col("call").isNotNull(), "synthetic_plain_retry").otherwise("error_after_steps")
    rejected = F.when(F.col("intent_only"), F.col("declared")).when(F.col("retry_loop"), F.col("loop")).otherwise(F.coalesce("call", "instead"))
    strength = (
        F.when(F.col("intent_only") | F.col("retry_loop"), "strong")
        .when(F.col("error_class").isin(*PLAIN_BAD) & better & ((F.col("error_class") != "rate_limit") | F.col("item_resolved")), "strong").otherwise("medium")
    )
    state = errors.join(around, "sid", "left").select(
        F.col("sid").alias("failure_session"), F.col("pos").alias("error_at_step"), F.col("error_class").alias("error_type"), "recovery_kind", "resolved", "retry_loop", "intent_only", "item_resolved",
        "tool", "action", F.coalesce("before", F.lit("")).alias("before"), F.coalesce("error", F.lit("")).alias("error"), F.coalesce("chosen", F.lit("")).alias("chosen"),
        F.coalesce(rejected, F.lit("")).alias("rejected"), quality.alias("pair_quality"), source.alias("rejected_source"), strength.alias("preference_strength"),
    )
    side = lambda df, p: df.select("fp", *[F.col(c).alias(f"{p}_{c}") for c in ("sid", "total", "steps", "tools", "rank", "user_input")])
    raw = jaccard(F.col("s_tools"), F.col("f_tools"))
    met = side(best, "s").join(side(worst, "f"), "fp").withColumn("raw", raw).filter(F.col("raw") >= least).withColumn("tool_similarity", quantise(F.col("raw"), 3)).filter("tool_similarity > 0")
    met = met.join(state, F.col("f_sid") == F.col("failure_session"), "left")
    met = met.join(text.toDF("s_sid", "s_text"), "s_sid", "left").join(text.toDF("f_sid", "f_text"), "f_sid", "left")
    at_error = F.coalesce((F.col("chosen") != "") & (F.col("rejected") != ""), F.lit(False))
    fits = F.when(at_error, F.col("chosen") != F.col("rejected")).otherwise(F.coalesce((F.col("s_text") != "") & (F.col("f_text") != "") & (F.col("s_text") != F.col("f_text")), F.lit(False)))
    pick = W.partitionBy("fp", "f_sid").orderBy(F.desc("tool_similarity"), "s_rank")
    one = met.withColumn("at_error", at_error).filter(fits).withColumn("k", F.row_number().over(pick)).filter("k = 1")
    capped = one.withColumn("n", F.row_number().over(W.partitionBy("fp").orderBy("f_rank"))).filter(F.col("n") <= cap)
    here = lambda c: F.when(F.col("at_error"), F.col(c) if isinstance(c, str) else c)
    group = F.concat_ws(":", F.left("f_sid", F.lit(8)), "error_type", F.coalesce("tool", F.lit("")), F.coalesce("action", F.lit("")))
    return capped.select(
        F.sha2(F.concat_ws(":", F.lit("error"), "f_sid", "s_sid"), 256).alias("pair_id"),
        F.when(F.col("at_error"), "success_vs_failure_at_error").otherwise("global_success_vs_failure").alias("pair_type"),
        F.when(F.col("at_error"), F.col("pair_quality")).otherwise("low").alias("pair_quality"), F.col("fp").alias("task_type"), F.col("n").cast("bigint").alias("n"),
        F.when(F.col("at_error"), _map(F.col("error_type"), REASONS, GENERIC)).otherwise("unknown").alias("diverge_reason"),
        F.when(F.col("at_error"), F.col("error_type")).otherwise("none").alias("error_type"), F.coalesce(here("intent_only"), F.lit(False)).alias("intent_only_failure"), "tool_similarity",
        F.coalesce("f_user_input", F.lit("")).alias("prompt_user"), here("before").alias("prompt_before"), here(F.concat(F.lit("[ERROR] "), F.col("error"))).alias("prompt_error"),
        F.when(F.col("at_error"), F.col("chosen")).otherwise(F.col("s_text")).alias("chosen"), F.when(F.col("at_error"), F.col("rejected")).otherwise(F.col("f_text")).alias("rejected"),
        F.col("s_sid").alias("success_session"), F.col("f_sid").alias("failure_session"), here("s_total").alias("success_score"), here("f_total").alias("failure_score"),
        here("s_steps").alias("success_steps"), here("f_steps").alias("failure_steps"), here("error_at_step").alias("error_at_step"), here("recovery_kind").alias("recovery_kind"),
        here(_map(F.col("recovery_kind"), RETRY_TYPES, "none")).alias("retry_type"), here("resolved").alias("resolved"), here("retry_loop").alias("retry_loop"),
        here(F.lit("same_session_recovery")).alias("chosen_source"), here("rejected_source").alias("rejected_source"), here("preference_strength").alias("preference_strength"),
        here(F.lit("same_session_recovery_vs_synthetic_plain_retry")).alias("pair_construction"), here(F.col("rejected_source").startswith("synthetic")).alias("synthetic_rejected"),
        here("item_resolved").alias("failed_item_eventually_resolved"), here(group).alias("near_duplicate_group_id"), F.lit(None).cast("double").alias("score_gap"),
    )


def _lowest_two(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per `keys` the lowest `units` with its `head`, and the lowest among other heads: all that a partner search needs of a group."""
    per = df.groupBy(*keys, "head").agg(F.min("units").alias("units"))
    ranked = per.withColumn("k", F.row_number().over(W.partitionBy(*keys).orderBy("units", "head"))).filter("k <= 2")
    return ranked.drop("k")


def quality_pairs(cands: DataFrame, facts: DataFrame, steps: DataFrame, error_found: DataFrame, least: float = 0.5, gap: float = 0.05, cap: int = 10) -> DataFrame:
    """Pairs of successes of a task whose scores differ by `gap` and whose beginnings differ, better first, as far as the task's error pairs leave room under `cap`.

    No session meets all others of its task. Per set of tools the two lowest scores with different beginnings tell which sessions have a partner
    at all; the first `cap` of these then meet the task's sessions, so every pair that ranks let through is found and the work grows with the rows.
    """
    good, _ = pools(cands)
    head = heads(facts, good.select("sid"), QUALITY_STEPS).groupBy("sid").agg(F.xxhash64(F.transform(F.array_sort(F.collect_list(F.struct("pos", "mark"))), lambda x: x["mark"])).alias("head"))
    own = good.join(head, "sid").withColumn("units", F.floor(F.col("total") * 10000 + 0.5)).select("fp", "sid", "tools", "total", "units", "head", "steps")
    step = int(gap * 10000 + 0.5)
    sets = lookup(_lowest_two(own, ["fp", "tools"]))
    asked = sets.select("fp", "tools").distinct()
    reach = asked.join(sets.withColumnRenamed("tools", "other"), "fp").filter(jaccard(F.col("tools"), F.col("other")) >= least)
    floor = _lowest_two(reach.select("fp", "tools", "head", "units"), ["fp", "tools"]).groupBy("fp", "tools").agg(F.array_sort(F.collect_list(F.struct("units", "head"))).alias("low"))
    has = F.exists("low", lambda x: (x["head"] != F.col("head")) & (x["units"] <= F.col("units") - step))
    high = own.join(lookup(floor), ["fp", "tools"]).filter(has).withColumn("k", F.row_number().over(W.partitionBy("fp").orderBy(F.desc("total"), "sid"))).filter(F.col("k") <= cap)
    h = lookup(high.select("fp", *[F.col(c).alias(f"h_{c}") for c in ("sid", "tools", "total", "units", "head", "steps")]))
    lo = own.select("fp", *[F.col(c).alias(f"l_{c}") for c in ("sid", "tools", "total", "units", "head", "steps")])
    raw = jaccard(F.col("h_tools"), F.col("l_tools"))
    met = lo.join(h, "fp").filter((F.col("h_units") - F.col("l_units") >= step) & (F.col("h_head") != F.col("l_head"))).withColumn("raw", raw).filter(F.col("raw") >= least)
    order = W.partitionBy("fp").orderBy(F.desc("h_total"), "h_sid", F.desc("l_total"), "l_sid")
    pairs = met.withColumn("m", F.row_number().over(order)).filter(F.col("m") <= cap)
    taken = error_found.groupBy(F.col("task_type").alias("fp")).agg(F.count("*").alias("taken"))
    kept = lookup(pairs.join(taken, "fp", "left").withColumn("n", F.col("m") + F.coalesce("taken", F.lit(0))).filter(F.col("n") <= cap))
    text = cut_lineage(head_texts(facts, steps, kept.select(F.col("h_sid").alias("sid")).unionByName(kept.select(F.col("l_sid").alias("sid"))).distinct(), QUALITY_STEPS))
    asked = good.join(kept.select(F.col("h_sid").alias("sid")), "sid", "left_semi").select(F.col("sid").alias("h_sid"), F.col("user_input").alias("h_user_input"))
    j = kept.join(text.toDF("h_sid", "chosen"), "h_sid").join(text.toDF("l_sid", "rejected"), "l_sid").join(asked, "h_sid")
    none = lambda t: F.lit(None).cast(t)
    return j.select(
        F.sha2(F.concat_ws(":", F.lit("quality"), "h_sid", "l_sid"), 256).alias("pair_id"), F.lit("quality_comparison").alias("pair_type"), F.lit("medium").alias("pair_quality"), F.col("fp").alias("task_type"),
        F.col("n").cast("bigint").alias("n"), F.lit("efficiency_difference").alias("diverge_reason"), F.lit("none").alias("error_type"), F.lit(False).alias("intent_only_failure"), quantise(F.col("raw"), 3).alias("tool_similarity"),
        F.coalesce("h_user_input", F.lit("")).alias("prompt_user"), none("string").alias("prompt_before"), none("string").alias("prompt_error"), "chosen", "rejected",
        F.col("h_sid").alias("success_session"), F.col("l_sid").alias("failure_session"), F.col("h_total").alias("success_score"), F.col("l_total").alias("failure_score"),
        F.col("h_steps").alias("success_steps"), F.col("l_steps").alias("failure_steps"), none("bigint").alias("error_at_step"), none("string").alias("recovery_kind"), none("string").alias("retry_type"),
        none("boolean").alias("resolved"), none("boolean").alias("retry_loop"), none("string").alias("chosen_source"), none("string").alias("rejected_source"), none("string").alias("preference_strength"),
        none("string").alias("pair_construction"), none("boolean").alias("synthetic_rejected"), none("boolean").alias("failed_item_eventually_resolved"), none("string").alias("near_duplicate_group_id"),
        quantise(F.col("h_total") - F.col("l_total")).alias("score_gap"),
    )


def run_pairing(cands: DataFrame, facts: DataFrame, steps: DataFrame, diverged: DataFrame, resolved: DataFrame, least: float = 0.5, cap: int = 10) -> DataFrame:
    """All pairs of the candidates, those at errors first: at most `cap` a task."""
    found = cut_lineage(error_pairs(cands, facts, steps, diverged, resolved, least, cap))
    return found.unionByName(quality_pairs(cands, facts, steps, found, least, 0.05, cap))


def deduplicated(pairs: DataFrame, high_only: bool = False) -> DataFrame:
    """`pairs` without repeats: the first of equal sides and quality, then of each near-duplicate group one if its best is of high quality, else two.

    Within a group strong preferences come first, then those whose failed item was made good, then the order of pairing. Pairs of no group stay.
    """
    marked = pairs.withColumn("_mark", fingerprint_pair(F.col("chosen"), F.col("rejected"), F.col("pair_quality")))
    first = marked.withColumn("_k", F.row_number().over(W.partitionBy("_mark").orderBy("task_type", "n"))).filter("_k = 1").drop("_k", "_mark")
    order = [F.desc(F.coalesce(F.col("preference_strength") == "strong", F.lit(False))), F.desc(F.coalesce("failed_item_eventually_resolved", F.lit(False))), F.col("task_type"), F.col("n")]
    kept = capped_groups(first, "near_duplicate_group_id", order)
    return kept.filter("pair_quality = 'high'") if high_only else kept


def prompts(pairs: DataFrame, system: str = SYSTEM) -> DataFrame:
    """`pairs` with `prompt`, the messages before the two sides: system, user, what stood before the error if anything did, and the error."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    all_ = F.array(
        message("system", F.lit(system)), message("user", F.col("prompt_user")), F.when(F.col("prompt_before") != "", message("assistant", F.col("prompt_before"))),
        F.when(F.col("prompt_error").isNotNull(), message("tool", F.col("prompt_error"))),
    )
    return pairs.withColumn("prompt", F.array_compact(all_)).drop("prompt_user", "prompt_before", "prompt_error")


def loss_weight() -> Column:
    """1 for a strong preference or a real rejected side, half for a synthetic one."""
    return F.when(F.col("preference_strength") == "strong", 1.0).when(F.coalesce("synthetic_rejected", F.lit(False)), 0.5).otherwise(1.0)


def export_main(pairs: DataFrame) -> DataFrame:
    """Pairs of high quality at an error, with their `loss_weight`."""
    return pairs.filter("pair_quality = 'high' and pair_construction = 'same_session_recovery_vs_synthetic_plain_retry'").withColumn("loss_weight", loss_weight())
