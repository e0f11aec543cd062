"""What follows an error: how it is retried, whether the work was made good, and which error parts two trajectories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.operators.facts import ITEM_KEYS
from tracewright.operators.ordered import look_around

AHEAD = 8
NEAR = ["kind", "st", "tool", "params", "command", "announces"]


def retries(facts: DataFrame) -> DataFrame:
    """Every error with `recovery_kind`, `resolved`, `retry_loop`, `intent_only` and `error_class`.

    Among the next eight steps, a pause beats changed parameters, these beat a plain repeat of the call before the error. `resolved` asks for a
    success, `retry_loop` for two errors after the first repeat. `intent_only` holds where the first thought or output of the next four
    announces another attempt and none of the three steps after it is a call.
    """
    errors = facts.filter("st = 'error'").select("sid", "pos", "step_id", "error_class")
    e = look_around(errors, facts, "sid", "pos", -1, AHEAD, NEAR)
    cause = F.get(F.filter("near", lambda x: (x["at"] == -1) & (x["kind"] == "tool_call")), F.lit(0))
    e = e.withColumn("cause", cause).withColumn("after", F.filter("near", lambda x: x["at"] >= 1))
    same = lambda x: (x["kind"] == "tool_call") & (x["tool"] == F.col("cause.tool"))
    pauses = F.exists("after", lambda x: (x["kind"] == "tool_call") & (x["tool"] == "exec") & x["command"].rlike("sleep|delay|wait"))
    changed = F.exists("after", lambda x: same(x) & (x["params"] != F.col("cause.params")))
    e = e.withColumn("first_same", F.array_min(F.transform(F.filter("after", same), lambda x: x["at"])))
    later = lambda x, st: (x["kind"] == "tool_result") & (x["st"] == st) & (x["at"] > F.col("first_same"))
    flag = lambda c: F.coalesce(c, F.lit(False))
    kind = (
        F.when(flag(pauses), "backoff_retry").when(flag(changed), "adaptive_retry").when(F.col("first_same").isNotNull(), "plain_retry").otherwise("no_retry")
    )
    tried = F.col("recovery_kind") != "no_retry"
    e = e.withColumn("recovery_kind", kind)
    e = e.withColumn("resolved", tried & flag(F.exists("after", lambda x: later(x, "success"))))
    e = e.withColumn("retry_loop", tried & flag(F.size(F.filter("after", lambda x: flag(later(x, "error")))) >= 2))
    said = F.get(F.filter("after", lambda x: (x["at"] <= 4) & x["kind"].isin("reasoning", "output")), F.lit(0))
    e = e.withColumn("said", said)
    acts = F.exists("after", lambda x: (x["kind"] == "tool_call") & (x["at"] > F.col("said.at")) & (x["at"] <= F.col("said.at") + 3))
    e = e.withColumn("intent_only", flag(F.col("said.announces")) & ~flag(acts))
    return e.select(
        "sid", "pos", "step_id", "error_class", "recovery_kind", "resolved", "retry_loop", "intent_only",
        F.col("cause.tool").alias("failed_tool"), F.col("cause.params").alias("failed_params"),
    )


def items_resolved(facts: DataFrame) -> DataFrame:
    """`sid`, `pos` of the errors whose call's item a later call takes up and whose very next step is a success.

    The item is all of ITEM_KEYS that the failed call holds; the later call must agree on each and may hold more (a null value agrees with a missing one).
    An equi-join on session and the first mark with a value, between distinct items of a session, and an exact check of the others.
    """
    errors = facts.filter("st = 'error'").select("sid", F.col("pos").alias("pos"), (F.col("pos") - 1).alias("_c"))
    calls = facts.filter("kind = 'tool_call'").select("sid", F.col("pos").alias("_c"), "items")
    caused = errors.join(calls.filter("items is not null"), ["sid", "_c"]).select("sid", "pos", "items")
    good = facts.filter("st = 'success'").select("sid", (F.col("pos") - 1).alias("_c"))
    # Of a later call every key counts: with its value, or alone where it has none.
    held = lambda k: F.coalesce(F.get(F.filter("items", lambda x: x.startswith(k + "\u0001")), F.lit(0)), F.lit(k))
    done = calls.join(good, ["sid", "_c"]).groupBy("sid", F.array(*[held(k) for k in ITEM_KEYS]).alias("_all")).agg(F.max("_c").alias("_done"))
    asked = caused.select("sid", "items").distinct().withColumn("_key", F.coalesce(F.get(F.filter("items", lambda x: x.contains("\u0001")), F.lit(0)), F.get("items", F.lit(0))))
    met = asked.join(done.withColumn("_key", F.explode("_all")), ["sid", "_key"]).filter(F.size(F.array_except("items", "_all")) == 0)
    last = met.groupBy("sid", "items").agg(F.max("_done").alias("_done"))
    return caused.join(last, ["sid", "items"]).filter("_done > pos").select("sid", "pos")


def diverge_points(found: DataFrame) -> DataFrame:
    """The error of each session that parts it best: `sid`, `pos`, `priority` and what `retries` says of it."""
    better = F.col("recovery_kind").isin("adaptive_retry", "backoff_retry")
    priority = (
        F.when(F.col("intent_only"), 1).when(better & F.col("resolved"), 2).when(better, 3)
        .when((F.col("recovery_kind") == "plain_retry") & F.col("resolved"), 4).otherwise(5)
    )
    ranked = found.withColumn("priority", priority)
    order = F.struct("priority", F.when(F.col("priority") == 5, -F.col("pos")).otherwise(F.col("pos")).alias("o"))
    cols = [c for c in ranked.columns if c != "sid"]
    return ranked.groupBy("sid").agg(F.min_by(F.struct(*cols), order).alias("d")).select("sid", "d.*")
