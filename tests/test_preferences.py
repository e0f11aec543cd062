"""Pairs with their texts on hand-made sessions, and the search for partners against brute force."""

import json
import random

from pyspark.sql import functions as F

from tests.test_sequence import BAD, CALL, OK, table
from tracewright.functions.pieces import piece, piece_size
from tracewright.operators import facts, preferences, sequence

CANDS = "sid string, outcome string, use string, total double, tools array<string>, steps bigint, user_input string, fp string"


def call(tool, **params):
    return (CALL, tool, json.dumps(params))


def pairs(spark, sessions, cands, **kw):
    steps = table(spark, sessions)
    own = facts.step_facts(steps)
    rows = [(s, o, u, t, tools, len(sessions[s]), f"do {s}", "fp") for s, o, u, t, tools in cands]
    found = sequence.diverge_points(sequence.retries(own))
    return preferences.run_pairing(spark.createDataFrame(rows, CANDS), own, steps, found, sequence.items_resolved(own), **kw)


GOOD = [call("doc", path="z"), OK, ("reasoning", "fine"), ("output", "all done"), ("output", "bye")]
TOOLS = ["doc", "exec"]


def test_pair_at_an_error(spark):
    failed = [("reasoning", "first"), call("doc", path="a", action="update"), BAD, ("reasoning", "slow down"), call("exec", command="sleep 5"), OK, call("doc", path="a", action="update"), OK]
    r = pairs(spark, {"good": GOOD, "failed1": failed}, [("good", "success", "sft_positive", 0.8, TOOLS), ("failed1", "success", "recovery_training", 0.6, TOOLS)]).collect()
    assert len(r) == 1
    p = r[0]
    assert p["pair_type"] == "success_vs_failure_at_error" and p["pair_quality"] == "high" and p["preference_strength"] == "strong"
    assert "<tool_result" not in p["chosen"] and "<thinking>" not in p["chosen"] and p["chosen"].count("<tool_call>") == 2
    assert p["rejected"] == '<tool_call>\n{"tool": "doc", "params": {"path": "a", "action": "update"}}\n</tool_call>' and p["rejected_source"] == "synthetic_plain_retry" and p["synthetic_rejected"]
    assert p["prompt_before"].startswith("<thinking>\nfirst") and p["prompt_before"].endswith("</tool_call>") and p["prompt_error"] == "[ERROR] HTTP 429"
    assert (p["error_type"], p["diverge_reason"], p["retry_type"], p["error_at_step"]) == ("rate_limit", "rate_limit_retry", "backoff", 3)
    assert p["near_duplicate_group_id"] == "failed1:rate_limit:doc:update" and p["failed_item_eventually_resolved"] and p["resolved"]
    prompt = preferences.prompts(spark.createDataFrame(r, pairs(spark, {"good": GOOD, "failed1": failed}, []).schema)).first()["prompt"]
    assert [m["role"] for m in prompt] == ["system", "user", "assistant", "tool"]


def test_an_abandoned_item_is_worth_less(spark):
    failed = [call("doc", path="a"), BAD, call("exec", command="sleep 5"), OK, call("doc", path="b"), OK]
    p = pairs(spark, {"good": GOOD, "bad": failed}, [("good", "success", "sft_positive", 0.8, TOOLS), ("bad", "failure", "dpo_candidate", 0.6, TOOLS)]).first()
    assert (p["pair_quality"], p["preference_strength"], p["failed_item_eventually_resolved"]) == ("medium", "medium", False)


def test_intent_without_action_and_loops(spark):
    says = [call("doc", path="a"), BAD, ("reasoning", "I will retry this"), ("output", "done"), ("output", "bye")]
    loops = [call("doc", path="a"), BAD, call("doc", path="a"), BAD, call("doc", path="a"), BAD, call("doc", path="a"), BAD]
    got = {r["failure_session"]: r for r in pairs(spark, {"good": GOOD, "says": says, "loops": loops}, [("good", "success", "x", 0.8, TOOLS), ("says", "failure", "x", 0.3, TOOLS), ("loops", "failure", "x", 0.2, TOOLS)]).collect()}
    assert (got["says"]["rejected"], got["says"]["chosen"], got["says"]["pair_quality"], got["says"]["rejected_source"]) == ("I will retry this", "done\nbye", "high", "intent_without_action")
    # After the last of its errors a loop has nothing that could be chosen: the sessions are compared as wholes.
    assert got["loops"]["pair_type"] == "global_success_vs_failure" and got["loops"]["pair_quality"] == "low" and got["loops"]["chosen"].endswith("bye")


def test_sides_of_equal_text_make_no_pair(spark):
    same = [call("doc", path="z"), OK, ("reasoning", "fine"), ("output", "all done"), ("output", "bye")]
    retry = [call("doc", path="a"), BAD, call("doc", path="a")]
    got = pairs(spark, {"good": GOOD, "same": same, "retry": retry}, [("good", "success", "x", 0.8, TOOLS), ("same", "failure", "x", 0.3, TOOLS), ("retry", "failure", "x", 0.3, TOOLS)])
    assert got.count() == 0
    assert pairs(spark, {"good": GOOD}, []).count() == 0


def test_dedup_keeps_the_strong_and_resolved_of_a_group(spark):
    base = {"chosen": "c", "rejected": "r", "task_type": "t"}
    rows = [
        (1, "medium", "medium", False, "g"), (2, "medium", "strong", False, "g"), (3, "medium", "strong", True, "g"), (4, "high", "strong", True, "h"), (5, "medium", "medium", False, "h"),
        (6, "low", None, None, None), (7, "low", None, None, None),
    ]
    df = spark.createDataFrame([(n, q, s, i, g, f"c{n}", "r", "t") for n, q, s, i, g in rows], "n bigint, pair_quality string, preference_strength string, failed_item_eventually_resolved boolean, near_duplicate_group_id string, chosen string, rejected string, task_type string")
    assert sorted(r["n"] for r in preferences.deduplicated(df).collect()) == [2, 3, 4, 6, 7]
    same = df.withColumn("chosen", F.lit(base["chosen"])).withColumn("pair_quality", F.lit("low"))
    assert [r["n"] for r in preferences.deduplicated(same).collect()] == [1]


def test_quality_partners_equal_brute_force(spark):
    rnd = random.Random(5)
    sessions, cands = {}, []
    for i in range(60):
        sid = f"s{i:02d}"
        # The best of the task share no tools with the others, so that pairs lie far down.
        tools = [f"a{rnd.randrange(3)}", "x"] if i < 15 else [f"b{k}" for k in range(rnd.randrange(2, 6))]
        sessions[sid] = [call("doc", path=str(rnd.randrange(4))), OK, ("reasoning", "fine"), ("output", "o"), ("output", "p")]
        cands.append((sid, "success", "x", round(0.99 - 0.001 * i if i < 15 else rnd.randrange(50, 80) / 100, 4), sorted(set(tools))))
    for cap in (5, 40):
        got = [(r["success_session"], r["failure_session"]) for r in pairs(spark, sessions, cands, cap=cap).orderBy("n").collect()]
        order = sorted(cands, key=lambda c: (-c[3], c[0]))
        want = []
        for i, h in enumerate(order):
            for lo in order[i + 1 :]:
                a, b = set(h[4]), set(lo[4])
                if round((h[3] - lo[3]) * 10000) >= 500 and len(a & b) / len(a | b) >= 0.5 and sessions[h[0]] != sessions[lo[0]]:
                    want.append((h[0], lo[0]))
        assert got == want[:cap] and len(want) > 40


def test_piece_size_is_the_length_of_the_piece(spark):
    rows = [("reasoning", None, "abc", None, None, None), ("reasoning", None, "[任务理解] x", None, None, None), ("tool_call", None, None, "doc", '{"a": 1}', None), ("tool_result", "error", None, None, None, "x" * 50), ("output", None, "", None, None, None), ("tool_call", None, None, None, None, None)]
    df = spark.createDataFrame([(*r, None) for r in rows], "kind string, st string, content string, tool_name string, input_params string, output string, error string")
    got = df.select(F.length(piece(20)).alias("a"), piece_size(20).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got) and [r["a"] is None for r in got] == [False, True, False, False, True, False]
