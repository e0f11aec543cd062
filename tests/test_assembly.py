import json

from pyspark.sql import functions as F

from tracewright.operators import assembly

COLS = "event_row bigint, session_id string, trace_id string, seq bigint, source_seq bigint, event_type string, ts string, agent_id string, model_id string, provider string, session_key string, parent_session_id string, data string"


def events(spark, rows):
    return spark.createDataFrame(
        [(i, "s", None, no, None, kind, None, "a1", "m1", None, "agent:porter:x", None, json.dumps(d) if d is not None else None) for i, (no, kind, d) in enumerate(rows)], COLS
    )


def test_thinking_and_task(spark):
    t = "<thinking> a </thinking>\nhello <thinking>b</thinking> \n"
    r = spark.createDataFrame([(t,)], "t string").select(assembly.thinking(F.col("t")), assembly.spoken(F.col("t"))).first()
    assert tuple(r) == ("a\n\nb", "hello")
    prompts = ["x [Subagent Task] do it [end", "sys\nHuman: first\nAssistant: ok\nHuman: second\nAssistant: ", "plain"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in prompts], "p string").select(assembly.user_task(F.col("p"))).collect()]
    assert got == ["do it", "second", "plain"]


def test_artifacts_go_to_the_nearest_turn_once(spark):
    rows = assembly.event_rows(events(spark, [(1, "model.completed", {"assistantTexts": ["x"]}), (2, "trace.artifacts", {"toolMetas": []}), (3, "model.completed", {"assistantTexts": ["y"]}), (4, "trace.artifacts", {"toolMetas": []}), (30, "trace.artifacts", {"toolMetas": []}), (31, "model.completed", {"assistantTexts": []})]))
    got = {r["artifact_no"]: r["model_no"] for r in assembly.match_artifacts(rows).collect()}
    assert got == {2: 1, 4: 3, 30: None}


def test_assembled_session(spark):
    meta = [{"toolName": "read", "input": {"path": "p"}, "result": "HTTP 429"}, {"tool": "", "result": "x"}, {"tool": "write", "output": "fine"}]
    raw = events(spark, [(1, "session.started", {}), (2, "prompt.submitted", {"prompt": "do it"}), (3, "trace.artifacts", {"toolMetas": meta}), (4, "model.completed", {"assistantTexts": ["<thinking>t</thinking>out"]}), (5, "session.ended", {"finalStatus": ""})])
    rows = assembly.event_rows(raw)
    steps = assembly.assembled_steps(rows)
    got = [(r["step_id"], r["step_type"], r["tool_name"], r["content"], r["status"]) for r in steps.orderBy("step_id").collect()]
    assert got == [
        (1, "reasoning", None, "[任务理解] do it", None), (2, "reasoning", None, "t", None), (3, "tool_call", "read", None, None), (4, "tool_result", "read", "HTTP 429", "error"),
        (5, "tool_call", "write", None, None), (6, "tool_result", "write", "fine", "success"), (7, "output", None, "out", None),
    ]
    r = assembly.session_outcomes(rows, steps).first()
    assert (r["agent"], r["outcome"], r["tool_count"], r["rounds"]) == ("porter", "likely_failure", 2, 1)


def test_error_results(spark):
    texts = ['{"isError": true}', '{"success": true, "note": "error"}', '{"error": ""}', "connection refused", "fine", "", None, '{"status": "error"}']
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(assembly.is_error_result(F.col("t"))).collect()]
    assert got == [True, False, False, True, False, False, False, True]


def test_backfill_by_ordinal(spark):
    calls = spark.createDataFrame([("s", 1, "read", "{}"), ("s", 3, "read", None), ("s", 5, "read", '{"a": 1}'), ("s", 7, "write", "{}")], "sid string, pos bigint, tool string, params string")
    uses = spark.createDataFrame([("s", 10, "read", '{"p": 1}', "c1"), ("s", 11, "read", '{"p": 2}', "c2"), ("s", 12, "read", '{"p": 3}', "c3")], "sid string, pos bigint, tool string, params string, call string")
    got = {r["pos"]: (r["params"], r["use_call"]) for r in assembly.backfilled(calls, uses).collect()}
    assert got == {1: ('{"p": 1}', "c1"), 3: ('{"p": 2}', "c2"), 5: ('{"a": 1}', "c3"), 7: ("{}", None)}


def test_calls_are_filled_from_artifacts(spark):
    metas = [{"toolName": "read", "input": {"path": "p"}, "output": "HTTP 429"}, {"tool": "read", "args": {"path": "q"}, "result": "x"}, {"tool": "read", "input": {"n": 0}, "result": "y"}]
    uses = assembly.tool_uses(assembly.event_rows(events(spark, [(1, "trace.artifacts", {"toolMetas": metas})])))
    raw = [(1, "read", "c1", '{"path": ""}'), (3, "read", "c2", '{"path": "own"}'), (5, "read", "c3", None), (7, "write", None, "{}")]
    calls = spark.createDataFrame([("s", p, t, c, x, x) for p, t, c, x in raw], "sid string, pos bigint, tool string, call string, params string, own_params string")
    results = spark.createDataFrame([("s", 2, "c1", "", "success"), ("s", 4, "c2", "kept", "success"), ("s", 6, "c3", None, "success")], "sid string, pos bigint, call string, output string, status string")
    got = {r["pos"]: r for r in assembly.filled_calls(calls, results, uses).collect()}
    cols = ("params", "params_filled", "params_missing", "output", "status", "output_filled", "output_missing")
    assert {p: tuple(r[c] for c in cols) for p, r in got.items()} == {
        1: ('{"path":"p"}', True, False, "HTTP 429", "error", True, False), 3: ('{"path": "own"}', False, False, "kept", "success", False, False),
        5: ("{}", False, True, "y", "success", True, False), 7: ("{}", False, True, None, None, False, True),
    }


def test_different_events_under_one_number_are_all_kept(spark):
    meta = lambda t: {"toolMetas": [{"toolName": t, "result": "fine"}]}
    raw = events(spark, [(None, "model.completed", {"assistantTexts": ["x"]}), (None, "model.completed", {"assistantTexts": ["y"]}), (None, "trace.artifacts", meta("a")), (None, "trace.artifacts", meta("b")), (None, "trace.artifacts", meta("b"))])
    steps = assembly.assembled_steps(assembly.event_rows(raw)).orderBy("step_id").collect()
    assert [(r["step_type"], r["tool_name"] or r["content"]) for r in steps] == [
        ("tool_call", "a"), ("tool_result", "a"), ("output", "x"), ("tool_call", "b"), ("tool_result", "b"), ("output", "y")
    ]


def test_long_chains_are_matched_alike_and_in_proportion(spark):
    import random
    import time

    rng = random.Random(6)
    meta, text = {"toolMetas": []}, {"assistantTexts": ["x"]}
    rows = assembly.event_rows(events(spark, [(rng.randrange(0, 400), *(("trace.artifacts", meta | {"i": i}) if rng.random() < 0.5 else ("model.completed", text | {"i": i}))) for i in range(300)]))
    short, long = ({tuple(r) for r in assembly.match_artifacts(rows, long_chain=n).collect()} for n in (10**6, 0))
    assert short == long and len(long) > 100
    many = spark.range(60_000).selectExpr("'s' sid", "id no", "id row", "if(id % 2 = 0, 'model.completed', 'trace.artifacts') type", "array('t') texts")
    at = time.time()
    assert assembly.match_artifacts(many).filter("model_no is not null").count() == 30_000 and time.time() - at < 60
