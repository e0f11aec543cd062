"""Session records of every shape, and the readers and writers around them."""

import json

import pytest
from pyspark.sql import functions as F

from tracewright.operators import render, samples
from tracewright.sources import logs, parse, sinks
from tests.test_sequence import CALL, OK, table


def records(spark, docs):
    rows = [(i, d if isinstance(d, str) else json.dumps(d), "clash", 1) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "n bigint, d string, session_id string, pos int").select("n", F.try_parse_json("d").alias("v")).filter("v is not null")


def steps_of(spark, *steps):
    df = records(spark, [{"session_id": "s", "user_input": "u", "trajectory": list(steps)}])
    return parse.structured_steps(df, ["n"]).orderBy("pos").collect()


def test_steps_by_their_other_names(spark):
    got = steps_of(
        spark, {"type": "Thinking ", "thinking": "hm", "content": ""}, {"step_type": "route", "skill": "DocSkill", "reason": "r", "metadata": {"confidence": 0.5}, "skill_candidates": ["a", "b"]},
        {"type": "function_call", "tool": "read", "params": {"path": "p"}, "metadata": {"call_id": "c1"}, "id": "x"}, {"type": "tool_response", "call_id": "c1", "result": {"a": 1}, "status": True, "latency_ms": 7},
        {"type": "final", "text": "done", "step_id": "9"}, {"type": "odd", "step_id": 2.9},
    )
    assert [(r["step_id"], r["step_type"]) for r in got] == [(1, "reasoning"), (2, "skill_route"), (3, "tool_call"), (4, "tool_result"), (9, "output"), (2, "unknown")]
    assert got[0]["content"] == "hm" and (got[1]["skill_selected"], got[1]["routing_reason"], got[1]["routing_confidence"], got[1]["skill_candidates"]) == ("DocSkill", "r", 0.5, ["a", "b"])
    assert (got[2]["tool_name"], json.loads(got[2]["input_params"]), got[2]["call_id"]) == ("read", {"path": "p"}, "c1")
    assert (got[3]["call_id"], json.loads(got[3]["output"]), got[3]["status"], got[3]["latency_ms"]) == ("c1", {"a": 1}, "success", 7.0) and got[4]["content"] == "done"


def test_steps_that_cannot_be_read_are_left_out(spark):
    got = steps_of(spark, "text", 5, None, {"type": None}, {"type": 3}, {"type": "output", "step_id": None}, {"type": "output", "step_id": "abc"}, {"type": "output", "step_id": [1]}, {}, {"type": "output", "content": "ok"})
    assert [(r["pos"], r["step_id"], r["step_type"]) for r in got] == [(9, 9, "unknown"), (10, 10, "output")]


def test_errors_are_inferred(spark):
    cases = [
        ({"isError": True, "status": "success"}, "error", "inferred_error"), ({"is_error": True}, "error", "inferred_error"), ({"isError": "true", "output": "fine"}, "success", None),
        ({"error_message": "boom", "status": "pending"}, "error", "boom"), ({"status": "success", "output": "HTTP 429"}, "error", "inferred_error_from_text"),
        ({"status": "success", "output": "rate limit hit"}, "error", "inferred_error_from_text"), ({"status": "success", "output": "fine"}, "success", None), ({"status": "timeout", "output": "timed out"}, "timeout", None),
        ({"status": "error", "output": "x"}, "error", None), ({"status": None, "output": "fine"}, "pending", None), ({"status": "success", "error": " ", "output": "429"}, "success", " "), ({}, "success", None),
    ]
    got = steps_of(spark, *[{"type": "tool_result", **c} for c, _, _ in cases])
    assert [(r["status"], r["error"]) for r in got] == [(s, e) for _, s, e in cases]


def test_sessions_of_every_format(spark):
    docs = [
        {"session_id": "a", "trajectory": None, "user_input": {"raw": "", "text": "t"}, "session_outcome": {"status": "Success"}, "metadata": {"model_version": "m"}, "agent": "x"},
        {"session_id": "b", "trajectory": [], "user_input": "u", "session_outcome": "成功"}, {"session_id": "c", "trajectory": []}, {"trajectory": [], "user_input": "u"},
        {"log_lines": ["session_id: z", "user: move it", "tool_call: copy(a=1)", "final_output: all"]}, {"text": "user: only\n"}, {"text": "nothing"},
        {"query": "q", "messages": [{"role": "assistant", "content": "a"}, {"role": "tool", "content": "r", "tool_call_id": "k"}], "status": "failed"}, {"id": 5}, [1], "{", "7",
    ]
    sessions, steps = parse.parsed(records(spark, docs), ["n"])
    got = {r["n"]: (r["session_id"], r["user_input"], r["outcome"], r["agent"], r["format"]) for r in sessions.collect()}
    assert got[0] == ("a", "t", "success", "x", "structured") and got[1] == ("b", "u", "success", "unnamed", "structured") and got[4] == ("z", "move it", "likely_success", "unnamed", "unstructured")
    assert got[5][1:] == ("only", "likely_success", "unnamed", "unstructured") and got[5][0].startswith("unstructured_") and got[7][1:] == ("q", "failure", "unnamed", "lenient") and set(got) == {0, 1, 4, 5, 7}
    assert {(r["n"], r["step_id"], r["step_type"], r["tool_name"]) for r in steps.collect()} == {(4, 1, "tool_call", "copy"), (7, 1, "reasoning", None), (7, 2, "tool_result", None)}
    assert parse.parsed(records(spark, ["x"]), ["n"])[0].count() == 0


def test_warnings(spark):
    steps = [{"type": "tool_call", "call_id": "1"}, {"type": "tool_result", "call_id": "2"}, {"type": "output", "step_id": 5}]
    df = records(spark, [{"session_id": "s", "user_input": "u", "trajectory": steps}, {"session_id": "t", "user_input": "u", "trajectory": steps[:1] + [{"type": "tool_result", "call_id": "1"}]}])
    assert [tuple(r) for r in parse.step_warnings(parse.structured_steps(df, ["n"]), ["n"]).collect()] == [(0, True, ["1", "2"])]


def test_layouts(spark):
    own = [{"step_type": "output"}] * 2
    docs = [{"trajectory": own, "user_input": "a"}, {"trajectory": {"trajectory": own, "user_input": "b"}, "user_input": "x"}, {"trajectory": {"steps": own}, "user_input": "c"}, {"steps": own}, {"trajectory": {"steps": []}}, {}]
    got = records(spark, docs).select("n", F.size(parse.layout_steps(F.col("v"))).alias("k"), parse.layout_user_input(F.col("v")).alias("u")).orderBy("n").collect()
    assert [(r["k"], r["u"]) for r in got] == [(2, "a"), (2, "b"), (2, "c"), (2, ""), (0, ""), (0, "")]


def test_files_go_to_their_reader(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "a.jsonl").write_text('{"id": 1}\nbad\n\n{"id": 2}\n', "utf-8")
    (tmp_path / "in/b.ndjson").write_text('{"id": 3}', "utf-8")
    (tmp_path / "c.json").write_text('[{"id": 4}, {"id": 5}]', "utf-8")
    (tmp_path / "d.json").write_text('{"id": 6}\n{"id": 7}\n', "utf-8")
    (tmp_path / "e.json").write_text("{", "utf-8")
    (tmp_path / "f.log").write_text("session_id: a\nuser: x\nsession_id: b\n", "utf-8")
    (tmp_path / "g.txt").write_text('{"id": 9}', "utf-8")
    found = logs.session_records(spark, str(tmp_path))
    ids = [r[0] for r in found.select(F.try_variant_get("v", "$.id", "int").alias("i")).filter("i is not null").collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5, 6, 7] and found.filter(F.try_variant_get("v", "$.text", "string").startswith("session_id")).count() == 2
    assert {(r["file"].rsplit("/", 1)[1], r["json_parse_error"]) for r in logs.parse_errors(found).collect() if r["json_parse_error"]} == {("a.jsonl", 1), ("e.json", 1)}
    with pytest.warns(UserWarning, match="no such path"):
        assert logs.load_lines(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "none.jsonl")]).count() == 2
    with pytest.raises(FileNotFoundError):
        logs.load_lines(spark, [str(tmp_path / "none.jsonl")], strict=True)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        logs.load_lines(spark, [str(tmp_path / "a.jsonl")], strict=True).collect()


def test_outputs_and_manifest(spark, tmp_path):
    rows = spark.createDataFrame([(1, "sft_positive", False), (2, "rejected", False), (3, None, True), (4, "dpo_candidate", True)], "i int, bucket string, review boolean")
    sinks.write_outputs(rows, str(tmp_path / "o"), rejected=True)
    read = lambda p: sorted(r["i"] for r in spark.read.json(str(tmp_path / "o" / p)).collect())
    assert (read("buckets"), read("needs_review"), read("rejected")) == ([1, 4], [3, 4], [2])
    sinks.write_manifest(rows, str(tmp_path / "m"), "bucket", {"min_steps": 2}, {"total_raw": 9})
    m = json.loads(spark.read.text(str(tmp_path / "m")).first()[0])
    assert m["rows"] == 4 and m["files"]["rejected"] == 1 and m["stats"] == {"total_raw": 9} and m["config"] == {"min_steps": 2} and m["created_at"]
    cols = "pair_quality string, pair_type string, pair_construction string, preference_strength string, synthetic_rejected boolean, n int"
    both = "same_session_recovery_vs_synthetic_plain_retry"
    pairs = spark.createDataFrame([("high", "success_vs_failure_at_error", both, "strong", True, 1), ("high", "success_vs_failure_at_error", both, "medium", True, 2), ("high", "success_vs_failure_at_error", both, "medium", False, 3), ("medium", "quality_comparison", None, None, None, 4)], cols)
    talks = spark.createDataFrame([("a", [("system", "s"), ("user", "u")]), ("b", [("system", "s"), ("user", "u"), ("assistant", "x")])], "sid string, messages array<struct<role:string,content:string>>")
    sinks.write_training(pairs, talks, str(tmp_path / "t"))
    read = lambda p: spark.read.json(str(tmp_path / "t" / p)).collect()
    assert {(r["n"], r["loss_weight"]) for r in read("dpo_train_main")} == {(1, 1.0), (2, 0.5), (3, 1.0)} and [r["n"] for r in read("dpo_train_extended")] == [4] and [r["sid"] for r in read("sft_positive_with_trajectory")] == ["b"]


def test_conversations_have_a_system_a_user_and_an_end(spark):
    t = table(spark, {"s": [("reasoning", "a"), ("skill_route", "x"), (CALL, "doc", "{}"), OK, ("output", "b")], "quiet": [("reasoning", "[任务理解] x")]})
    sessions = spark.createDataFrame([("s", "ask", "f"), ("quiet", None, "the end"), ("mute", "u", "")], "sid string, user_input string, final_output string")
    rows = render.conversations(sessions, render.messages(t), "sys")
    got = {}
    for r in rows.orderBy("sid", "msg_no").collect():
        got.setdefault(r["sid"], []).append((r["role"], r["content"]))
    assert [x for x, _ in got["s"]] == ["system", "user", "assistant", "tool", "assistant"] and got["s"][1] == ("user", "ask") and '<skill_route skill="" confidence=""></skill_route>' in got["s"][2][1]
    assert got["quiet"] == [("system", "sys"), ("user", ""), ("assistant", "the end")] and got["mute"] == [("system", "sys"), ("user", "u")]
    assert {r["sid"]: len(r["messages"]) for r in samples.with_messages(sessions, rows).collect()} == {"s": 5, "quiet": 3, "mute": 2}
    whole = render.whole_texts(t, sessions.select("sid")).collect()
    assert [r["sid"] for r in whole] == ["s"] and whole[0]["text"].startswith("<thinking>") and whole[0]["text"].endswith("\nb")
