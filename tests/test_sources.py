import json

from pyspark.sql import functions as F

from tracewright.sources import companion, logs, sinks
from tracewright.streaming.errors import windowed_errors


def test_event_log_skips_bad_lines_and_recurses(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/run-1.trajectory.jsonl").write_text('{"sessionId": "s", "seq": 2, "type": "x", "data": {"prompt": "p"}}\n\nnot json\n', "utf-8")
    (tmp_path / "other.txt").write_text('{"sessionId": "t"}', "utf-8")
    rows = logs.event_log(spark, str(tmp_path)).collect()
    assert [(r["session_id"], r["seq"], json.loads(r["data"])) for r in rows] == [("s", 2, {"prompt": "p"})]


def test_documents_and_text_logs(spark, tmp_path):
    (tmp_path / "l.json").write_text('[{"id": 1}, {"id": 2}]', "utf-8")
    (tmp_path / "d.json").write_text('{\n"id": 3}', "utf-8")
    (tmp_path / "x.json").write_text("{", "utf-8")
    ids = logs.json_documents(spark, str(tmp_path)).select(F.try_variant_get("v", "$.id", "int").alias("id"))
    assert sorted(r["id"] for r in ids.collect()) == [1, 2, 3]
    (tmp_path / "t.log").write_text("head\nsession_id: a\nuser: x\nSession-ID: b\n", "utf-8")
    assert [r["text"].strip() for r in logs.text_logs(spark, str(tmp_path)).orderBy("chunk").collect()] == ["head", "session_id: a\nuser: x", "Session-ID: b"]


def test_formats(spark):
    docs = ['{"trajectory": null, "text": "x"}', '{"log_lines": []}', '{"query": "q"}', "[1]"]
    got = spark.createDataFrame([(d,) for d in docs], "d string").select(logs.session_format(F.try_parse_json("d"))).collect()
    assert [r[0] for r in got] == ["structured", "unstructured", "lenient", None]


def test_text_session(spark):
    t = "session_id: s9\nuser: move it\ntool_call: copy(a=1, b='two', a=3)\nfinal_output: all\ndone\n\nrest"
    r = spark.createDataFrame([(t,), ("nothing",)], "t string").select(logs.parse_text_session(F.col("t")).alias("s")).collect()
    s = r[0]["s"]
    assert (s["session_id"], s["user_input"], s["final_output"], s["outcome"]) == ("s9", "move it", "all\ndone", "likely_success")
    assert s["steps"][0]["tool_name"] == "copy" and s["steps"][0]["input_params"] == {"a": "3", "b": "two"}
    assert r[1]["s"] is None


def test_lenient_session(spark):
    d = {"query": "", "prompt": "p", "id": "7", "response": "r", "status": "ok", "messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}, {"role": "tool", "content": "t", "tool_call_id": "c"}]}
    rows = spark.createDataFrame([(json.dumps(d),), ("{}",)], "d string").select(logs.parse_lenient_session(F.try_parse_json("d")).alias("s")).collect()
    s = rows[0]["s"]
    assert (s["session_id"], s["user_input"], s["final_output"], s["outcome"]) == ("7", "p", "r", "ok")
    assert [(x["step_id"], x["step_type"], x["content"], x["output"], x["call_id"]) for x in s["steps"]] == [(2, "reasoning", "a", None, None), (3, "tool_result", None, "t", "c")]
    assert rows[1]["s"] is None


def test_companion(spark, tmp_path):
    base = "session-0001"
    part = lambda *p: json.dumps({"type": "message", "message": {"role": "assistant", "content": list(p)}})
    lines = [
        part({"type": "toolCall", "id": "c1", "name": "read", "input": {"p": 1}}, {"type": "thinking", "thinking": "hm"}),
        part({"type": "tool_use", "callId": "c2", "name": "write", "arguments": {"q": 2}}, {"type": "text", "text": "so"}),
        part({"type": "toolCall", "id": "c1", "name": "read", "input": {"p": 9}}),
        json.dumps({"type": "message", "message": {"role": "toolResult", "toolCallId": "c1", "content": [{"type": "text", "text": "HTTP 429"}, {"type": "toolResult", "content": [{"text": "x"}]}]}}),
        "junk",
    ]
    (tmp_path / f"{base}.jsonl.deleted.1").write_text("\n".join(lines), "utf-8")
    names = [f"/d/{base}.trajectory.jsonl", f"/d/{base}.jsonl.deleted.1", "/d/short.trajectory.jsonl", "/d/short.jsonl", f"/e/{base}.jsonl"]
    files = spark.createDataFrame([(n,) for n in names], "file string")
    assert [tuple(r) for r in companion.companion_files(files).collect()] == [(names[0], names[1])]
    uses, results, thoughts = companion.companion_parts(spark, str(tmp_path))
    assert sorted((r["call_id"], r["name"], json.loads(r["input"])["p" if r["name"] == "read" else "q"]) for r in uses.collect()) == [("c1", "read", 9), ("c2", "write", 2)]
    assert [(r["call_id"], r["content"], r["is_error"]) for r in results.collect()] == [("c1", "HTTP 429\nx", True)]
    assert [r["text"] for r in thoughts.orderBy("at").collect()] == ["hm", "so"]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", [1, 2], "h"), (2, "b", [1], "h"), (3, None, [1, 2, 3], "h")], "i int, bucket string, steps array<int>, _hidden string")
    sinks.write_buckets(rows, str(tmp_path / "out"), "bucket")
    back = spark.read.json(str(tmp_path / "out"))
    assert {(r["i"], r["bucket"]) for r in back.collect()} == {(1, "a"), (2, "b")} and "_hidden" not in back.columns
    sinks.write_sessions(rows, str(tmp_path / "s"))
    assert sorted(r["i"] for r in spark.read.json(str(tmp_path / "s")).collect()) == [1, 3]
    sinks.write_array(rows.select("i", "bucket").orderBy("i"), str(tmp_path / "a.json"))
    assert json.loads((tmp_path / "a.json").read_text("utf-8"))[2] == {"i": 3, "bucket": None}
    assert {(r["bucket"], r["rows"]) for r in sinks.manifest(rows, "bucket", {"x": 1}).collect()} == {("a", 1), ("b", 1), (None, 1)}
    both = logs.union_sources({"x": rows.select("i"), "rejected": rows.select("bucket")})
    assert both.filter("is_rejected").count() == 3 and both.count() == 6


def test_stream_counts_like_batch(spark, data, tmp_path):
    steps = spark.read.parquet(f"{data}/steps.parquet")
    batch = {tuple(r) for r in windowed_errors(steps).collect()}
    (tmp_path / "in").mkdir()
    steps.write.parquet(str(tmp_path / "in/p"))
    stream = spark.readStream.schema(steps.schema).parquet(str(tmp_path / "in/p"))
    q = windowed_errors(stream, late="400 days").writeStream.format("memory").queryName("errors").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.table("errors").collect()} == batch
