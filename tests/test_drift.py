import json

import numpy as np

from pyspark.sql import functions as F

from tracewright.operators import schema_drift as S


def lines(spark, files):
    rows, n = [], 0
    for (feed, no), records in files.items():
        for i, r in enumerate(records):
            n += 1
            rows.append((n, feed, no, i, r if isinstance(r, (str, type(None))) else json.dumps(r), "clash", 7))
    return spark.createDataFrame(rows, "record_no bigint, feed string, file_no int, line_no int, record string, kinds string, what int")


def steps(kind="step_type", n=3, text="content"):
    return [{"step_id": i, kind: "reasoning", text: f"first copy the quarterly report number {i} over to the archive"} for i in range(n)]


def changes(spark, files):
    return {tuple(r)[:5] for r in S.drift(lines(spark, files)).collect()}


def test_each_kind_of_change(spark):
    a = [{"session_id": f"s{i}", "outcome": "success", "cost": 4, "trajectory": steps(), "tag": "x"} for i in range(4)]
    b = [{"session_id": f"s{i}", "final_status": "success", "cost": "4", "step_log": steps(), "region": "r1"} for i in range(4)]
    c = [{"session_id": f"s{i}", "final_status": "success", "cost": "4", "step_log": json.dumps(steps("kind")), "region": "r1"} for i in range(4)]
    got = changes(spark, {("f", 1): a, ("f", 3): b, ("f", 4): c, ("g", 1): c})
    assert got == {
        ("f", 3, "outcome", "renamed", "final_status"), ("f", 3, "trajectory", "renamed", "step_log"), ("f", 3, "cost", "type_changed", ""),
        ("f", 3, "tag", "removed", ""), ("f", 3, "region", "added", ""), ("f", 4, "step_log", "type_changed", ""), ("f", 4, "step.step_type", "renamed", "step.kind"),
    }


def test_unreadable_null_and_repeated_lines_change_nothing(spark):
    r = {"session_id": "s", "note": None, "trajectory": steps()}
    files = {("f", 1): [r, r, "### rotated", "", None, "[1]", "5"], ("f", 2): [{"trajectory": {"steps": steps()}, "note": None, "session_id": "t"}]}
    assert changes(spark, files) == {("f", 2, "trajectory", "type_changed", "")}
    assert changes(spark, {("f", 1): [r], ("f", 2): ["x"]}) == {("f", 2, p, "removed", "") for p in ("session_id", "note", "trajectory", "step.step_id", "step.step_type", "step.content")}
    assert S.drift(lines(spark, {("f", 1): [r]}).filter("false")).count() == 0


def test_very_long_values_and_keys(spark):
    r = {"session_id": "s", "text": "word " * 200_000, "k" * 500: 1}
    assert changes(spark, {("f", 1): [r], ("f", 2): [r | {"more": True}]}) == {("f", 2, "more", "added", "")}


def test_flooding_settles_and_prefers_the_right_pair():
    key = lambda name, sketch, kinds=("string",): {"path": name, "level": "", "name": name, "kinds": list(kinds), "sketch": np.array([sketch.get(str(i), 0) for i in range(S.WIDTH + 2)]), "nested": set()}
    old = [key("created_at", {"1": 9, "2": 9}), key("agent", {"5": 4})]
    new = [key("started", {"1": 8, "2": 9}), key("createdBy", {"7": 3})]
    score, seed = S.flood(old, new)
    assert score[0, 0] == score.max() and seed[0, 0] > seed[0, 1]
    assert S.changes_between(old, new)[0] == ("created_at", "renamed", "started")


def test_unified_table_is_typed_and_loses_nothing(spark):
    a = [{"session_id": f"s{i}", "outcome": "success", "cost": 4, "Cost": "x", "rest": 1, "trajectory": steps()} for i in range(3)]
    b = [{"session_id": f"t{i}", "final_status": "success", "cost": ["much", "5", 5][i], "step_log": json.dumps(steps("kind"))} for i in range(3)]
    df = S.unified(lines(spark, {("f", 1): a, ("f", 2): b}))
    rows = {r["record_no"]: r for r in df.collect()}
    types = dict(df.dtypes)
    assert len(rows) == 6 and types["cost"] == "double" and types["final_status"] == "string" and "outcome" not in types and {"Cost_2", "rest_2"} <= set(types)
    assert [rows[i]["final_status"] for i in range(1, 7)] == ["success"] * 6 and [rows[i]["cost"] for i in range(1, 7)] == [4.0, 4.0, 4.0, None, 5.0, 5.0]
    assert rows[4]["rest"] == {"cost": "much"} and rows[1]["rest"] == {} and rows[1]["Cost_2"] == "x"
    assert [[s["kind"] for s in rows[i]["steps"]] for i in (1, 6)] == [["reasoning"] * 3] * 2 and rows[6]["steps"][2]["step_id"] == 2.0
    few = {r["record_no"]: r for r in S.unified(lines(spark, {("f", 1): a, ("f", 2): b}), most=2).collect()}
    assert few[1]["rest"]["session_id"] == "s0" and few[4]["rest"]["cost"] == "much" and few[2]["rest"]["step.2.step_id"] == "1"
    assert S.unified(lines(spark, {("f", 1): a}).filter("false")).count() == 0


def test_a_rename_in_one_feed_leaves_the_others_alone(spark):
    a = [{"session_id": f"s{i}", "outcome": "success", "trajectory": steps()} for i in range(3)]
    b = [{"session_id": f"s{i}", "final_status": "success", "trajectory": steps()} for i in range(3)]
    c = [{"session_id": f"s{i}", "final_status": f"state {i}", "outcome": "success", "trajectory": steps()} for i in range(3)]
    rows = [r.asDict() for r in S.unified(lines(spark, {("f", 0): a, ("f", 1): a, ("f", 2): b, ("g", 1): c})).collect()]
    assert all(r["outcome"] == "success" for r in rows) and [r["final_status"] for r in rows if r["feed"] == "g"] == ["state 0", "state 1", "state 2"]


def test_a_rename_may_change_the_type(spark):
    a = [{"session_id": f"s{i}", "latency_ms": 100 + i, "trajectory": steps()} for i in range(4)]
    b = [{"session_id": f"s{i}", "latencyMs": str(100 + i), "trajectory": steps()} for i in range(4)]
    assert changes(spark, {("f", 1): a, ("f", 2): b}) == {("f", 2, "latency_ms", "renamed", "latencyMs")}


def test_whole_table_against_plain_rules(spark, data):
    """No change is reported twice, and what is added or removed really is absent on the other side."""
    found = S.drift(spark.read.parquet(f"{data}/session_files.parquet")).cache()
    assert found.count() == found.distinct().count()
    keys = S.profiles(spark.read.parquet(f"{data}/session_files.parquet")).select("feed", "file_no", "field_path")
    gained = found.filter(F.col("change_kind").isin("added", "type_changed")).select("feed", "file_no", "field_path")
    assert gained.join(keys, ["feed", "file_no", "field_path"], "left_anti").count() == 0
