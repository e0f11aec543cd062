import json

from tracewright.llm import conversations as C

EVENTS = "event_row bigint, session_id string, trace_id string, seq bigint, source_seq bigint, event_type string, data string, ingested_at timestamp, conv string, role string, run string"
STEPS = "step_row bigint, session_id string, step_id int, step_type string, content string, tool_name string, call_id string, output string, error string, conv string, kind string"


def user(t="hi"):
    return "prompt.submitted", json.dumps({"prompt": t})


def bot(*t):
    return "model.completed", json.dumps({"assistantTexts": list(t)})


def events(spark, sessions):
    rows = []
    for sid, evs in sessions.items():
        for i, e in enumerate(evs):
            no, (kind, data) = e if isinstance(e[1], tuple) else (i + 1, e)
            rows.append((len(rows), sid, "t", no, None, kind, data, None, "x", "y", "z"))
    return spark.createDataFrame(rows, EVENTS)


def defects(spark, sessions):
    return {r["conv"]: r["defect"] for r in C.event_defects(C.event_turns(events(spark, sessions))).collect()}


def test_each_rule(spark):
    got = defects(
        spark,
        {
            "good": [user(), bot("a"), bot("b")],
            "twice": [(1, user()), (1, user()), (2, bot("a"))],
            "clash": [(1, user()), (1, user("other")), (2, bot("a"))],
            "damaged": [user(), ("model.completed", '{"assistantTexts": ["a"],,}')],
            "trailing": [user(), ("model.completed", '{"assistantTexts": ["a"]} x')],
            "empty": [("session.started", "{}"), user("  "), bot("<thinking>hm</thinking> ")],
            "gap": [(1, user()), (3, bot("a"))],
            "bot first": [bot("a"), user(), bot("b")],
            "unanswered": [user(), user(), bot("a")],
            "open end": [user(), bot("a"), user()],
            "last text counts": [user(), bot("a", "<thinking>x</thinking>")],
            "null data": [user(), ("session.ended", None), bot("a")],
        },
    )
    assert got == {
        "clash": "broken", "damaged": "broken", "trailing": "broken", "empty": "empty", "gap": "broken", "bot first": "broken", "unanswered": "missing_reply",
        "open end": "missing_reply", "last text counts": "missing_reply",
    }


def test_long_conversations_are_judged_in_runs(spark, monkeypatch):
    monkeypatch.setattr(C, "RUN", 4)
    long = [user() if i % 2 == 0 else bot("a") for i in range(40)]
    broken = long[:22] + [user(), user()] + long[24:]
    quiet = [user()] + [("session.started", "{}")] * 20 + [user(), bot("a")]
    assert defects(spark, {"long": long, "broken": broken, "quiet": quiet}) == {"broken": "missing_reply", "quiet": "missing_reply"}
    turns = C.rebuilt(events(spark, {"long": long, "broken": broken})).orderBy("turn_no").collect()
    assert [(r["session_id"], r["turn_no"], r["role"]) for r in turns] == [("long", i + 1, "user" if i % 2 == 0 else "assistant") for i in range(40)]


def test_keys_and_empty_tables(spark):
    rows = [(1, None, "t1", 1, None, *user(), None, "", "", ""), (2, " ", "t1", None, 2, *bot("a"), None, "", "", ""), (3, None, None, 1, None, *user(), None, "", "", ""), (4, "n", None, None, None, *user(), None, "", "", "")]
    assert C.event_defects(C.event_turns(spark.createDataFrame(rows, EVENTS))).collect() == []
    none, steps = spark.createDataFrame([], EVENTS), spark.createDataFrame([], STEPS)
    assert C.left_out(none, steps).count() == 0 and C.rebuilt(none).count() == 0


def test_very_long_text(spark):
    assert defects(spark, {"long": [user("x" * 2_000_000), bot("<thinking>" + "y" * 500_000 + "</thinking>z")]}) == {}


def test_step_rules(spark):
    def rows(sid, steps):
        return [(i, sid, s.get("no", i + 1), s.get("t"), s.get("c"), s.get("tool"), s.get("id"), s.get("o"), s.get("e"), "x", "y") for i, s in enumerate(steps)]

    call, result, out = {"t": "Tool_Call ", "tool": "x", "id": "1"}, {"t": "function_result", "id": "1", "o": "ok"}, {"t": "final", "c": "done"}
    sessions = {
        "good": [call, result, out], "repeat": [call, result, out | {"no": 3}, out | {"no": 3}], "clash": [call, result, out | {"no": 3}, out | {"no": 3, "c": "other"}],
        "empty": [{"t": "tool_call"}, {"t": "memo", "c": "  "}], "gap": [call, result, out | {"no": 5}], "unpaired": [call, result | {"id": "2"}, out], "late": [call, out, result],
        "blank": [call, result, out | {"c": " "}], "no calls": [{"t": "thought", "c": "hm"}, out],
    }
    df = spark.createDataFrame([r for s, x in sessions.items() for r in rows(s, x)], STEPS)
    got = {r["conv"]: r["defect"] for r in C.step_defects(df).collect()}
    assert got == {"clash": "broken", "empty": "empty", "gap": "broken", "unpaired": "broken", "late": "missing_reply", "blank": "missing_reply"}


def test_sessions_by_silence(spark):
    h = 3_600_000_000
    at = [0, 1, 2, 3, 30 * h, 30 * h + 5, 100 * h, 100 * h]
    rows = spark.createDataFrame([(i, "c", t) for i, t in enumerate(at)] + [(99, None, 1), (98, "c", None)], "row bigint, channel string, us bigint")
    got = {r["row"]: r["session_no"] for r in C.sessionize(rows).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3, 7: 3}
    assert C.sessionize(rows.filter("false")).count() == 0


def test_conversations_of_steps_are_rebuilt(spark):
    cols = "session_id string, step_id int, step_type string, content string, tool_name string, skill_context string, input_params string, call_id string, output string, error string"
    rows = [
        ("S1 ", 4, "final", "done", None, None, None, None, None, None), ("S1 ", 2, "Tool_Call ", None, "read", None, '{"path": "p"}', "c", None, None),
        ("S1 ", 3, "function_result", None, None, None, None, "c", "ok", None), ("S1 ", 1, "route", "to files", None, "FileSkill", None, None, None, None),
        ("S1 ", 1, "route", "to files", None, "FileSkill", None, None, None, None), ("bad", 2, "output", "x", None, None, None, None, None, None),
    ]
    asked = spark.createDataFrame([(1, "s1", "  "), (3, "S1", "again"), (2, "s1", "do it"), (4, "bad", "hm")], "traj_id bigint, session_id string, user_input string")
    got = C.rebuilt(events(spark, {"e": [user(), bot("a")]}), spark.createDataFrame(rows, cols), asked)
    assert sorted(tuple(r) for r in got.collect()) == [
        ("raw_events", "e", 1, "user", "hi"), ("raw_events", "e", 2, "assistant", "a"),
        ("steps", "S1 ", 1, "user", "do it"), ("steps", "S1 ", 2, "system", "to files"), ("steps", "S1 ", 3, "assistant", 'read {"path": "p"}'),
        ("steps", "S1 ", 4, "tool", "ok"), ("steps", "S1 ", 5, "assistant", "done"),
    ]


def test_sessions_by_silence_have_roles_and_a_reply(spark):
    cols = "event_row bigint, session_id string, trace_id string, seq bigint, source_seq bigint, event_type string, data string, ts string, session_key string, ingested_at int"
    at = [(1, 0, user()), (2, 1, bot("a")), (3, 1, bot("a")), (4, 2, ("session.ended", "{}")), (5, 300, bot("late")), (6, 301, user()), (7, 900, user("again")), (8, 901, bot(" b "))]
    rows = [(n, None, None, None, None, *e, f"2025-09-{1 + m // 100:02d}T00:{m % 100:02d}:00Z", "c", n) for n, m, e in at]
    got = C.by_silence(spark.createDataFrame(rows, cols), 3_600_000_000).collect()
    assert sorted((r["row"], r["session_no"], r["role"], r["text"]) for r in got) == [(1, 1, "user", "hi"), (2, 1, "assistant", "a"), (7, 3, "user", "again"), (8, 3, "assistant", "b")]


def test_rows_without_a_name_are_parted_by_silence(spark):
    cols = "event_row bigint, session_id string, trace_id string, seq bigint, source_seq bigint, event_type string, data string, ts string, session_key string, ingested_at int"
    at = [(1, 0, user(), None), (2, 1, bot("a"), None), (3, 1, bot("a"), None), (4, 300, user("left"), None), (5, 600, user("again"), " "), (6, 601, bot(" b "), None)]
    named = [(10 + i, 4 + i, e, "n") for i, e in enumerate([user(), bot("c")])]
    rows = [(n, s, None, n if s == "n" else None, None, *e, f"2025-09-{1 + m // 100:02d}T00:{m % 100:02d}:00Z", "c", n) for n, m, e, s in at + named] + [(99, None, None, 1, None, *user(), None, "c", 1)]
    df = spark.createDataFrame(rows, cols)
    got = C.rebuilt(df, None, None).collect()
    parted = C.rebuilt(df).filter("session_id like 'silence:%'").collect()
    assert {(r["session_id"], r["role"], r["text"]) for r in parted} == {("silence:c:1", "user", "hi"), ("silence:c:1", "assistant", "a"), ("silence:c:3", "user", "again"), ("silence:c:3", "assistant", "b")}
    assert {(r["session_id"], r["text"]) for r in got if not r["session_id"].startswith("silence")} == {("n", "hi"), ("n", "c")}
    steps = spark.createDataFrame([], STEPS)
    assert {(r["session_id"], r["defect"]) for r in C.left_out(df, steps).collect()} == {("silence:c:2", "missing_reply")}


def test_agreement_with_written_sessions(spark):
    cols = "event_row bigint, session_id string, trace_id string, seq bigint, source_seq bigint, event_type string, data string, ts string, session_key string, ingested_at int"
    at = [(1, 0, "a"), (2, 1, "a"), (3, 500, "b"), (4, 501, "b"), (5, 502, "x"), (6, 900, "d")]
    rows = [(n, s, None, n, None, *user(str(n)), f"2025-09-{1 + m // 100:02d}T00:{m % 100:02d}:00Z", "c", n) for n, m, s in at]
    assert tuple(C.agreement(spark.createDataFrame(rows, cols), 3_600_000_000).first()) == (3_600_000_000, 4, 3, 2)
