"""Retries, divergence, resolution, pairing and dedup on hand-made sessions."""

from pyspark.sql import functions as F

from tracewright.operators import facts, pairing, sequence, specialist

COLS = "step_row bigint, session_id string, session_key string, source string, step_id int, step_type string, ts string, content string, tool_name string, skill_context string, input_params string, call_id string, status string, output string, error string, latency_ms int, ingested_at timestamp, row string"


def table(spark, sessions):
    rows, n = [], 0
    for sid, steps in sessions.items():
        for i, s in enumerate(steps, 1):
            n += 1
            kind, rest = s[0], s[1:]
            own = {"step_type": kind}
            if kind == "tool_call":
                own |= {"tool_name": rest[0], "input_params": rest[1]}
            elif kind == "tool_result":
                own |= {"status": rest[0], "output": rest[1] if len(rest) > 1 else "fine"}
            else:
                own |= {"content": rest[0]}
            rows.append((n, sid, "k", "s", i, own["step_type"], None, own.get("content"), own.get("tool_name"), None, own.get("input_params"), None, own.get("status"), own.get("output"), None, None, None, "clash"))
    return spark.createDataFrame(rows, COLS)


CALL, BAD, OK = "tool_call", ("tool_result", "error", "HTTP 429"), ("tool_result", "success")


def test_retry_kinds(spark):
    sessions = {
        "backoff": [(CALL, "doc", '{"path": "a"}'), BAD, (CALL, "exec", '{"command": "sleep 5"}'), OK, (CALL, "doc", '{"path": "a"}'), OK],
        "adaptive": [(CALL, "doc", '{"path": "a"}'), BAD, (CALL, "doc", '{"path": "b"}'), OK],
        "plain": [(CALL, "doc", '{"path": "a", "call_id": "1"}'), BAD, (CALL, "doc", '{"path": "a", "call_id": "2"}'), OK],
        "loop": [(CALL, "doc", '{"path": "a"}'), BAD, (CALL, "doc", '{"path": "a"}'), BAD, (CALL, "doc", '{"path": "a"}'), BAD],
        "none": [(CALL, "doc", '{"path": "a"}'), BAD, ("output", "bye")],
        "intent": [(CALL, "doc", '{"path": "a"}'), BAD, ("reasoning", "I will retry this"), ("output", "done")],
    }
    f = facts.step_facts(table(spark, sessions))
    found = {(r["sid"], r["pos"]): r for r in sequence.retries(f).collect()}
    kind = lambda s, p=2: (found[s, p]["recovery_kind"], found[s, p]["resolved"], found[s, p]["retry_loop"], found[s, p]["intent_only"])
    assert kind("backoff") == ("backoff_retry", True, False, False)
    assert kind("adaptive") == ("adaptive_retry", True, False, False)
    assert kind("plain") == ("plain_retry", True, False, False)
    assert kind("loop") == ("plain_retry", False, True, False)
    assert kind("none") == ("no_retry", False, False, False)
    assert kind("intent") == ("no_retry", False, False, True)
    diverged = {r["sid"]: (r["pos"], r["priority"]) for r in sequence.diverge_points(sequence.retries(f)).collect()}
    assert diverged["intent"] == (2, 1) and diverged["backoff"] == (2, 2) and diverged["plain"] == (2, 4)
    assert diverged["loop"] == (6, 5)
    resolved = {(r["sid"], r["pos"]) for r in sequence.items_resolved(f).collect()}
    assert resolved == {("backoff", 2), ("plain", 2)}


def test_repeated_rows_are_one_step(spark):
    t = table(spark, {"S1 ": [(CALL, "doc", "{}"), OK]})
    twice = t.unionByName(t.withColumn("step_row", F.col("step_row") + 100))
    got = facts.step_facts(twice).orderBy("pos").collect()
    assert [(r["sid"], r["pos"], r["kind"]) for r in got] == [("s1", 1, "tool_call"), ("s1", 2, "tool_result")]
    assert facts.step_facts(t.filter("false")).count() == 0


def test_near_duplicate_groups_are_capped(spark):
    rows = [(1, "g", "high"), (2, "g", "high"), (3, "h", "medium"), (4, "h", "medium"), (5, "h", "medium"), (6, None, "low"), (7, None, "low")]
    df = spark.createDataFrame(rows, "pair_no int, grp string, pair_quality string")
    kept = pairing.capped_groups(df, "grp", [F.col("pair_no")])
    assert sorted(r["pair_no"] for r in kept.collect()) == [1, 3, 4, 6, 7]
    twice = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, "a", "x")], "n int, a string, b string")
    assert sorted(r["n"] for r in pairing.first_of_each(twice, ["a", "b"], "n").collect()) == [1, 3]


def test_band_join_equals_theta_join(spark):
    a = spark.createDataFrame([(i, i * 7) for i in range(60)], "i int, at bigint")
    b = spark.createDataFrame([(j, j * 11) for j in range(40)], "j int, bt bigint")
    got = {(r["i"], r["j"]) for r in specialist.band_join(a, b, "at", "bt", 20).collect()}
    assert got == {(i, j) for i in range(60) for j in range(40) if 0 <= j * 11 - i * 7 <= 20}


def test_retry_sequences(spark):
    ask = "please copy the quarterly report to the archive"
    scored = spark.createDataFrame(
        [("f", 1, "failure", ask), ("g", 2, "success", ask + " tonight"), ("late", 3, "success", ask), ("other", 4, "success", "完全不同"), ("early", 5, "success", ask)],
        "sid string, traj_id bigint, outcome string, user_input string",
    )
    m = 60_000_000
    us = spark.createDataFrame([(1, 100 * m), (2, 110 * m), (3, 116 * m), (4, 101 * m), (5, 99 * m)], "traj_id bigint, us bigint")
    errors = spark.createDataFrame([("f", "timeout")], "sid string, fail_reason string")
    got = specialist.retry_sequences(scored, us, errors).collect()
    assert [(r["failed_session"], r["success_session"], r["time_gap_sec"], r["fail_reason"], r["added_context"]) for r in got] == [("f", "g", 600, "timeout", "tonight")]


def test_crowded_blocks_give_the_same_pairs(spark):
    import random

    rng = random.Random(8)
    words = "copy the quarterly report to archive before friday and send it again with totals".split()
    rows = [(f"s{i}", i, rng.choice(["failure", "success"]), " ".join(rng.sample(words, rng.randrange(1, 9))) if i % 11 else "", rng.randrange(0, 40) * 60_000_000) for i in range(120)]
    scored = spark.createDataFrame([r[:4] for r in rows], "sid string, traj_id bigint, outcome string, user_input string")
    us = spark.createDataFrame([(r[1], r[4]) for r in rows], "traj_id bigint, us bigint")
    none = spark.createDataFrame([], "sid string, fail_reason string")
    got = [{(r["failed_session"], r["success_session"], r["input_similarity"]) for r in specialist.retry_sequences(scored, us, none, least=0.5, direct=d).collect()} for d in (10**6, 200, 0)]
    assert got[0] == got[1] == got[2] and len(got[0]) > 20


def sessions_at(spark, rows):
    """Scored sessions and their instants from rows of name, number, outcome, request and time."""
    scored = spark.createDataFrame([r[:4] for r in rows], "sid string, traj_id bigint, outcome string, user_input string")
    return scored, spark.createDataFrame([(r[1], r[4]) for r in rows], "traj_id bigint, us bigint"), spark.createDataFrame([], "sid string, fail_reason string")


def test_retries_equal_brute_force_on_odd_requests(spark):
    import random
    import re

    rng = random.Random(3)
    asks = [None, "", "a", "ab", "\u00a0x", "请把报告归档", "请把 报告\t归档了", "\U0001f600\U0001f601\U0001f600", "  copy  the\nreport ", "copy the report the the", "y" * 199 + "zq", "y" * 199 + "zw", "kopiere\u2003den Bericht"]
    m = 60_000_000
    rows = [(f"s{i}", i, rng.choice(["failure", "likely_success", "success", "partial"]), rng.choice(asks), rng.choice([-1, 1]) * rng.randrange(0, 40) * m) for i in range(150)]

    def brute():
        grams = lambda t: {t[:200][i : i + 2] for i in range(len(t[:200]) - 1)}
        words = lambda t: re.sub(r"[ \t\n\x0b\f\r]+", " ", t).strip(" ").split(" ")
        for f, fi, fo, fa, fu in rows:
            for g, gi, go, ga, gu in rows:
                a, b = grams(fa or ""), grams(ga or "")
                if fo == "failure" and go in ("success", "likely_success") and 0 <= gu - fu <= 15 * m and (gu > fu or gi > fi) and a and b and len(a & b) / len(a | b) >= 0.3:
                    yield f, g, (gu - fu) // 1_000_000, int(len(a & b) / len(a | b) * 1000 + 0.5) / 1000, " ".join([w for w in words(ga) if w not in words(fa)][:30])

    want = sorted(brute())
    for direct in (10**6, 30):
        found = specialist.retry_sequences(*sessions_at(spark, rows), direct=direct).collect()
        assert sorted((r["failed_session"], r["success_session"], r["time_gap_sec"], r["input_similarity"], r["added_context"]) for r in found) == want
    assert len(want) > 30


def test_a_crowded_day_of_like_requests_ends(spark):
    """1,440,000 pairs that are all alike: sessions are compared once, and not by each pair of characters they share."""
    import random
    import threading

    rng = random.Random(4)
    words = "copy the quarterly report to archive before friday and send it again with totals for review by every regional office".split()
    rows = [(f"s{i}", i, "success" if i % 2 else "failure", " ".join(rng.sample(words, 18)), i // 2 * 1_000 if i % 2 == 0 else 10**9 + i) for i in range(2400)]
    scored, us, none = sessions_at(spark, rows)
    ending = threading.Timer(90, spark.sparkContext.cancelAllJobs)
    ending.start()
    try:
        found = specialist.retry_sequences(scored, us, none, minutes=1440).agg(F.count("*"), F.countDistinct("failed_session", "success_session")).first()
    finally:
        ending.cancel()
    assert tuple(found) == (1_440_000, 1_440_000)


def test_counting_the_data_sets_of_a_crowded_day_ends(spark):
    import threading

    like = "copy the quarterly report to archive before friday and send it again with totals"
    rows = [(f"s{i}", i, "success" if i % 2 else "failure", f"{like} {i}", 10**9 * (i % 2) + i) for i in range(2400)]
    scored, us, _ = sessions_at(spark, rows)
    own = facts.step_facts(table(spark, {"s0": [(CALL, "doc", "{}"), BAD]}))
    ending = threading.Timer(90, spark.sparkContext.cancelAllJobs)
    ending.start()
    try:
        found = specialist.run_all(own, scored, None, us, ("error_taxonomy", "retry_sequences"), minutes=1440)
        counts = {name: df.count() for name, df in found.items()}
        told = {r["fail_reason"]: r["count"] for r in found["retry_sequences"].groupBy("fail_reason").count().collect()}
    finally:
        ending.cancel()
    assert counts == {"error_taxonomy": 1, "retry_sequences": 1_440_000}
    assert sorted(told.values()) == [1_200, 1_438_800] and told["unknown"] == 1_438_800


def test_abort_reasons(spark):
    texts = ["超出范围", "please confirm, waiting", "do it in a batch", "I must WAIT", "bye"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(specialist.abort_reason(F.col("t"))).collect()]
    assert got == ["scope_exceeded", "needs_confirmation", "data_too_large", "waiting_for_resource", "other"]


def test_an_item_is_all_its_parameters(spark):
    def after(failed, later):
        return [(CALL, "doc", failed), BAD, ("reasoning", "hm"), (CALL, "browser", later), OK]

    sessions = {
        "other key": after('{"url": "u"}', '{"url": "u", "path": "x"}'),
        "other block": after('{"path": "a", "block_id": "1"}', '{"path": "a", "block_id": "2"}'),
        "both": after('{"path": "a", "block_id": "1"}', '{"block_id": "1", "path": "a"}'),
        "one lacks": after('{"path": "a", "page_id": "1"}', '{"path": "a"}'),
        "null is none": after('{"path": "a", "page_id": null}', '{"path": "a"}'),
        "only null": after('{"file_id": null}', '{"query": "q"}'),
        "null is not a value": after('{"file_id": null}', '{"file_id": "f"}'),
        "no item": after('{"query": "q"}', '{"query": "q"}'),
    }
    got = {r["sid"] for r in sequence.items_resolved(facts.step_facts(table(spark, sessions))).collect()}
    assert got == {"other key", "both", "null is none", "only null"}
