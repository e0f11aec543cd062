import random

import numpy as np

from tracewright.llm import truncation as T

WORDS = "the table holds rows and lag is back at a new value while the report waits for another list from the router".split()


def sentence(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randrange(6, 14))).capitalize() + "."


def corpus(seed=1, limit=200):
    rng = random.Random(seed)
    rows, cut = [], set()
    for i in range(900):
        text = " ".join(sentence(rng) for _ in range(rng.randrange(1, 7)))
        if i % 9 == 0:
            text += "\n- notes/list.csv"
        source = "abc"[i % 3]
        if source == "a" and len(text) > limit:
            text, _ = text[:limit], cut.add(i)
        if source == "b" and i % 40 == 1 and len(text) > 60:
            text, _ = text[: rng.randrange(30, len(text) - 8)], cut.add(i)
        rows.append(("f", i, source, text))
    return rows, cut


def judged(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "field_name string, row_id bigint, source string, text string, chars int, ending string")
    return T.judged(df)


def test_limits_and_transfer_cuts(spark):
    rows, cut = corpus()
    j = judged(spark, rows)
    got = {r["row_id"] for r in T.cut_values(j).collect()}
    # A cut that happens to fall on a full stop cannot be told in transfer.
    text = {r[1]: r[3] for r in rows}
    assert got <= cut and {i for i in cut - got if not text[i].endswith(".")} == set()
    report = {(r["source"]): r["cut_at_limit"] for r in T.cut_report(j).collect()}
    assert report["a"] > 50 and report["b"] == report["c"] == 0


def test_marks_and_open_forms(spark):
    rows, _ = corpus()
    extra = ["The table hol… (+29 chars)", "The table [cut]", "The table hold<truncated>", "The rep…", '{"rows": [{"id": 1}, {"id', "Done.\n```\nsort --in a", "I saved it as notes/fold_re", "请核对双语的合同。把两份报�"]
    whole = ['{"rows": [1, 2]}', "All is done.", "Done.\n```\nsort --in a\n```", "", None, "   "]
    found = {r["row_id"] for r in T.cut_values(judged(spark, rows + [("f", 5000 + i, "c", t) for i, t in enumerate(extra + whole)])).collect()}
    assert {i for i in found if i >= 5000} == {5000 + i for i in range(len(extra))}


def test_byte_limits(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        text = "。".join("".join(rng.choice("把两份报表导出成附件核对合同") for _ in range(rng.randrange(8, 20))) for _ in range(rng.randrange(1, 9))) + "。"
        raw = text.encode()
        rows.append(("f", i, "z", raw[:240].decode("utf-8", "replace") if len(raw) > 240 else text))
    found = {r["row_id"] for r in T.cut_values(judged(spark, rows)).collect()}
    want = {r[1] for r in rows if len(r[3].rstrip("�").encode()) > 236 and not r[3].endswith("。")}
    assert want <= found


def test_censored_fit_recovers_the_law():
    rng = np.random.default_rng(0)
    x = np.round(np.exp(rng.normal(5.0, 0.6, 20_000)))
    x[x > 200] = 200
    lengths, counts = np.unique(x, return_counts=True)
    mu, sd = T.fit_censored(lengths, counts, 200)
    assert abs(mu - 5.0) < 0.05 and abs(sd - 0.6) < 0.05
    assert T.find_limits(lengths.astype(int), counts, counts)[0][0] == 200
    free, n = np.unique(np.round(np.exp(rng.normal(4.0, 0.6, 5000))), return_counts=True)
    assert T.find_limits(free.astype(int), n, n) == []


def test_edges(spark):
    assert judged(spark, []).count() == 0
    assert judged(spark, [("f", 1, None, "Hello there."), ("f", 1, None, "Hello there."), ("f", 2, "a", "x" * 400_000 + ".")]).count() == 3


def test_a_limit_that_was_raised_and_a_very_short_one(spark):
    rng = random.Random(4)
    rows, cut = [], set()
    for i in range(1500):
        text = " ".join(sentence(rng) for _ in range(rng.randrange(1, 9)))
        limit = 160 if i < 700 else 320
        if i % 2 == 0 and len(text) > limit:
            text, _ = text[:limit], cut.add(i)
        rows.append(("f", i, "ab"[i % 2], text))
    for i in range(1500, 1900):
        text = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 30)))
        rows.append(("g", i, "a", text[:12]))
    found = {(r["field_name"], r["source"]): sorted(x["at"] for x in r["limits"]) for r in T.limits(T.describe(spark.createDataFrame(rows, "field_name string, row_id bigint, source string, text string"))).collect()}
    assert found == {("f", "a"): [160, 320], ("g", "a"): [12]}
    got = {r["row_id"] for r in T.cut_values(judged(spark, rows[:1500])).collect()}
    assert len(got & cut) > 0.97 * len(cut) and len(got - cut) < 0.02 * len(cut)


def test_repeated_texts_make_no_limit(spark):
    rows = [("f", i, "a", "ok") for i in range(300)] + [("f", 300 + i, "a", "x") for i in range(10)]
    assert T.limits(T.describe(spark.createDataFrame(rows, "field_name string, row_id bigint, source string, text string"))).count() == 0
