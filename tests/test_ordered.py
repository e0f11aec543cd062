import random

from pyspark.sql import functions as F

from tracewright.operators import ordered


def test_positions_sums_and_changes_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RUN", 4)
    rng = random.Random(1)
    rows = [(k, rng.randrange(-5, 60), i, rng.choice(["x", "y", None])) for i, k in enumerate(rng.choice("aab") for _ in range(120))]
    df = spark.createDataFrame(rows, "k string, n int, row int, v string")
    placed = ordered.with_position(df, "k", "n", "row")
    summed = ordered.with_running_sum(placed, "k", "pos", F.when(F.col("v") == "x", 1).otherwise(0), "xs")
    got = {(r["k"], r["row"]): (r["pos"], r["xs"]) for r in summed.collect()}
    turns = {r["k"]: r["c"] for r in ordered.changes(placed, "k", "pos", "v", "c").collect()}
    for key in "ab":
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        xs = 0
        for i, r in enumerate(own, 1):
            xs += r[3] == "x"
            assert got[key, r[2]] == (i, xs)
        vs = [r[3] for r in own if r[3]]
        assert turns[key] == sum(a != b for a, b in zip(vs, vs[1:], strict=False))


def test_look_around_keeps_rows_without_neighbours(spark):
    steps = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("a", 4, "r"), ("b", 1, "s")], "k string, pos bigint, v string")
    near = ordered.look_around(steps.filter("v in ('q', 's')"), steps, "k", "pos", -1, 2, ["v"])
    assert {r["v"]: [(x["at"], x["v"]) for x in r["near"]] for r in near.collect()} == {"q": [(-1, "p"), (0, "q"), (2, "r")], "s": [(0, "s")]}
    assert ordered.look_around(steps.filter("v = 's'"), steps.filter("false"), "k", "pos", 1, 2, ["v"]).first()["near"] == []


def test_lookup_join_splits_hot_keys(spark):
    from tracewright.sources import lookup_join

    rows = spark.createDataFrame([("hot", i) for i in range(50)] + [(f"k{i}", i) for i in range(20)] + [(None, 1), ("none", 2)], "k string, i int")
    table = rows.filter("k is not null and k <> 'none'").groupBy("k").count()
    want = {(r["k"], r["i"], r["count"]) for r in rows.join(table, "k", "left").collect()}
    for most in (1000, 5):
        got = lookup_join(rows, table, ["k"], "count", most).collect()
        assert {(r["k"], r["i"], r["count"]) for r in got} == want and len(got) == rows.count()
