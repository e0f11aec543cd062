import random
from collections import Counter

from tracewright.llm import overlap as O

SCHEMA = "traj_id bigint, split string, session_id string, user_input string, source string, cls string, key string, tokens string"


def found(spark, rows):
    df = spark.createDataFrame([(*r, "src", "x", "y", "z") for r in rows], SCHEMA)
    pairs = O.split_overlaps(df, "traj_id", "split", "session_id", "user_input", "source")
    return pairs, {tuple(r) for r in O.overlap_pairs(pairs).collect()}


def brute(rows):
    own = [(i, s, (sid or "").strip().lower(), Counter(O.words(t or ""))) for i, s, sid, t in rows if s in ("train", "dev", "test")]
    out = set()
    for a in own:
        for b in own:
            if a[1] == "train" and b[1] != "train":
                n, m = sum(a[3].values()), sum(b[3].values())
                alike = min(n, m) >= 8 and 10 * sum((a[3] & b[3]).values()) >= 8 * max(n, m)
                if alike or (a[2] and a[2] == b[2]):
                    out.add((min(a[0], b[0]), max(a[0], b[0])))
    return out


def test_words():
    assert O.words("Don't copy data/A_1.csv 把两份报表 x9") == ["don", "t", "copy", "data", "a", "1", "csv", "把", "两", "份", "报", "表", "x9"]


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + list("把两份报表导出成附件")
    bases = [[rng.choice(vocabulary) for _ in range(rng.randrange(6, 40))] for _ in range(25)]
    rows = []
    for i in range(260):
        ws = list(rng.choice(bases))
        for _ in range(rng.randrange(0, max(1, len(ws) // 3))):
            op = rng.random()
            if op < 0.4 and len(ws) > 1:
                ws.pop(rng.randrange(len(ws)))
            elif op < 0.7:
                ws.insert(rng.randrange(len(ws) + 1), rng.choice(vocabulary))
            else:
                ws[rng.randrange(len(ws))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            rng.shuffle(ws)
        rows.append((i, rng.choice(["train", "train", "dev", "test"]), f"S{i % 97}", " ".join(ws)))
    assert found(spark, rows)[1] == brute(rows)


def test_prefix_always_holds_a_shared_span():
    rng = random.Random(5)
    for _ in range(3000):
        universe = list(range(200))
        n = rng.randrange(8, 70)
        a = sorted(rng.sample(universe, n))
        keep = rng.sample(a, rng.randrange(O.needed(n), n + 1))
        extra = [x for x in universe if x not in a]
        b = sorted(keep + rng.sample(extra, rng.randrange(0, n - len(keep) + 1)))
        if len(set(a) & set(b)) < O.needed(max(len(a), len(b))):
            continue
        pa, pb = a[: O.prefix_length(len(a))], b[: O.prefix_length(len(b))]
        assert set(zip(pa, pa[1:], strict=False)) & set(zip(pb, pb[1:], strict=False))


def test_edges(spark):
    t = "one two three four five six seven eight nine ten"
    rows = [
        (1, "train", " A ", None), (2, "test", "a", ""), (3, "train", "", t), (4, "dev", None, t.upper()), (5, "dev", " ", "one two three"), (6, "train", "q", "one two three"),
        (7, "valid", "a", t), (8, None, "a", t), (9, "test", "b", t + " eleven"), (10, "train", "c", t), (10, "train", "c", t),
    ]
    pairs, got = found(spark, rows)
    assert got == {(1, 2), (3, 4), (3, 9), (4, 10), (9, 10)}
    report = {(r["split"], r["source"]): (r["rows"], r["rows_in_training"], r["pairs"]) for r in O.overlap_report(pairs, spark.createDataFrame([(*r, "src", "x", "y", "z") for r in rows], SCHEMA), "traj_id", "split", "source").collect()}
    assert report == {("test", "src"): (2, 2, 3), ("dev", "src"): (2, 1, 2)}
    assert found(spark, [])[1] == set()


def test_hot_copies_and_very_long_texts(spark):
    long = " ".join(f"word{i % 5000}" for i in range(60_000))
    rows = [(i, "train" if i % 2 else "test", None, "the same request comes again and again from everyone here") for i in range(60)]
    rows += [(100, "train", None, long), (101, "dev", None, long + " and more")]
    got = found(spark, rows)[1]
    assert len(got) == 30 * 30 + 1 and (100, 101) in got


def test_suffixes_are_sorted_and_spans_are_common_prefixes(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rng = random.Random(9)
    texts = []
    for i in range(30):
        base = rng.sample(range(10_000, 10_023), 20)
        texts.append((sorted((x * 7919) << 20 for x in base), i % 2 == 0))
    rows = [({"a": i, "b": i}, t, h, not h) for i, (t, h) in enumerate(texts)]
    classes = spark.createDataFrame(rows, "cls struct<a:bigint,b:bigint>, tokens array<bigint>, held boolean, train boolean")
    array = O.suffix_array(classes, np.zeros(O.BUCKETS, np.int64), ordered=True)
    parts = array.withColumn("part", F.spark_partition_id()).select("part", "key", "more").collect()
    for p in {r["part"] for r in parts}:
        own = [(r["key"], r["more"]) for r in parts if r["part"] == p]
        assert own == sorted(own)
    got = {(r["ca"]["a"], r["cb"]["a"]): {(s["at"], s["till"]) for s in r["spans"]} for r in O.shared_spans(array).collect()}
    want = {}
    for i, (a, held) in enumerate(texts):
        for j, (b, other) in enumerate(texts):
            if held and not other and len(set(a) & set(b)) >= 16:
                k = O.prefix_length(20) - 1
                for x in range(k):
                    for y in range(k):
                        n = next((n for n in range(21) if x + n >= 20 or y + n >= 20 or a[x + n] != b[y + n]), 20)
                        if n >= 2 and min(x, y) + min(20 - x, 20 - y) >= 16:
                            want.setdefault((i, j), set()).add((x, x + min(n, O.DEPTH + 2)))
    assert want and all(got[p] == s for p, s in want.items())
    plain = O.shared_spans(O.suffix_array(classes, np.zeros(O.BUCKETS, np.int64))).collect()
    assert {(r["ca"]["a"], r["cb"]["a"]): {(s["at"], s["till"]) for s in r["spans"]} for r in plain} == got


def test_spans_are_merged(spark):
    df = spark.createDataFrame([([(0, 4), (2, 6), (9, 11)],), ([],), ([(0, 8), (1, 3), (8, 9)],)], "s array<struct<at:int,till:int>>")
    assert [r[0] for r in df.select(O.span_words("s")).collect()] == [8, 0, 9]
