import random
from collections import defaultdict

import pytest

from tracewright.llm import packing as B


def placed(spark, sizes, capacity=100):
    df = spark.createDataFrame([(i, n, 5, "x") for i, n in enumerate(sizes)], "doc bigint, size int, container int, n string")
    return B.pack(df, "doc", "size", capacity).collect()


def check(rows, sizes, capacity=100):
    parts, boxes = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r["doc"]].append((r["piece"], r["n"]))
        if r["n"]:
            boxes[r["container"]].append((r["start"], r["start"] + r["n"]))
    for i, n in enumerate(sizes):
        own = sorted(parts[i])
        assert sum(x for _, x in own) == (n or 0) and [p for p, _ in own] == list(range(len(own)))
        assert len(own) == max(1, -(-(n or 0) // capacity))
        assert all(x == capacity for _, x in own[:-1])
    for spans in boxes.values():
        spans.sort()
        assert spans[-1][1] <= capacity and all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert sorted(boxes) == list(range(len(boxes)))
    return len(boxes)


def best_fit(sizes, capacity):
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = min((g for g in gaps if g >= s), default=None)
        if fit is None:
            gaps.append(capacity - s)
        else:
            gaps.remove(fit)
            gaps.append(fit - s)
    return len(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_as_many_containers_as_item_by_item_best_fit(seed):
    rng = random.Random(seed)
    sizes = [rng.randrange(1, 101) for _ in range(600)]
    counts = defaultdict(int)
    for s in sizes:
        counts[s] += 1
    assert B.plan(counts, 100)[1] == best_fit(sizes, 100)


def test_placement_is_sound(spark, monkeypatch):
    rng = random.Random(9)
    sizes = [rng.choice([0, None, 1, 7, 33, 34, 50, 51, 100, 101, 250, rng.randrange(1, 100)]) for _ in range(400)]
    n = check(placed(spark, sizes), sizes)
    assert n * 100 - sum(s or 0 for s in sizes) < 100 * 3
    monkeypatch.setattr(B, "PER_TASK", 7)
    monkeypatch.setattr(B, "BROADCAST_SEGMENTS", 0)
    assert check(placed(spark, sizes), sizes) == n


def test_edges(spark):
    assert placed(spark, []) == []
    assert check(placed(spark, [None, 0]), [None, 0]) == 0
    assert check(placed(spark, [40] * 999), [40] * 999) == 500
    assert check(placed(spark, [1_000_001]), [1_000_001]) == 10_001
