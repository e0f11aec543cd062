"""Items of varying length in containers of fixed capacity, by best fit over runs of equal sizes.

Sizes are whole numbers up to the capacity, so items of one size and containers of one gap are runs that differ
in nothing but their rank. Each round takes the next smaller run of items, matches it with the successor gaps
(the smallest that hold the size), settles by rank which items get them, and updates the gaps. The rounds therefore
need only the count of each size: at most `capacity` numbers, whatever the number of items. The items themselves are
ranked within their size and looked up in the resulting segments, all in parallel.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewright.sources import cut_lineage

CAPACITY = 2048
#: Items of one size that one task ranks.
PER_TASK = 1_000_000
#: Segments up to which their table is broadcast; beyond it is joined by shuffle.
BROADCAST_SEGMENTS = 100_000


@dataclass(frozen=True)
class Segment:
    """Items of `size` with ranks from `first` to `last` go into containers from `container` on, `per` in each, at `offset`."""

    size: int
    first: int
    last: int
    container: int
    per: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Segment], int]:
    """The segments and the number of containers for `counts` items of each size from 1 to `capacity`."""
    segments: list[Segment] = []
    gaps: list[int] = []  # sorted; runs[g] holds the (first, last) runs of containers with gap g
    runs: dict[int, list[tuple[int, int]]] = {}
    used = 0

    def put(gap: int, run: tuple[int, int]) -> None:
        if gap:
            if gap not in runs:
                runs[gap] = []
                insort(gaps, gap)
            runs[gap].append(run)

    for size in sorted((s for s, n in counts.items() if n and s > 0), reverse=True):
        rank, n = 0, counts[size]
        while rank < n and (at := bisect_left(gaps, size)) < len(gaps):
            gap = gaps[at]
            lo, hi = runs[gap].pop()
            take = min(n - rank, hi - lo + 1)
            segments.append(Segment(size, rank, rank + take - 1, lo, 1, capacity - gap))
            rank += take
            if lo + take <= hi:
                runs[gap].append((lo + take, hi))
            if not runs[gap]:
                del runs[gap], gaps[at]
            put(gap - size, (lo, lo + take - 1))
        if rank < n:
            per = capacity // size
            opened = -(-(n - rank) // per)
            segments.append(Segment(size, rank, n - 1, used, per, 0))
            short = (n - rank) - (opened - 1) * per
            if opened > 1:
                put(capacity - per * size, (used, used + opened - 2))
            put(capacity - short * size, (used + opened - 1, used + opened - 1))
            used += opened
    return segments, used


def pieces(items: DataFrame, item_id: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """`item`, `piece` and `n` of every item: only one larger than `capacity` has pieces beyond 0, all but the last full."""
    n = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    last = F.greatest(F.expr("(n - 1) div {}".format(capacity)), F.lit(0))
    rows = items.select(F.col(item_id).alias("item"), n.alias("n"))
    rows = rows.select("item", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    return rows.select("item", F.col("piece").cast("int").alias("piece"), F.least(F.col("n") - F.col("piece") * capacity, F.lit(capacity)).alias("n"))


def pack(items: DataFrame, item_id: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: `item_id`, `piece`, `container`, `start` (its offset there), `n`.

    Container numbers run from 0 without a gap. An item of no size (also null) takes no room and is put at the start of
    container 0. Repeated rows are placed one by one; an empty table gives an empty result. The counts per size, at
    most `capacity` rows, are the only thing that comes to the driver.
    """
    spark = items.sparkSession
    cut = cut_lineage(pieces(items, item_id, size, capacity))
    counts = {r["n"]: r["count"] for r in cut.filter("n > 0").groupBy("n").count().collect()}
    segments, _ = plan(counts, capacity)
    spread = 1
    while spread * PER_TASK < max(counts.values(), default=0):
        spread *= 2
    salted = cut.filter("n > 0").withColumn("salt", F.pmod(F.xxhash64("item", "piece"), F.lit(spread)))
    inside = F.row_number().over(W.partitionBy("n", "salt").orderBy("item", "piece")) - 1
    ranked = salted.withColumn("inside", inside)
    if spread > 1:
        sums = salted.groupBy("n", "salt").agg(F.count("*").alias("c"))
        before = F.coalesce(F.sum("c").over(W.partitionBy("n").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        ranked = ranked.join(sums.select("n", "salt", before.alias("before")), ["n", "salt"])
    else:
        ranked = ranked.withColumn("before", F.lit(0))
    ranked = ranked.select("item", "piece", "n", (F.col("inside") + F.col("before")).alias("rank"))
    rows = [(s.size, s.first, s.last, s.container, s.per, s.offset) for s in segments]
    table = spark.createDataFrame(rows, "n bigint, first bigint, last bigint, container bigint, per int, offset bigint")
    table = table.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("first", "last", "container", "per", "offset"))).alias("segs"))
    if len(rows) <= BROADCAST_SEGMENTS:
        table = F.broadcast(table)
    placed = ranked.join(table, "n").withColumn("seg", F.get(F.filter("segs", lambda s: (s["first"] <= F.col("rank")) & (F.col("rank") <= s["last"])), F.lit(0)))
    into = F.col("rank") - F.col("seg.first")
    placed = placed.select(
        "item", "piece",
        (F.col("seg.container") + F.expr("(rank - seg.first) div seg.per")).alias("container"),
        (F.col("seg.offset") + F.pmod(into, F.col("seg.per")) * F.col("n")).alias("start"),
        "n",
    )
    zero = F.lit(0).cast("bigint")
    empty = cut.filter("n = 0").select("item", "piece", zero.alias("container"), zero.alias("start"), "n")
    return placed.unionByName(empty).withColumnRenamed("item", item_id)
