"""Specialist data sets: tool-call pairs, long plans, graceful aborts, subagent work and retries across sessions."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions.text import quantise
from tracewright.operators import taxonomy
from tracewright.operators.ordered import changes, look_around, with_running_sum
from tracewright.sources.tables import cut_lineage, lookup

# What an output says that stops on purpose; case matters.
ABORT_SIGNALS = [
    "等待", "确认", "需要您", "超出", "无法继续", "请指示", "建议", "分批", "筛选", "澄清", "暂停",
    "waiting", "confirm", "clarif", "out of scope", "unable to proceed", "please advise", "suggest", "pause", "need your input",
]
# Reasons to stop, first match wins.
ABORT_REASONS = {
    "scope_exceeded": ["超出", "out of scope", "beyond", "limit", "限额"],
    "needs_confirmation": ["确认", "clarif", "confirm", "需要您", "need your"],
    "data_too_large": ["分批", "batch", "筛选", "filter", "范围"],
    "waiting_for_resource": ["等待", "wait", "暂停", "pause"],
}
GOOD, BAD = ("success", "likely_success"), ("failure", "likely_failure")


def tool_call_pairs(facts: DataFrame, scored: DataFrame, most: int = 20, least_calls: int = 2, context: int = 2) -> DataFrame:
    """The first `most` calls of each success that have context before and a result without error in the next two steps."""
    fit = scored.filter(F.col("outcome").isin(*GOOD) & (F.col("tool_calls") >= least_calls)).select("sid")
    calls = facts.filter((F.col("kind") == "tool_call") & F.col("tool").isNotNull() & (F.col("pos") > context)).join(fit, "sid").select("sid", "pos", "tool")
    near = look_around(calls, facts, "sid", "pos", 1, 2, ["kind", "st"])
    result = F.get(F.filter("near", lambda x: x["kind"] == "tool_result"), F.lit(0))
    good = near.withColumn("result", result).filter("result is not null and result.st <> 'error'")
    numbered = with_running_sum(good, "sid", "pos", F.lit(1), "n").filter(F.col("n") <= most)
    return numbered.select("sid", (F.col("n") - 1).alias("call_index"), F.col("tool").alias("tool_name"), F.col("result.st").alias("result_status"), (F.col("pos") - 1).alias("context_steps"))


def long_plans(facts: DataFrame, scored: DataFrame, least: int = 20) -> DataFrame:
    """Sessions of `least` steps that succeeded, and the steps before the first error of others where there are as many."""
    firsts = facts.filter("st = 'error'").groupBy("sid").agg((F.min("pos") - 1).alias("cut"))
    s = scored.select("sid", "outcome", "steps", F.size("tools").alias("n_tools")).join(firsts, "sid", "left")
    whole = F.col("outcome").isin(*GOOD)
    s = s.filter((whole & (F.col("steps") >= least)) | (~whole & (F.col("cut") >= least)))
    s = s.withColumn("used", F.when(whole, F.col("steps")).otherwise(F.col("cut")))
    own = facts.join(s.select("sid", "used"), "sid").filter("pos <= used")
    nodes = own.filter("kind = 'reasoning' and says and not task_note").groupBy("sid").agg(F.count("*").alias("plan_nodes"), F.count_if("plans").alias("planning_nodes"))
    switched = changes(own, "sid", "pos", "skill", "switches")
    with_skill = own.filter("skill is not null").select("sid").distinct().withColumn("first", F.lit(1))
    tier = F.when((F.col("used") >= 30) & (F.col("n_tools") >= 4), "tier1").when(F.col("used") >= 20, "tier2").otherwise("tier3")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return (
        s.join(nodes, "sid", "left").join(switched, "sid", "left").join(with_skill, "sid", "left")
        .select(
            "sid", F.when(whole, "complete").otherwise("partial_until_error").alias("plan_outcome"), tier.alias("complexity_tier"),
            F.col("used").alias("total_steps"), zero(F.col("plan_nodes")).alias("plan_nodes"), zero(F.col("planning_nodes")).alias("planning_nodes"),
            (zero(F.col("switches")) + zero(F.col("first"))).alias("skill_switches"),
        )
    )


def _holds(c: Column, needles: list[str]) -> Column:
    return F.coalesce(c.rlike("|".join(f"\\Q{n}\\E" for n in needles)), F.lit(False))


def abort_reason(text: Column) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for reason, needles in ABORT_REASONS.items():
        out = out.when(_holds(F.lower(text), needles), reason)
    return out.otherwise("other")


def signals_abort(text: Column) -> Column:
    """Whether `text` says that the work stops on purpose."""
    return _holds(text, ABORT_SIGNALS)


def graceful_aborts(last_outputs: DataFrame, scored: DataFrame) -> DataFrame:
    """Sessions with calls and no error whose final output or last output step says that they stop, and why."""
    s = scored.filter("tool_calls > 0 and error_steps = 0").select("sid", "outcome", "final_output", "steps", "tool_calls").join(last_outputs, "sid", "left")
    said = signals_abort(F.col("final_output")) | signals_abort(F.col("last_output"))
    text = F.coalesce(F.nullif("final_output", F.lit("")), F.col("last_output"), F.lit(""))
    return s.filter(said).select("sid", "outcome", abort_reason(text).alias("abort_reason"), F.left(F.coalesce("final_output", F.lit("")), F.lit(500)).alias("abort_signal"), "steps", "tool_calls")


def subagent_work(facts: DataFrame, scored: DataFrame) -> DataFrame:
    """Sessions that spawn or await subagents: counts, yields followed by a thought within two steps, kind and tier.

    `sessions_yield` counts as both, as it always has; `spawn_only_count` leaves it out.
    """
    name = F.lower(F.coalesce("tool", F.lit("")))
    calls = facts.filter("kind = 'tool_call'").withColumn("spawn", name.isin("sessions_spawn", "sessions_yield", "subagent") | name.contains("spawn"))
    calls = calls.withColumn("yields", name.contains("yield")).filter("spawn or yields")
    near = look_around(calls.filter("yields").select("sid", "pos"), facts, "sid", "pos", 1, 2, ["kind"])
    joined = near.filter(F.exists("near", lambda x: x["kind"] == "reasoning")).groupBy("sid").agg(F.count("*").alias("aggregations"))
    per = calls.groupBy("sid").agg(F.count_if("spawn").alias("spawn_count"), F.count_if("yields").alias("yield_count"), F.count_if(F.col("spawn") & ~F.col("yields")).alias("spawn_only_count"))
    s = scored.select("sid", "outcome", F.size("tools").alias("n_tools"))
    n = F.col("spawn_count")
    kind = F.when(n == 1, "single_subagent").when((n >= 2) & (F.col("n_tools") >= 3), "parallel_subagents").when(n >= 2, "sequential_subagents").otherwise("yield_only")
    tier = F.when((n >= 3) & F.col("outcome").isin(*GOOD), "tier1").otherwise("tier2")
    return s.join(per, "sid").join(joined, "sid", "left").select(
        "sid", "outcome", kind.alias("collab_type"), "spawn_count", "yield_count", "spawn_only_count", F.coalesce("aggregations", F.lit(0)).alias("aggregations"), tier.alias("value_tier")
    )


def band_join(left: DataFrame, right: DataFrame, us_left: str, us_right: str, width_us: int) -> DataFrame:
    """Rows of `left` with the rows of `right` at most `width_us` later, by equi-join on blocks of that width."""
    a = left.withColumn("_b", F.expr(f"{us_left} div {width_us}"))
    b = right.withColumn("_b", F.explode(F.array(F.expr(f"{us_right} div {width_us}"), F.expr(f"{us_right} div {width_us} - 1"))))
    return a.join(b, "_b").filter((F.col(us_right) >= F.col(us_left)) & (F.col(us_right) - F.col(us_left) <= width_us)).drop("_b")


#: Pairs of a block beyond which its rows are dealt out to tiles.
DIRECT_PAIRS = 1_000_000
#: Pairs that a task compares on average.
_PAIRS_A_TASK = 1_000_000
#: What one product of a tile takes: pairs of characters, and failures. What one batch of results holds: rows, and characters of words added.
_GRAMS, _SLICE, _ROWS, _CHARS = 8192, 256, 20_000, 16_000_000
_TILE = ["_b", "_i", "_j"]
_ALIKE = "failed_session string, success_session string, time_gap_sec bigint, sim double, fail_reason string, added_context string"


def _tiles(timed: DataFrame, width_us: int, direct: int) -> tuple[DataFrame, int]:
    """The rows of `timed` by tile, and the pairs in all tiles: each failure meets each success of its block of the band's width and of the next in just one tile.

    A block is one tile; where it has too many rows for `direct` pairs, both sides are dealt out by a hash, and every part of one meets every part of the other.
    """
    side = max(1, math.isqrt(direct))
    at = F.expr(f"us div {width_us}")
    dealt = timed.withColumn("_b", F.explode(F.when(F.col("failed"), F.array(at)).otherwise(F.array(at, at - 1))))
    blocks = dealt.groupBy("_b").agg(F.count_if("failed").alias("m"), F.count_if(~F.col("failed")).alias("n")).filter("m > 0 and n > 0")
    blocks = lookup(blocks.withColumns({"_m": F.ceil(F.col("m") / side), "_n": F.ceil(F.col("n") / side)}))
    pairs = blocks.agg(F.sum(F.col("m").cast("double") * F.col("n"))).first()[0]
    part = lambda n: F.pmod(F.xxhash64("traj_id"), F.col(n))
    each = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    met = dealt.join(blocks, "_b")
    met = met.withColumn("_i", F.explode(F.when(F.col("failed"), F.array(part("_m"))).otherwise(each("_m"))))
    met = met.withColumn("_j", F.explode(F.when(F.col("failed"), each("_n")).otherwise(F.array(part("_n")))))
    return met.select(*timed.columns, *_TILE), int(pairs or 0)


def _common(texts: list[str], failed: int, spans: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct pairs of neighbouring characters each text has in its first 200, and how many the first `failed` share with each of the others, in `spans` only."""
    heads = [t[:200] for t in texts]
    points = np.frombuffer("".join(heads).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(heads)), [len(h) for h in heads])
    inner = row[1:] == row[:-1]
    marks = np.unique((points[:-1] << 42 | points[1:] << 21 | row[:-1])[inner])  # 21 bits each
    row, code = marks & 0x1FFFFF, marks >> 21
    sizes = np.bincount(row, minlength=len(heads))
    col = np.cumsum(np.diff(code, prepend=code[:1]) != 0)
    bad = row < failed
    shared = (np.bincount(col[bad], minlength=len(col) + 1) > 0) & (np.bincount(col[~bad], minlength=len(col) + 1) > 0)
    row, col, bad = row[shared[col]], (np.cumsum(shared) - 1)[col[shared[col]]], bad[shared[col]]
    common = np.zeros((failed, len(heads) - failed), np.float32)  # exact: counts are below 200
    for low in range(0, int(shared.sum()), _GRAMS):
        held = slice(*np.searchsorted(col, (low, low + _GRAMS)))
        wide = int(col[held][-1]) - low + 1
        a, b, r, c = np.zeros((failed, wide), np.float32), np.zeros((len(heads) - failed, wide), np.float32), row[held], col[held] - low
        a[r[bad[held]], c[bad[held]]] = 1
        b[r[~bad[held]] - failed, c[~bad[held]]] = 1
        for x, y, u, v in spans:
            common[x:y, u:v] += a[x:y] @ b[u:v].T
    return sizes, common


def _words(text: str) -> list[str]:
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", text).strip(" ").split(" ")


def _alike_in_tile(a: dict, b: dict, width_us: int, least: float):
    """Batches of _ALIKE for the failures `a` and successes `b` of one tile, both in order of time."""
    m = len(a["us"])
    spans = []
    for x in range(0, m, _SLICE):
        y = min(x + _SLICE, m)
        u, v = np.searchsorted(b["us"], a["us"][x]), np.searchsorted(b["us"], a["us"][y - 1] + width_us, "right")
        if u < v:
            spans.append((x, y, u, v))
    if not spans:
        return
    sizes, common = _common(a["ask"] + b["ask"], m, spans)
    olds, news = {}, {}
    for x, y, u, v in spans:
        gap = b["us"][None, u:v] - a["us"][x:y, None]
        both = common[x:y, u:v].astype(np.float64)
        sim = both / np.maximum(sizes[x:y, None] + sizes[None, m + u : m + v] - both, 1)
        later = (gap > 0) | ((gap == 0) & (b["traj_id"][None, u:v] > a["traj_id"][x:y, None]))
        i, j = np.nonzero(later & (gap <= width_us) & (sim >= least))
        gap, sim, i, j = gap[i, j], sim[i, j], i + x, j + u
        added, chars, low = [], 0, 0
        for k, (p, q) in enumerate(zip(i.tolist(), j.tolist()), 1):
            old, new = olds.get(p), news.get(q)
            if old is None:
                old = olds[p] = frozenset(_words(a["ask"][p]))
            if new is None:
                new = news[q] = _words(b["ask"][q])
            added.append(" ".join([w for w in new if w not in old][:30]))
            chars += len(added[-1])
            if k == len(i) or len(added) == _ROWS or chars > _CHARS:
                failed, good = pa.array(i[low:k]), pa.array(j[low:k])
                yield pa.RecordBatch.from_arrays(
                    [a["sid"].take(failed), b["sid"].take(good), pa.array(gap[low:k] // 1_000_000), pa.array(sim[low:k]), a["fail_reason"].take(failed), pa.array(added, pa.string())],
                    ["failed_session", "success_session", "time_gap_sec", "sim", "fail_reason", "added_context"],
                )
                added, chars, low = [], 0, k


def _alike(width_us: int, least: float):
    """Rows of whole tiles, a tile's rows one after the other in order of time, to batches of _ALIKE."""

    def of(t: pa.Table, numbers: dict, rows: np.ndarray) -> dict:
        own = t.select(["sid", "fail_reason", "ask"]).take(pa.array(rows)).combine_chunks()
        col = lambda c: own[c].chunk(0)
        return {c: x[rows] for c, x in numbers.items()} | {"sid": col("sid"), "fail_reason": col("fail_reason"), "ask": col("ask").to_pylist()}

    def tiles(t: pa.Table, starts: list[int]):
        numbers, failed = {c: t[c].to_numpy() for c in ("us", "traj_id")}, t["failed"].to_numpy()
        for start, end in zip(starts, starts[1:]):
            bad = failed[start:end]
            if bad.any() and not bad.all():
                at = np.arange(start, end)
                yield from _alike_in_tile(of(t, numbers, at[bad]), of(t, numbers, at[~bad]), width_us, least)

    def run(batches):
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            keys = np.stack([t[c].to_numpy() for c in _TILE])
            starts = [0, *(np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1).tolist()]
            yield from tiles(t, starts)
            rest = t.slice(starts[-1])  # the batch may end within its last tile
        if rest is not None:
            yield from tiles(rest, [0, rest.num_rows])

    return run


def retry_sequences(scored: DataFrame, instants: DataFrame, first_errors: DataFrame, minutes: int = 15, least: float = 0.3, direct: int = DIRECT_PAIRS) -> DataFrame:
    """A failed session and a later success of like request at most `minutes` after it: gap, similarity, reason and words added.

    `instants` gives `traj_id` and `us`; sessions without an instant take no part. Of equal instants the smaller `traj_id` comes first.
    All pairs of the band are compared, as a share of them is the result: tile by tile, common pairs of characters counted by products of matrices.
    """
    width_us = minutes * 60_000_000
    ends = scored.filter(F.col("outcome").isin(*GOOD, *BAD)).select("sid", "traj_id", F.col("outcome").isin(*BAD).alias("failed"), F.coalesce("user_input", F.lit("")).alias("ask"))
    if least > 0:
        ends = ends.filter(F.length("ask") >= 2)  # others are like none
    timed = ends.join(instants.select("traj_id", "us").filter("us is not null"), "traj_id").join(first_errors, "sid", "left").withColumn("fail_reason", F.coalesce("fail_reason", F.lit("unknown")))
    tiles, pairs = _tiles(cut_lineage(timed), width_us, direct)
    tasks = max(int(timed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // _PAIRS_A_TASK))
    found = tiles.repartition(tasks, *_TILE).sortWithinPartitions(*_TILE, "us", "traj_id").mapInArrow(_alike(width_us, least), _ALIKE)
    return found.select("failed_session", "success_session", "time_gap_sec", quantise(F.col("sim"), 3).alias("input_similarity"), "fail_reason", "added_context")


def first_errors(facts: DataFrame) -> DataFrame:
    """`sid`, `fail_reason`: the finer class of each session's first error."""
    return facts.filter("st = 'error'").groupBy("sid").agg(F.min_by("error_kind", "pos").alias("fail_reason"))




#: The specialist data sets, by name.
DATA_SETS = ("tool_call_pairs", "long_plan", "graceful_abort", "error_taxonomy", "retry_sequences", "subagent_collab")


def run_all(facts: DataFrame, scored: DataFrame, last_outputs: DataFrame, instants: DataFrame, wanted: tuple[str, ...] = DATA_SETS, minutes: int = 15) -> dict[str, DataFrame]:
    """The `wanted` data sets, by name, over the same facts and scores."""
    makers = {
        "tool_call_pairs": lambda: tool_call_pairs(facts, scored), "long_plan": lambda: long_plans(facts, scored), "graceful_abort": lambda: graceful_aborts(last_outputs, scored),
        "error_taxonomy": lambda: taxonomy.taxonomy(taxonomy.error_events(facts)), "retry_sequences": lambda: retry_sequences(scored, instants, first_errors(facts), minutes),
        "subagent_collab": lambda: subagent_work(facts, scored),
    }
    return {name: make() for name, make in makers.items() if name in wanted}
