"""What pairs rest on: task fingerprints, similarity of tool sets, the pools of a task, and dedup of given pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracewright.functions.text import fingerprint

# Domains of tools; other tools belong to "other".
TOOL_DOMAINS = {
    "feishu_doc": "feishu", "feishu_sheet": "feishu", "feishu_message": "feishu", "browser": "web", "web_search": "web", "exec": "code",
    "process": "code", "read": "file", "write": "file", "memory_search": "memory", "sessions_spawn": "agent", "sessions_yield": "agent",
}


def domain(tool: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in TOOL_DOMAINS.items() for x in kv]), tool), F.lit("other"))


def task_fingerprint(tools: Column) -> Column:
    """Sorted domains, then the first five sorted tools."""
    domains = F.array_sort(F.array_distinct(F.transform(tools, domain)))
    return F.concat(F.array_join(domains, "|"), F.lit("::"), F.array_join(F.slice(F.array_sort(tools), 1, 5), "|"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared by all members of two sets; 1 where both are empty, 0 where one is."""
    both = F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both)


def candidates(scored: DataFrame) -> DataFrame:
    """Sessions worth pairing with their fingerprint: a named tool, a call and more than four steps."""
    fit = scored.filter((F.col("tool_calls") > 0) & (F.col("steps") > 4) & (F.size("tools") > 0))
    return fit.select("sid", "outcome", "use", "total", "tools", "steps", "user_input", task_fingerprint(F.col("tools")).alias("fp"))


def pools(cands: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = cands.filter(F.col("outcome").isin("success", "likely_success") & (F.col("use") != "recovery_training"))
    bad = cands.filter((F.col("use") == "recovery_training") | F.col("outcome").isin("failure", "likely_failure", "unknown", "partial"))
    return good, bad


def first_of_each(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row by `order` of rows equal in `keys`, nulls being equal; keys travel as a hash."""
    mark = fingerprint(*[F.col(k) for k in keys])
    return df.withColumn("_n", F.row_number().over(W.partitionBy(mark).orderBy(order))).filter("_n = 1").drop("_n")


def capped_groups(df: DataFrame, group: str, order: list[Column], quality: str = "pair_quality") -> DataFrame:
    """Of each group's rows by `order` the first where it is of high quality, else the first two; rows of no group stay."""
    own = df.filter(F.col(group).isNotNull()).withColumn("_n", F.row_number().over(W.partitionBy(group).orderBy(*order))).filter("_n <= 2")
    best = own.filter("_n = 1").select(group, F.when(F.col(quality) == "high", 1).otherwise(2).alias("_most"))
    kept = own.join(best, group).filter("_n <= _most").select(*df.columns)
    return kept.unionByName(df.filter(F.col(group).isNull()))


def export_main(pairs: DataFrame) -> DataFrame:
    return pairs.filter("pair_quality = 'high' and pair_type = 'success_vs_failure_at_error'")


def export_extended(pairs: DataFrame) -> DataFrame:
    return pairs.filter("pair_quality = 'medium' and pair_type = 'quality_comparison'")
