"""Order-dependent operators that never sort a whole group in one task.

A group (a session, a channel) may hold any share of the rows. Positions, running sums and changes are computed
within runs of the order, then over the runs, which are a thousandth of the rows. Look-arounds are equi-joins
on (group, position), so that only the rows that look around are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Order numbers or positions per run.
RUN = 1024


def _offsets(df: DataFrame, key: str, run: str, value: Column) -> DataFrame:
    """Per (key, run) the sum of `value` over the earlier runs of the key."""
    sums = df.groupBy(key, run).agg(F.sum(value).alias("_sum"))
    before = F.sum("_sum").over(W.partitionBy(key).orderBy(run).rowsBetween(W.unboundedPreceding, -1))
    return sums.select(key, run, F.coalesce(before, F.lit(0)).alias("_before"))


def with_position(df: DataFrame, key: str, number: str, *ties: str, name: str = "pos") -> DataFrame:
    """`df` with the 1-based position of each row in its `key`, by `number` (an integer) and `ties`."""
    runs = df.withColumn("_run", F.expr(f"`{number}` div {RUN}"))
    inside = F.row_number().over(W.partitionBy(key, "_run").orderBy(number, *ties))
    out = runs.withColumn("_inside", inside).join(_offsets(runs, key, "_run", F.lit(1)), [key, "_run"])
    return out.withColumn(name, (F.col("_inside") + F.col("_before")).cast("bigint")).drop("_run", "_inside", "_before")


def with_running_sum(df: DataFrame, key: str, pos: str, value: Column, name: str) -> DataFrame:
    """`df` with the sum of `value` over the rows of its `key` up to and with this one, by the unique `pos`."""
    runs = df.withColumn("_v", value).withColumn("_run", F.expr(f"`{pos}` div {RUN}"))
    inside = F.sum("_v").over(W.partitionBy(key, "_run").orderBy(pos).rowsBetween(W.unboundedPreceding, 0))
    out = runs.withColumn("_inside", inside).join(_offsets(runs, key, "_run", F.col("_v")), [key, "_run"])
    return out.withColumn(name, F.col("_inside") + F.col("_before")).drop("_v", "_run", "_inside", "_before")


def changes(df: DataFrame, key: str, pos: str, value: str, name: str) -> DataFrame:
    """Per `key` how often `value`, nulls passed over, differs from the value before it."""
    runs = df.filter(F.col(value).isNotNull()).groupBy(key, F.expr(f"`{pos}` div {RUN}").alias("_run"))
    own = runs.agg(F.transform(F.array_sort(F.collect_list(F.struct(pos, value))), lambda x: x[value]).alias("_vs"))
    differs = F.zip_with("_vs", F.slice("_vs", 2, RUN), lambda a, b: F.when(a != b, 1).otherwise(0))
    ends = own.select(
        key, "_run", F.get("_vs", F.lit(0)).alias("_first"), F.try_element_at("_vs", F.lit(-1)).alias("_last"),
        F.aggregate(differs, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0))).alias("_in"),
    )
    whole = ends.groupBy(key).agg(F.sum("_in").alias("_in"), F.array_sort(F.collect_list(F.struct("_run", "_first", "_last"))).alias("_ends"))
    across = F.zip_with("_ends", F.slice("_ends", 2, 2**30), lambda a, b: F.when(a["_last"] != b["_first"], 1).otherwise(0))
    return whole.select(key, (F.col("_in") + F.aggregate(across, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))).cast("bigint").alias(name))


def look_around(rows: DataFrame, steps: DataFrame, key: str, pos: str, first: int, last: int, columns: list[str], name: str = "near") -> DataFrame:
    """`rows` with the array `name` of the steps at distance `first` to `last` from each, in order.

    An element holds `at` (the distance) and `columns`. `rows` must be unique in (`key`, `pos`); each asks for at most
    `last - first + 1` positions, found by an equi-join.
    """
    asked = rows.select(F.col(key).alias("_k"), F.col(pos).alias("_p"), F.explode(F.sequence(F.lit(first), F.lit(last))).alias("at"))
    asked = asked.withColumn("_q", F.col("_p") + F.col("at"))
    found = asked.join(steps.select(F.col(key).alias("_k"), F.col(pos).alias("_q"), *columns), ["_k", "_q"])
    near = found.groupBy("_k", "_p").agg(F.array_sort(F.collect_list(F.struct("at", *columns))).alias(name))
    joined = rows.join(near, (F.col(key) == F.col("_k")) & (F.col(pos) == F.col("_p")), "left").drop("_k", "_p")
    kind = near.schema[name].dataType
    return joined.withColumn(name, F.coalesce(F.col(name), F.array().cast(kind)))
