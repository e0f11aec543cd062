"""Errors of a stream of steps: repeated deliveries left out, counted per class over windows of event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.functions.errors import PIPELINE_ERRORS, error_class
from tracewright.functions.steps import resolved_status, step_type
from tracewright.functions.text import fingerprint
from tracewright.operators.facts import BUSINESS, session_name


def windowed_errors(steps: DataFrame, at: str = "ingested_at", width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Per window of `at` and class of error the number of errors, for batch and streaming tables alike.

    A step that is delivered again within `late` counts once; steps later than that are dropped by the watermark, so state stays bounded.
    """
    st = resolved_status(F.col("status"), F.col("output"), F.col("error"))
    rows = steps.filter((step_type(F.col("step_type")) == "tool_result") & (st == "error")).select(
        F.col(at).cast("timestamp").alias("at"), fingerprint(session_name(F.col("session_id")), *[F.col(c) for c in BUSINESS]).alias("mark"),
        error_class(F.concat_ws(" ", "error", "output"), PIPELINE_ERRORS, "other_error").alias("error_type"),
    )
    if steps.isStreaming:
        rows = rows.withWatermark("at", late).dropDuplicatesWithinWatermark(["mark"])
    else:
        rows = rows.groupBy("mark", "error_type").agg(F.min("at").alias("at"))
    return rows.groupBy(F.window("at", width).alias("w"), "error_type").agg(F.count("*").alias("errors")).select("w.start", "w.end", "error_type", "errors")
