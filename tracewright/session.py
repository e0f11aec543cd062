"""Session defaults for local runs; on a cluster the submitted configuration holds."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "tracewright") -> SparkSession:
    """A session with UTC as its zone and adaptive execution on.

    `master` defaults to local with BENCH_CPUS (8) threads.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TRACEWRIGHT_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
