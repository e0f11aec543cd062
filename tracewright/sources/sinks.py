"""Results written: partitioned by bucket or stratum, as lines or one array, with a manifest of counts."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.operators import pairing, preferences


def write_sessions(sessions: DataFrame, path: str, steps: str = "steps", min_steps: int = 2) -> None:
    """Sessions of at least `min_steps` steps as JSON lines."""
    sessions.filter(F.size(steps) >= min_steps).write.mode("overwrite").json(path)


def write_buckets(rows: DataFrame, path: str, bucket: str, kind: str = "json") -> None:
    """One folder per value of `bucket`; rows without a bucket are left out, columns that begin with an underscore are not written."""
    kept = [c for c in rows.columns if not c.startswith("_")]
    rows.filter(F.col(bucket).isNotNull()).select(*kept).write.mode("overwrite").partitionBy(bucket).format(kind).save(path)


def write_outputs(rows: DataFrame, path: str, bucket: str = "bucket", review: str = "review", rejected: bool = False, kind: str = "json") -> None:
    """The buckets of routed rows under `path`/buckets, those up for review under `path`/needs_review, and on demand those rejected under `path`/rejected."""
    write_buckets(rows.filter(F.col(bucket) != "rejected"), f"{path}/buckets", bucket, kind)
    rows.filter(F.col(review)).write.mode("overwrite").format(kind).save(f"{path}/needs_review")
    if rejected:
        rows.filter(F.col(bucket) == "rejected").write.mode("overwrite").format(kind).save(f"{path}/rejected")


def write_training(pairs: DataFrame, samples: DataFrame, path: str, kind: str = "json") -> None:
    """The three training sets: weighted pairs at errors, quality pairs, and supervised samples of at least three messages."""
    preferences.export_main(pairs).write.mode("overwrite").format(kind).save(f"{path}/dpo_train_main")
    pairing.export_extended(pairs).write.mode("overwrite").format(kind).save(f"{path}/dpo_train_extended")
    samples.filter(F.size("messages") >= 3).write.mode("overwrite").format(kind).save(f"{path}/sft_positive_with_trajectory")


def write_manifest(rows: DataFrame, path: str, bucket: str, config: dict, stats: dict | None = None) -> None:
    """One JSON file that names when it was written, the configuration, the counts per bucket and what else `stats` holds; buckets are few."""
    counts = {str(r[bucket]): r["rows"] for r in rows.groupBy(bucket).agg(F.count("*").alias("rows")).collect()}
    own = {"created_at": datetime.now(timezone.utc).isoformat(), "config": config, "stats": stats or {}, "files": dict(sorted(counts.items())), "rows": sum(counts.values())}
    line = rows.sparkSession.createDataFrame([(json.dumps(own, ensure_ascii=False, sort_keys=True),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(path)


def write_array(rows: DataFrame, path: str) -> None:
    """The rows as one indented JSON array in the file `path`: for small reports, written row by row through the driver."""
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for i, line in enumerate(rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()):
            text = json.dumps(json.loads(line[0]), ensure_ascii=False, indent=2)
            f.write(("," if i else "") + "\n" + text)
        f.write("\n]\n")


def manifest(rows: DataFrame, bucket: str, config: dict) -> DataFrame:
    """One row per bucket with its `rows`, its `share` of all rows and the configuration."""
    counts = rows.groupBy(bucket).agg(F.count("*").alias("rows"))
    total = rows.agg(F.count("*").alias("_all")).withColumn("_one", F.lit(1))
    return counts.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one").select(bucket, "rows", (F.col("rows") / F.col("_all")).alias("share"), F.lit(json.dumps(config, sort_keys=True)).alias("config"))
