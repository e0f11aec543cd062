"""Parquet tables of a data folder, and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The whole table `name` of `folder`; a single file and a folder of parts read alike."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` written once to the shared checkpoint folder and read back from it.

    The folder is the cluster's `spark.checkpoint.dir`. Only where that is unset and the master is local (tests, a laptop) a
    temporary folder is taken, since there driver and executors are one process; it goes when the process ends. On a cluster an
    unset folder is an error. `spark.cleaner.referenceTracking.cleanCheckpoints` lets Spark remove what no query refers to any more.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tracewright-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


_ONCE: dict[tuple, DataFrame] = {}


def once(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What `make` builds from the table `name`, built once per application and state of the table: its files and their times of change."""
    jvm = spark.sparkContext._jvm
    files = sorted(table(spark, folder, name).inputFiles())
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    stamps = tuple((f, (st := jvm.org.apache.hadoop.fs.Path(f).getFileSystem(conf).getFileStatus(jvm.org.apache.hadoop.fs.Path(f))).getLen(), st.getModificationTime()) for f in files[:64])
    key = (spark.sparkContext.applicationId, name, len(files), stamps)
    if key not in _ONCE:
        for old in [k for k in _ONCE if k[0] != key[0]]:
            del _ONCE[old]
        _ONCE[key] = make()
    return _ONCE[key]


#: Rows up to which a lookup table is broadcast; beyond it is joined by shuffle.
BROADCAST_ROWS = 100_000


def lookup(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, written once and counted, with a broadcast hint if it has at most `most` rows.

    For tables of groups joined back to the rows they were counted from: keys that hold a large share of the rows then never meet in one task.
    """
    cut = cut_lineage(df)
    return F.broadcast(cut) if cut.count() <= most else cut


def lookup_join(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """`rows` left-joined with `table` (unique in `keys`, of which `weight` counts the rows), whatever share of the rows one key holds.

    A table of more than `most` rows is split: keys that hold more than a `most`-th of the weight are fewer than `most` and are broadcast,
    the others are joined by shuffle, where none of them can be hot.
    """
    cut = cut_lineage(table)
    size, total = cut.agg(F.count("*"), F.sum(weight)).first()
    if size <= most:
        return rows.join(F.broadcast(cut), keys, "left")
    hot = F.col(weight) * most > total
    marks = F.broadcast(cut.filter(hot).select(*keys, F.lit(True).alias("_hot")))
    marked = rows.join(marks, keys, "left")
    a = marked.filter("_hot").drop("_hot").join(F.broadcast(cut.filter(hot)), keys, "left")
    b = marked.filter("_hot is null").drop("_hot").join(cut.filter(~hot), keys, "left")
    return a.unionByName(b)
