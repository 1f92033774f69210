"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that the operators count on. Partition counts come from AQE: it starts with as
# many as ``size_shuffles`` asks for and merges them to the advisory size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # Call sites of Column expressions cost more driver time than building the plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(master: str | None = None, app: str = "ledgerguard", **conf) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


MOST_PARTITIONS = 100_000  # shuffles with more spend their time on bookkeeping


def shuffle_partitions(total_bytes: int, advisory_bytes: int = 64 << 20, least: int = 1) -> int:
    """Partitions that a shuffle of so much input should start with. AQE merges what turns
    out smaller, but never splits an ordinary shuffle, so the start must be high enough."""
    return min(MOST_PARTITIONS, max(least, -(-total_bytes // advisory_bytes)))


def size_shuffles(spark: SparkSession, total_bytes: int) -> int:
    """Let AQE start with as many partitions as the input needs; never fewer than set."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = total_bytes < 1 << 60  # Spark gives a huge number for input that it can't size
    n = shuffle_partitions(total_bytes if known else 0, least=least)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


_roots: dict[str, str] = {}


def _shared(spark: SparkSession) -> str:
    """The folder of this application's scratch tables, dropped when it ends.

    It lies in the session's ``spark.checkpoint.dir``. A local session without that setting
    uses a folder beside its warehouse; a cluster must name one that all executors share.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-scratch"
        _roots[app] = f"{base.rstrip('/')}/ledgerguard/{app}"
        path = spark._jvm.org.apache.hadoop.fs.Path(_roots[app])
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return _roots[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, under the folder that the cluster shares."""
    return f"{_shared(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def passing(spark: SparkSession):
    """Gives a ``written`` whose tables are dropped at the end of the block, for work that
    is repeated as long as the application runs."""
    paths = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch(spark, name))
        return kept_at(df, paths[-1])

    try:
        yield keep
    finally:
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def together(*work: Callable[[], object]) -> list:
    """Results of independent steps, whose jobs share the cluster."""
    with ThreadPoolExecutor(len(work)) as pool:
        return [f.result() for f in [pool.submit(w) for w in work]]


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame stored in the scratch folder and read back: a plan that several queries
    share runs once, and a lost executor costs a read instead of a recomputation."""
    return kept_at(df, scratch(df.sparkSession, name))


def kept_at(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """The frame stored at a new path and read back. Its schema is known, so no job looks
    for it in the files."""
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
