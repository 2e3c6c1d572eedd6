"""Session defaults, and the shared folder that written intermediates go to and leave again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Used where neither the cluster nor the caller has set them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Product-level lookups of this size may be broadcast; Spark measures them at run time.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
}


def build_session(
    app: str = "planledger",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution.

    AQE merges small shuffle partitions and splits skewed ones but never starts
    with more than the configured number, so large inputs need
    ``shuffle_partitions``: the bytes of the largest shuffle / 200 MB.
    """
    # Without call-site capture for every column the plans build much faster.
    conf.setdefault("spark.python.sql.dataFrameDebugging.enabled", "false")
    if shuffle_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach: the one named by ``spark.checkpoint.dir``,
    else the session's warehouse.

    Unless set, the warehouse is a folder of the driver's machine; on a cluster, where
    executors don't see it, that is refused.
    """
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if is_local_path(spark, folder) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{folder} is on the driver's machine only: name a shared folder in spark.checkpoint.dir")
    return folder


def is_local_path(spark: SparkSession, folder: str) -> bool:
    """Whether Spark takes ``folder`` to be on the machine's own disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


_scopes: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own for this call, in the shared folder. The innermost ``scratch`` deletes it."""
    folder = f"{shared_folder(spark)}/planledger/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(folder)
    return folder


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediates that are written inside, at the end.

    Results are computed from them, so they must be written or collected inside too. Without
    such a scope intermediates stay until whoever owns the shared folder clears it.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for folder in _scopes.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back, with its size known to the planner."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
