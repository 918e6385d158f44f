"""Session settings and the few helpers that need more than one DataFrame expression."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "tagloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on; explicit ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back
    to a temporary folder: elsewhere the executors would not see it.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="tagloom-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, **options: int) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from there; ``options`` are the writer's.

    Used where a result feeds several jobs (a size check and then a join, or the
    iterations of a model fit). The written copy survives the loss of executors; as
    Parquet it keeps column pruning, filters and size statistics for what reads it.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def batch_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Arrow batches to Python of about ``most`` bytes while a job runs, for rows that are large themselves: a batch stands in memory
    several times, outside of the heap and in Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a scan with fewer splits than cores one partition per core.

    A table stored in a handful of files would run the text functions on a handful of
    cores. Large tables have more splits than cores and are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
