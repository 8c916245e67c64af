"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F


# Generated methods above this size are never compiled by the JVM; wide
# expression sets run much faster as separate operators than interpreted.
METHOD_LIMIT = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def build_session(master: str | None = None, app: str = "covaria", **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling switched on.

    Shuffle partition counts are left to the caller: a cluster sets its own,
    tests pass a small one.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **METHOD_LIMIT,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that hold for any session, unless the user set them, to whatever value."""
    chosen = spark.sparkContext.getConf()
    for key, value in METHOD_LIMIT.items():
        if not chosen.contains(key) and spark.conf.get(key, None) in (None, "65535"):
            spark.conf.set(key, value)
    return spark


# Rows of a split that `spread` makes, and the most of one that it leaves as it is: iterative fits hold about 200 bytes for each.
SPLIT_ROWS = 250_000
MOST_SPLIT_ROWS = 500_000


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on a table that comes in fewer splits than there are cores, and bound the rows of a split.

    `df` is a stored table, whose rows are counted by split from its files'
    footers: a file of few row groups has splits without any row and others
    with all of a group.  One of many small files is left as it is.  Choose the
    columns before: what is dealt out by `key` here is not pruned later.
    Unlike round robin, a key needs no sort to be repeatable.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    sizes = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
    splits, most, rows = sizes.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if splits >= cores and most <= MOST_SPLIT_ROWS:
        return df
    return df.repartition(max(cores, -(-rows // SPLIT_ROWS)), key)


@functools.lru_cache(maxsize=1)
def _local_folder() -> tempfile.TemporaryDirectory:
    """One folder for a local master, gone with the process."""
    return tempfile.TemporaryDirectory(prefix="covaria-", ignore_cleanup_errors=True)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local master (tests, a laptop) may go without such a folder; it
    gets a temporary one, which is deleted when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder().name
    return f"{base.rstrip('/')}/covaria-{uuid.uuid4().hex}"


def checkpointed(spark: SparkSession) -> None:
    """See to it that boosters of many rounds can cut their lineage, which else grows until a task is too deep to send."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


# Rows of a file that `cut_lineage` writes where it is told how many rows there are.
FILE_ROWS = 100_000


def in_few(df: DataFrame, rows: int) -> DataFrame:
    """`df`, the last stage of which reads at most `rows`, in no more partitions than they need; there is a task for each core at least."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))


def cut_lineage(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    The plan is run once, the result survives the loss of executors, and
    later readers start from the files.  `rows`, a bound on what the last
    stage reads, keeps small tables from as many files as a shuffle has
    partitions; there is a task for each core at least.
    """
    if rows is not None:
        df = in_few(df, rows)
    path = f"{shared_folder(df.sparkSession)}/table"
    # Keys of digits, which are most of many tables, take about two thirds of what they do by default.
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def held(df: DataFrame):
    """Keep a table while several jobs read it, then let it go."""
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
