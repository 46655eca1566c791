"""A Spark session with the settings the plans in this library count on."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import Any

from pyspark.sql import SparkSession

# AQE is what turns an over-partitioned shuffle into right-sized tasks, splits a
# hot join key, and swaps a sort-merge join for a broadcast once a side is known
# to be below spark.sql.autoBroadcastJoinThreshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A lookup too large to broadcast is still small per shuffle partition. Hashing
    # it there, once its measured size allows, spares sorting the fact rows.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    # A sum that overflows must fail the query and not wrap around.
    "spark.sql.ansi.enabled": "true",
}

# Recording the Python line of every column expression costs a round trip to the
# JVM each, a quarter of the time it takes to build a query. It can only be chosen
# when the session starts.
# So can the scheduler, which shares the cluster among steps that run at once.
AT_START = {"spark.python.sql.dataFrameDebugging.enabled": "false", "spark.scheduler.mode": "FAIR"}

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MOST_PARTITIONS = 10_000

# What one task reads of the files of a scan, and of a shuffle whose partitions AQE merges.
SHARES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
LEAST_SHARE, MOST_SHARE = 16 << 20, (128 << 20, 64 << 20)


def build_session(
    app: str = "starlane", master: str | None = None, hive: bool = False, input_bytes: int = 0, **conf: str
) -> SparkSession:
    """Create or reuse a session; ``conf`` keys use ``__`` in place of dots.

    Settings given here or to spark-submit win over :data:`SETTINGS`. Unless told
    otherwise, shuffles start with four partitions per core of the cluster: AQE
    merges partitions that turn out small, but never splits one for its size alone.
    """
    builder = SparkSession.builder.appName(app)
    if hive:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    chosen = {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in {**AT_START, **chosen}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()

    def open_to_us(key: str) -> bool:
        return key not in chosen and not given.contains(key)

    for key, value in SETTINGS.items():
        if open_to_us(key):
            spark.conf.set(key, value)
    if "spark.sql.shuffle.partitions" not in chosen and INITIAL not in chosen:
        size_shuffles(spark, input_bytes)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Have shuffles start with enough partitions for an input, unless the session was told how many.

    That is four partitions per core, or one per 200 MB of input, up to ``MOST_PARTITIONS``:
    what the plans here shuffle has been summed before, and each task keeps a
    buffer and an entry for every partition.
    """
    given = spark.sparkContext.getConf()
    if not given.contains(INITIAL) and not given.contains("spark.sql.shuffle.partitions"):
        wanted = min(MOST_PARTITIONS, input_bytes // 200_000_000)
        spark.conf.set(INITIAL, str(max(200, 4 * spark.sparkContext.defaultParallelism, wanted)))


def size_shares(spark: SparkSession, input_bytes: int = 0) -> None:
    """Have tasks take small shares of files and shuffles, unless the session was told how large.

    A row that is 10 bytes in a Parquet file can be 200 in the hash table of an aggregation, so
    Spark's 128 MB of a file and 64 MB of a shuffle can become gigabytes in one task. With 16 MB
    a larger input makes more tasks and not larger ones. Beyond 160 GB it makes ``MOST_PARTITIONS``
    tasks, until shares are Spark's own.
    """
    wanted = max(LEAST_SHARE, input_bytes // MOST_PARTITIONS)
    for key, most in zip(SHARES, MOST_SHARE):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(min(wanted, most)))


def keeps_shares(job: Callable[..., Any]) -> Callable[..., Any]:
    """A job, given its session first, after which the session's shares are what they were."""

    @wraps(job)
    def run(spark: SparkSession, *args: Any, **choices: Any) -> Any:
        before = {key: spark.conf.get(key, None) for key in SHARES}
        try:
            return job(spark, *args, **choices)
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)

    return run
