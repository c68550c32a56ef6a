"""Session settings and the shared folder used for checkpoints and landed tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. None of them pins a partition count:
# AQE picks that from the real shuffle sizes, on one machine or a thousand.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Rows that travel to Python and back at once; texts can be long, so few of them.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Session windows of a stream are merged within a task before the shuffle, so a busy
    # user arrives as one row per session and task.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Tasks per core that list files. By default every path of up to 10,000 is a task, and a file
# stream lists each file it has found by itself, so small files cost a task each.
LISTING_TASKS_PER_CORE = 4

# Settings that only a session under construction takes.
STATIC_CONF = {
    # No call-site capture per Column call; it dominates plan building for wide expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created.

    Python workers started for this session also find the package where it lies, so a
    checkout works without being installed.
    """
    listing = LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    for key, value in {**RUNTIME_CONF, "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(listing)}.items():
        if spark.conf.get(key, None) != value and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (ROOT, paths)))
    return spark


def local_session(folder: str, cores: str | int = "*", app: str = "turnwise", memory: str = "8g",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench, with its shared folder; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", folder)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.extraJavaOptions", "-Duser.timezone=UTC")
    )
    for key, value in {**RUNTIME_CONF, **STATIC_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as ``spark.checkpoint.dir`` names it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never reused, so a retried job cannot mix runs."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def landed(spark: SparkSession, df, label: str):
    """Write ``df`` once below the shared folder and return the written table."""
    return landed_path(spark, df, label)[0]


def landed_path(spark: SparkSession, df, label: str):
    """As :func:`landed`, with the path, so that the table can be removed once it is used up."""
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote below the shared folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
