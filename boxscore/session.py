"""Spark session helpers.

Cluster settings (executors, memory, checkpoint folder) come from the
launcher; the helpers here only fill in what is unset, which is what
tests and the local benchmark need.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job in this package relies on. AQE re-plans joins from
# runtime sizes (broadcast when a side turns out small, split skewed
# partitions) and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs one more shuffle
    # (the survey-level joins feed a DISTINCT that would otherwise pin the
    # hot survey's rows to one task)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Partition sizing for the cluster: scans split at 128 MB and AQE sizes
    # post-shuffle partitions toward 128 MB, so task size stays bounded
    # whatever spark.sql.shuffle.partitions (set high on a cluster) is.
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# What every query sets on its session, whoever made it: the memory of a task
# follows from the bytes it reads, so scans split at 16 MB and shuffles are
# cut finely first and joined to partitions of about 2 MB, at any table size.
# (By default AQE deals a shuffle to as many tasks as there are cores.) Keys
# and codes compress to some 10 bytes a row: 2 MB are about 250,000 rows, which
# fit one memory page in each of the sorts and aggregates that share a task.
TASK_CONF = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}
FINE_PARTITIONS = 2000


def bound_tasks(spark: SparkSession) -> None:
    """Session settings that keep a task's share of a scan or shuffle bounded."""
    for key, value in TASK_CONF.items():
        spark.conf.set(key, value)
    partitions = max(FINE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "boxscore") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("BOXSCORE_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
