"""Session settings sized by the data, for jobs and benchmarks."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

# Bytes one shuffle or scan task should hold, so that it sorts in executor memory.
TASK_BYTES = 200 * 1024 * 1024
MIN_PARTITIONS = 200
INITIAL_PARTITIONS = 2000


def settings(shuffle_bytes: int) -> dict[str, str]:
    """Settings for a job whose largest shuffle writes about ``shuffle_bytes``.

    For ``build_fact`` that is the six columns read from line items, about a third
    of the table.  Adaptive execution merges the partitions smaller inputs leave.
    """
    partitions = max(MIN_PARTITIONS, math.ceil(shuffle_bytes / TASK_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.session.timeZone": "UTC",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }


def session(app: str, shuffle_bytes: int | None = None) -> SparkSession:
    """A session; a size given here decides over what spark-submit was told.

    Without a size, shuffles start with many partitions and adaptive execution merges
    those that small inputs leave.
    """
    builder = SparkSession.builder.appName(app)
    if shuffle_bytes is None:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(INITIAL_PARTITIONS)
        )
    if shuffle_bytes is not None:
        for key, value in settings(shuffle_bytes).items():
            builder = builder.config(key, value)
    return builder.getOrCreate()
