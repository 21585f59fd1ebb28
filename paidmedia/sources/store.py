"""Written intermediate tables, in the folder all executors share.

A written table is read back by any executor, so losing one costs only the
tasks it was running.  The folder goes when the application ends.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_lock = threading.RLock()
_tables: dict[tuple[str, str], tuple[tuple, str, StructType]] = {}
_building: dict[tuple[str, str], threading.RLock] = {}
_marked: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; the warehouse where a local master leaves it unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, name: str) -> str:
    """A new place in the application's folder, which is deleted when the application ends."""
    folder = f"{shared_folder(spark)}/paidmedia/{spark.sparkContext.applicationId}"
    with _lock:
        if folder not in _marked:
            where, files = _hadoop(spark, folder)
            files.mkdirs(where)
            files.deleteOnExit(where)
            _marked.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def file_state(spark: SparkSession, paths: Sequence[str]) -> tuple:
    """Files and bytes below each path and the time of the path itself.

    Two calls a path, however many files it holds.  A file that is added, removed or
    replaced changes the time of its folder; where a store keeps no such times and the
    bytes stay the same, ``refresh`` forgets the table.
    """
    found = []
    for path in paths:
        where, files = _hadoop(spark, path)
        whole = files.getContentSummary(where)
        time = files.getFileStatus(where).getModificationTime()
        found.append((path, whole.getFileCount(), whole.getLength(), time))
    return tuple(found)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def derived(
    spark: SparkSession, key: str, inputs: Sequence[str], build: Callable[[], DataFrame]
) -> DataFrame:
    """The table ``key``, built and written on first use in this application.

    Later uses scan the written files, with column pruning and pushed filters.  The
    table is built anew when a file below ``inputs`` was added, removed or changed.
    """
    name = (spark.sparkContext.applicationId, key)
    state = file_state(spark, inputs)
    # One build of a table at a time; other tables are not kept waiting.
    with _lock:
        building = _building.setdefault(name, threading.RLock())
    with building:
        if name not in _tables or _tables[name][0] != state:
            df = build()
            path = new_path(spark, "table")
            df.write.parquet(path)
            _tables[name] = (state, path, df.schema)
        _, path, schema = _tables[name]
    return spark.read.schema(schema).parquet(path)


def refresh(spark: SparkSession, key: str) -> None:
    """Forget a derived table; its next use builds it anew."""
    with _lock:
        _tables.pop((spark.sparkContext.applicationId, key), None)
