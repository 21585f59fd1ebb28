"""Small helpers shared by the operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable, Iterable
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z, every other byte as it is.
ASCII_LOWER = bytes(range(256)).lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def use_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to ``spark.checkpoint.dir``; unset, to the warehouse of a local master.

    The folder below it, which Spark makes for this application, goes when the application ends.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
        sc.setCheckpointDir(named)
    own = spark._jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir())
    # A set of paths: naming one again changes nothing.
    own.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(own)


def freeze(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, into the folder all executors share, and cut its lineage.

    Only narrow tables are frozen: ids, counts, hashes, never texts.
    """
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def once(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once in each Python process, whatever number of tasks it runs.

    Functions arrive in workers by value, with globals of their own for each task, so the
    process keeps such things under a module name instead.
    """
    kept = sys.modules.setdefault("_paidmedia_llm_process", ModuleType("_paidmedia_llm_process")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def binary(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary()).to_pylist()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone: 53 bits of their hash."""
    bits = F.shiftrightunsigned(F.xxhash64(*parts), 11)
    return (bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-53)


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
