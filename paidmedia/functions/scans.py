"""Ordered computations that stay distributed when one group is huge.

A plain window sends each group to one task.  The functions here range-partition by
group *and* order, so that a hot group is spread over many slices, scan each slice on
its own and add the totals of the earlier slices.  There is one plan for every size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.sources.store import materialise


def same(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of the keys of two aliased DataFrames."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    running: Mapping[str, str],
    slices: int | None = None,
) -> DataFrame:
    """Add inclusive running sums: ``running`` maps a new column to its source.

    ``order`` has to be a total order within each group.  As in a window, a NULL source
    adds nothing, and a sum is NULL until the first value.

    Unless ``slices`` is given, adaptive execution merges small ranges by their bytes, so
    the slices follow the data and not the session's number of shuffle partitions.
    """
    ordered = [*keys, *order]
    ranged = df.repartitionByRange(slices, *ordered) if slices else df.repartitionByRange(*ordered)
    # The slice number is written out, so that it means the same rows in both uses below.
    sliced = materialise(ranged.withColumn("_slice", F.spark_partition_id()), "slices")

    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    per_slice = sliced.groupBy(*keys, "_slice").agg(
        *[F.sum(src).alias(f"_{new}") for new, src in running.items()]
    )
    offsets = per_slice.select(
        *keys,
        "_slice",
        *[F.sum(f"_{new}").over(earlier).alias(f"_{new}") for new in running],
    )
    w = (
        Window.partitionBy(*[f"s.{k}" for k in [*keys, "_slice"]])
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def upto(new: str, src: str) -> Column:
        here, before = F.sum(f"s.{src}").over(w), F.col(f"o._{new}")
        return F.coalesce(here + before, here, before).alias(new)

    return (
        sliced.alias("s")
        .join(offsets.alias("o"), same("s", "o", [*keys, "_slice"]))
        .select(
            *[F.col(f"s.{c}") for c in df.columns],
            *[upto(new, src) for new, src in running.items()],
        )
    )


def bucketed(
    df: DataFrame,
    buckets: int,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    slices: int | None = None,
) -> DataFrame:
    """NTILE: ``buckets`` equal-sized buckets per group, the first ones larger by one."""
    numbered = running_totals(
        df.withColumn("_one", F.lit(1).cast("bigint")), keys, order, {"_position": "_one"}, slices
    )
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    at, size = F.col("_position") - 1, F.col("_size")
    small = F.floor(size / buckets)
    head = (size % buckets) * (small + 1)
    bucket = F.when(at < head, F.floor(at / (small + 1))).otherwise(
        F.floor((at - head) / F.greatest(small, F.lit(1))) + size % buckets
    )
    return (
        numbered.alias("s")
        .join(sizes.alias("o"), same("s", "o", keys))
        .select(*[F.col(f"s.{c}") for c in df.columns], (bucket + 1).cast("int").alias(name))
    )


def value_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, _n): how often each non-NULL value occurs, written once."""
    return materialise(
        df.filter(F.col(value).isNotNull())
        .groupBy(key, value)
        .agg(F.count(F.lit(1)).alias("_n")),
        "counts",
    )


def quantiles(
    counts: DataFrame,
    key: str,
    value: str,
    probabilities: Mapping[str, float],
    slices: int | None = None,
) -> DataFrame:
    """Exact linearly interpolated quantiles of ``value`` per ``key`` from ``value_counts``.

    The order statistics are looked up in the running counts; no group is collected.
    """
    placed = running_totals(counts, [key], [value], {"_upto": "_n"}, slices)
    sizes = counts.groupBy(key).agg(F.sum("_n").alias("_size"))
    joined = placed.alias("s").join(sizes.alias("o"), same("s", "o", [key])).select("s.*", "_size")

    def at(index: Column) -> Column:
        holds = (F.col("_upto") - F.col("_n") <= index) & (index < F.col("_upto"))
        return F.max(F.when(holds, F.col(value)))

    picked, result = [], []
    for name, p in probabilities.items():
        rank = (F.col("_size") - 1) * F.lit(float(p))
        picked += [
            at(F.floor(rank)).alias(f"_lo_{name}"),
            at(F.ceil(rank)).alias(f"_hi_{name}"),
            F.max(rank - F.floor(rank)).alias(f"_f_{name}"),
        ]
        lo, hi, f = (F.col(f"_{x}_{name}").cast("double") for x in ("lo", "hi", "f"))
        result.append((lo + (hi - lo) * f).alias(name))
    return joined.groupBy(key).agg(*picked).select(key, *result)
