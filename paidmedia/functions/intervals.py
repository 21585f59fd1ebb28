"""Interval joins: points that lie inside the intervals of the other side, key by key.

Spark joins a range condition by comparing every pair of rows with the same key, and a
single key may hold a third of all rows.  Here both sides are cut into buckets as wide as
the interval usually is: a point lies in one bucket, an interval visits the two or three
that it meets, and the join is an equi-join on (key, bucket) with the exact bounds as its
condition.  A bucket with more than ``HOT_ROWS`` points is split by a second hash of the
point's row: its points are dealt to the parts and the intervals visit each part.

``low``, ``high`` and ``point`` are whole numbers (days, microseconds); both bounds belong
to the interval.  Rows with a null key, bound or point match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidmedia.sources.store import materialise

#: Points of one (key, bucket) that a task gets at most, on average.
HOT_ROWS = 100_000


def _bucket(at: Column, width: int) -> Column:
    return F.floor(at / F.lit(width)) if width > 1 else at


def _hot(points: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """(keys, _bucket, _parts) of the buckets to split: one row per ``hot_rows`` points at most."""
    return (
        points.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > hot_rows)
        .select(*keys, "_bucket", F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias("_parts"))
    )


def _dealt(
    intervals: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    bounds: tuple[str, str],
    point: str,
    width: int,
    hot_rows: int,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_bucket`` and ``_part``; an interval once for each part that it visits."""
    low, high = (F.col(b) for b in bounds)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    placed = points.where(known & F.col(point).isNotNull()).withColumn("_bucket", _bucket(F.col(point), width))
    # Written, so that Spark broadcasts it by its measured size.
    hot = materialise(_hot(placed, keys, hot_rows), "hot")
    row = F.xxhash64(*[F.col(c) for c in points.columns])
    dealt = placed.join(hot, [*keys, "_bucket"], "left").withColumn(
        "_part", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(row, F.col("_parts"))).cast("int")
    )
    visits = intervals.withColumn(
        "_bucket",
        F.explode_outer(F.when(known & (low <= high), F.sequence(_bucket(low, width), _bucket(high, width)))),
    )
    split = visits.join(hot, [*keys, "_bucket"], "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    )
    return split.drop("_parts"), dealt.drop("_parts")


def _inside(keys: Sequence[str], bounds: tuple[str, str], point: str) -> Column:
    cond = F.col(f"p.{point}").between(F.col(f"i.{bounds[0]}"), F.col(f"i.{bounds[1]}"))
    for k in [*keys, "_bucket", "_part"]:
        cond = cond & (F.col(f"i.{k}") == F.col(f"p.{k}"))
    return cond


def interval_pairs(
    intervals: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    bounds: tuple[str, str],
    point: str,
    width: int,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every pair of an interval and a point inside it, as ``i`` and ``p`` columns of an inner join."""
    left, right = _dealt(intervals, points, keys, bounds, point, width, hot_rows)
    return left.alias("i").join(right.alias("p"), _inside(keys, bounds, point))


def interval_totals(
    intervals: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    bounds: tuple[str, str],
    point: str,
    width: int,
    totals: Sequence[Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per interval, without a match too, with aggregates over its points (``p`` columns).

    ``intervals`` has distinct rows.  Each visited part sums up before the totals meet, so an
    interval over hot buckets never has its points in one task.
    """
    left, right = _dealt(intervals, points, keys, bounds, point, width, hot_rows)
    joined = left.alias("i").join(right.alias("p"), _inside(keys, bounds, point), "left")
    return joined.groupBy(*[F.col(f"i.{c}").alias(c) for c in intervals.columns]).agg(*totals)

