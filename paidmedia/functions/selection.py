"""Exact order statistics, guided by sketches.

Finding the row of a rank needs no sort of the whole group.  One mergeable quantile sketch
per group brackets each rank; a second pass counts what lies between the brackets and keeps
only the rows inside them, about ``4 / ACCURACY`` of the group for each rank.  Ranks are
then looked up in these counts, so a result is exact whatever the sketch's error: should a
rank fall between the brackets, the group's rows are ranked in full.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.functions.scans import running_totals, same
from paidmedia.sources.store import materialise

#: Rank error of a sketch is one in so many rows.
ACCURACY = 10_000
#: Groups of so few rows are kept whole.
SMALL = 1000
#: Kept rows up to which one window ranks them; more are ranked in slices.
WINDOW_ROWS = 1_000_000


def _brackets(
    df: DataFrame, keys: Sequence[str], first: str, shares: Sequence[float], extra: Sequence[Column] = ()
) -> DataFrame:
    """(keys, _size, extra, _low, _high): group sizes and the bounds of each share's bracket; one row per group."""
    width, n = 2 / ACCURACY, len(shares)
    x = F.col(first).cast("double")
    asked = [min(1.0, max(0.0, p + d)) for d in (-width, width) for p in shares]
    sketched = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_size"), *extra, F.percentile_approx(x, asked, ACCURACY).alias("_at")
    )

    def bounds(start: int, beyond: float) -> Column:
        everything = F.array(*[F.lit(beyond)] * n)
        few = (F.col("_size") <= SMALL) | F.col("_at").isNull()
        return F.when(few, everything).otherwise(F.slice("_at", start, n))

    return sketched.select(
        *[c for c in sketched.columns if c != "_at"], bounds(1, float("-inf")).alias("_low"), bounds(n + 1, float("inf")).alias("_high")
    )


def _cells(df: DataFrame, brackets: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """(keys, _gap, _row, _n): every distinct row inside a bracket, and one cell for the rows before each.

    ``_gap`` counts the brackets that end before the row; a null ``_row`` stands for the rows
    below the next bracket, which come before those inside it.
    """
    x = F.coalesce(F.col(f"d.{order[0]}").cast("double"), F.lit(float("-inf")))
    inside, gap = F.lit(False), F.lit(0)
    for k in range(n):
        inside = inside | ((F.col("_low")[k] <= x) & (x <= F.col("_high")[k]))
        gap = gap + F.when(F.col("_high")[k] < x, 1).otherwise(0)
    row = F.struct(*[F.col(f"d.{c}").alias(c) for c in order])
    return (
        df.alias("d")
        .join(brackets.alias("b"), same("d", "b", keys))
        .groupBy(*[F.col(f"d.{k}").alias(k) for k in keys], gap.alias("_gap"), F.when(inside, row).alias("_row"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _ranked(cells: DataFrame, keys: Sequence[str], slices: int | None) -> DataFrame:
    """Cells with ``_upto``, the rows of the group up to the cell's last one."""
    cells, order = materialise(cells, "cells"), ["_gap", "_row"]
    if slices or cells.count() > WINDOW_ROWS:
        return running_totals(cells, keys, order, {"_upto": "_n"}, slices)
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return cells.withColumn("_upto", F.sum("_n").over(upto))


def _looked_up(
    ranked: DataFrame, brackets: DataFrame, keys: Sequence[str], ranks: Callable[[Column], list[Column]]
) -> DataFrame:
    """(keys, _size, extra, _s0, _s1, ...): the row of each rank, null where it lies before a bracket."""
    given = [c for c in brackets.columns if c not in (*keys, "_low", "_high")]
    joined = ranked.alias("c").join(brackets.alias("b"), same("c", "b", keys)).select("c.*", *[f"b.{c}" for c in given])
    start, end = F.col("_upto") - F.col("_n"), F.col("_upto") - 1
    picked = [
        F.max(F.when(rank.between(start, end), F.col("_row"))).alias(f"_s{k}") for k, rank in enumerate(ranks(F.col("_size")))
    ]
    return joined.groupBy(*keys, *given).agg(*picked)


def order_statistics(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    shares: Sequence[float],
    ranks: Callable[[Column], list[Column]],
    slices: int | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """(keys, _size, extra, _s0, _s1, ...): structs of ``order`` at the given ranks of each group.

    ``shares`` are roughly where the ranks lie, from 0 to 1; ``ranks`` gives them, from 0, for
    a group's size.  The first column of ``order`` is a number.  Rows sort as in a window,
    nulls first; groups may be null.  ``extra`` are aggregates of the group that the pass of
    the sketch computes as well.
    """
    brackets = materialise(_brackets(df, keys, order[0], shares, extra), "brackets")
    found = materialise(_looked_up(_ranked(_cells(df, brackets, keys, order, len(shares)), keys, slices), brackets, keys, ranks), "ranks")
    n = len(ranks(F.col("_size")))
    missed = F.lit(False)
    for k in range(n):
        missed = missed | F.col(f"_s{k}").isNull()
    if found.where(missed).limit(1).count() == 0:
        return found
    # The sketch missed a rank: every row is its own cell.
    row = F.struct(*order)
    full = df.groupBy(*keys, row.alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    return _looked_up(running_totals(full, keys, ["_row"], {"_upto": "_n"}, slices), brackets, keys, ranks)


def exact_quantiles(
    df: DataFrame,
    key: str,
    value: str,
    probabilities: dict[str, float],
    slices: int | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Exact linearly interpolated quantiles of the non-null values of each group, and ``extra`` aggregates."""
    known = df.where(F.col(value).isNotNull())
    places = list(probabilities.values())

    def ranks(size: Column) -> list[Column]:
        at = [(size - 1) * F.lit(float(p)) for p in places]
        return [r for a in at for r in (F.floor(a), F.ceil(a))]

    found = order_statistics(known, [key], [value], places, ranks, slices, extra)
    out = [F.col(c) for c in found.columns if c not in (key, "_size") and not c.startswith("_s")]
    for k, (name, p) in enumerate(probabilities.items()):
        low, high = (F.col(f"_s{2 * k + d}")[value].cast("double") for d in (0, 1))
        rank = (F.col("_size") - 1) * F.lit(float(p))
        out.append((low + (high - low) * (rank - F.floor(rank))).alias(name))
    return found.select(key, *out)


def bucketed(
    df: DataFrame, buckets: int, keys: Sequence[str], order: Sequence[str], name: str, slices: int | None = None
) -> DataFrame:
    """NTILE: equal-sized buckets per group, the first ones larger by one, by their limits.

    Each row is compared with the last rows of the buckets, one small row per group, so the
    table itself is neither sorted nor shuffled.  ``order`` is a total order of a group that
    starts with a number.
    """

    def ranks(size: Column) -> list[Column]:
        small, rest = F.floor(size / buckets), size % buckets
        ends = [small * j + F.least(rest, F.lit(j)) - 1 for j in range(1, buckets)]
        return [F.greatest(e, F.lit(0)).cast("long") for e in ends]

    limits = order_statistics(df, keys, order, [j / buckets for j in range(1, buckets)], ranks, slices)
    row = F.struct(*[F.col(f"d.{c}").alias(c) for c in order])
    bucket = F.lit(1)
    for k in range(buckets - 1):
        bucket = bucket + F.when(row > F.col(f"l._s{k}"), 1).otherwise(0)
    return (
        df.alias("d")
        .join(limits.alias("l"), same("d", "l", keys))
        .select(*[F.col(f"d.{c}") for c in df.columns], bucket.cast("int").alias(name))
    )
