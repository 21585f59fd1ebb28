"""Distinct counts of many cells from mergeable bitmaps: the rows are read once for all levels.

An id is one bit of a bucket of 32,768 ids, so a cell's ids are a few binary rows of 4 kB.
The finest cells are built with partial bitmaps before the shuffle and written; each coarser
level is the bitwise OR of a level above it, and its counts are exact.  A cell with any
number of ids is split by bucket, so no row or group grows with the data.

Ids are whole numbers that lie close together, like keys and day numbers: an id alone in its
bucket costs 4 kB.  Null ids do not count, but their rows make a cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidmedia.sources.store import materialise

LEVEL_SEPARATOR = ","


def bitmaps(df: DataFrame, keys: Sequence[str], ids: Mapping[str, Column]) -> DataFrame:
    """(keys, measure, bucket, bits) of every measure in ``ids``."""
    pairs = [F.struct(F.lit(name).alias("measure"), c.cast("bigint").alias("id")) for name, c in ids.items()]
    rows = df.select(*keys, F.explode(F.array(*pairs)).alias("pair")).select(
        *keys,
        "pair.measure",
        F.coalesce(F.bitmap_bucket_number("pair.id"), F.lit(0)).alias("bucket"),
        F.bitmap_bit_position("pair.id").alias("bit"),
    )
    return rows.groupBy(*keys, "measure", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser cells."""
    return cells.groupBy(*keys, "measure", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(cells: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per cell with a distinct count for each measure."""
    one = F.bitmap_count("bits")
    return cells.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("measure") == m, one)), F.lit(0)).alias(m) for m in measures]
    )


def distinct_by_level(
    df: DataFrame, levels: Sequence[Sequence[str]], ids: Mapping[str, Column]
) -> DataFrame:
    """Distinct ids per cell of every level; the first level is the finest and holds all keys.

    ``level`` names the keys of a row's level; its other keys are null.
    """
    finest = list(levels[0])
    done = {tuple(finest): materialise(bitmaps(df, finest, ids), "bitmaps")}
    kinds = {f.name: f.dataType for f in done[tuple(finest)].schema.fields}
    for level in levels[1:]:
        above = [k for k in done if set(level) <= set(k)]
        if not above:
            raise ValueError(f"{level} has keys that the first level has not")
        done[tuple(level)] = merged(done[min(above, key=len)], level)

    def rows(level: tuple[str, ...], cells: DataFrame) -> DataFrame:
        found = counts(cells, level, list(ids))
        return found.select(
            F.lit(LEVEL_SEPARATOR.join(level)).alias("level"),
            *[F.col(k) if k in level else F.lit(None).cast(kinds[k]).alias(k) for k in finest],
            *ids,
        )

    return reduce(DataFrame.unionByName, [rows(level, cells) for level, cells in done.items()])
