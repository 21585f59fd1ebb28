"""Sums over all subsets or supersets of sets that are bitmasks.

Rows are (mask, measures): one per distinct set, so at most 2**bits of them.  A transform
adds one bit after the other: a row also counts for the mask with the bit set (subsets) or
cleared (supersets).  ``STEP`` bits are taken between two sums, so a row becomes 2**STEP
rows at most at a time, and no pair of sets is compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEP = 5


def mask_of(members: Column, domain: Sequence[str]) -> Column:
    """The bitmask of an array of members; bit k is the k-th of ``domain``."""
    mask = F.lit(0).cast("long")
    for k, name in enumerate(domain):
        bit = F.when(F.array_contains(members, name), F.lit(1 << k)).otherwise(F.lit(0))
        mask = mask.bitwiseOR(F.coalesce(bit, F.lit(0)).cast("long"))
    return mask


def members_of(mask: Column, domain: Sequence[str]) -> Column:
    """The members of a bitmask, in the order of ``domain``."""
    return F.array_compact(
        F.array(*[F.when(mask.bitwiseAND(F.lit(1 << k)) != 0, F.lit(name)) for k, name in enumerate(domain)])
    )


def _steps(bits: int) -> list[list[int]]:
    return [list(range(k, min(bits, k + STEP))) for k in range(0, bits, STEP)]


def _with_flipped(masks: Column, bit: Column, sets: bool) -> Column:
    """The masks, and those with the bit free (unset for subsets, set for supersets) once more, flipped."""

    def free(m: Column) -> Column:
        return (m.bitwiseAND(bit) == 0) == F.lit(sets)

    return F.concat(masks, F.transform(F.filter(masks, free), lambda m: m.bitwiseXOR(bit)))


def _spread(df: DataFrame, mask: str, bits: Sequence[int], sets: bool) -> DataFrame:
    """Each row once for every choice of its free bits: unset ones to set, or set ones to clear."""
    masks = F.array(F.col(mask))
    for k in bits:
        masks = _with_flipped(masks, F.lit(1 << k).cast("long"), sets)
    return df.withColumn(mask, F.explode(masks))


def _transform(df: DataFrame, mask: str, bits: int, measures: Sequence[str], sets: bool) -> DataFrame:
    sums = [F.sum(m).cast(dict(df.dtypes)[m]).alias(m) for m in measures]
    out = df.groupBy(mask).agg(*sums)
    for step in _steps(bits):
        out = _spread(out, mask, step, sets).groupBy(mask).agg(*sums)
    return out


def subset_sums(df: DataFrame, mask: str, bits: int, measures: Sequence[str]) -> DataFrame:
    """(mask, measures) of every coalition that holds a set: the sums over the sets within it."""
    return _transform(df, mask, bits, measures, True)


def superset_sums(df: DataFrame, mask: str, bits: int, measures: Sequence[str]) -> DataFrame:
    """(mask, measures) of every subset of a set: the sums over the sets that hold it."""
    return _transform(df, mask, bits, measures, False)


def all_masks(spark: SparkSession, bits: int) -> DataFrame:
    return spark.range(1 << bits).withColumnRenamed("id", "mask")
