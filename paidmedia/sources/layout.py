"""Z-order: a layout that prunes files by any of several columns, not by the first alone.

Each column becomes a rank of few bits that rises with it; the bits of all ranks are taken
in turn, the highest first, into one key.  Rows are range-partitioned and sorted by the key,
so each file and row group spans a small box in all columns, and the minima and maxima that
Parquet keeps of them rule most boxes out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidmedia.sources import schema

#: Bits of a rank that is cut from quantiles: 64 ranges of equal counts.
QUANTILE_BITS = 6
#: Columns of the fact with a closed domain; ranks follow the text, as the statistics do.
DOMAINS = {
    "channel": sorted(schema.CHANNELS),
    "campaign_type": sorted(schema.CAMPAIGN_TYPES),
    "creative_type": sorted(schema.CREATIVE_TYPES),
}


def bits_for(values: int) -> int:
    return max(1, (values - 1).bit_length())


def domain_rank(column: str, values: Sequence[str]) -> Column:
    """Place of the column's value among sorted values, spread evenly over the rank's bits.

    Spread, the highest bit halves the values instead of setting the last ones apart.  A value
    outside the list goes where it sorts, so ranks rise with any text; null is 0.
    """
    room = 1 << bits_for(len(values))
    rank = F.lit(0)
    for place, v in enumerate(values[:-1], start=1):
        rank = F.when(F.col(column) > v, place * room // len(values)).otherwise(rank)
    return rank.cast("long")


def quantile_rank(measure: Column, bounds: Sequence) -> Column:
    """How many of the bounds lie below the value; null is 0."""
    if not bounds:
        return F.lit(0).cast("long")
    below = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < measure))
    return F.when(measure.isNull(), F.lit(0)).otherwise(below).cast("long")


def interleaved(ranks: Sequence[tuple[Column, int]]) -> Column:
    """One key of ranks and their bits, a bit of each in turn from the highest down.

    A rank of fewer bits is used up sooner.  More than 63 bits in all are an error.
    """
    if sum(bits for _, bits in ranks) > 63:
        raise ValueError("a key holds 63 bits")
    key = F.lit(0).cast("long")
    for turn in range(max(bits for _, bits in ranks)):
        for rank, bits in ranks:
            if turn < bits:
                bit = F.shiftright(rank, bits - 1 - turn).bitwiseAND(F.lit(1).cast("long"))
                key = F.shiftleft(key, 1).bitwiseOR(bit)
    return key


def z_key(
    df: DataFrame,
    quantiled: Sequence[str] = ("date",),
    domains: Mapping[str, Sequence[str]] = DOMAINS,
    bits: int = QUANTILE_BITS,
) -> Column:
    """The key of each row of ``df``: columns by quantiles first in each turn, then closed domains.

    The quantiles are one mergeable aggregate over ``df``; 2^bits - 1 bounds a column come to
    the driver, whatever the rows.
    """
    ranks = []
    if quantiled:
        shares = [k / 2**bits for k in range(1, 2**bits)]
        kinds = dict(df.dtypes)
        # Dates have quantiles as days.
        measure = {c: F.unix_date(c) if kinds[c] == "date" else F.col(c) for c in quantiled}
        found = df.agg(*[F.percentile_approx(measure[c], shares).alias(c) for c in quantiled]).first()
        ranks = [(quantile_rank(measure[c], found[c] or []), bits) for c in quantiled]
    ranks += [(domain_rank(c, values), bits_for(len(values))) for c, values in domains.items()]
    return interleaved(ranks)


def z_ordered(fact: DataFrame, partitions: int | None = None, **options) -> DataFrame:
    """``fact`` in Z-order, to be written; ``options`` are those of ``z_key``.

    Rows of one key go on by the grain, so no box is too large for one partition.
    """
    key = z_key(fact, **options)
    counts = [] if partitions is None else [partitions]
    return fact.repartitionByRange(*counts, key, *schema.GRAIN).sortWithinPartitions(key, *schema.GRAIN)
