"""Bloom filters of join keys, so that rows without a partner go before the shuffle.

The filter is a table of 64-bit words: a key's hash names one word and ``PROBES`` bits of
it, and the words of all keys are one aggregate, ``bit_or``.  It has at most ``words`` words
whatever the number of keys, so it is broadcast, ``BLOCK`` words a row; a fuller filter lets
more rows through and never drops a partner.  An exact semi-join follows, and is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidmedia.functions.joins import shuffled

#: Words of a filter at most: 8 MB.
MOST_WORDS = 1 << 20
#: Words of a row: one a row, they would be five times their bytes, which the driver builds.
BLOCK = 1 << 10
#: Keys that share a word on average: eight bits a key, of which each sets three.
KEYS_PER_WORD = 8
PROBES = 3


def words_for(keys: int) -> int:
    """A power of two, so that filters of different tables can be combined."""
    return min(MOST_WORDS, 1 << (max(64, -(-keys // KEYS_PER_WORD)) - 1).bit_length())


def _word(keys: Sequence[str | Column], words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(words))


def _bits(keys: Sequence[str | Column]) -> Column:
    bits = F.lit(0).cast("long")
    for seed in range(1, PROBES + 1):
        place = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(64)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


def bloom_filter(df: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """(block, its words in order): an aggregate over the keys, with partial words before the shuffle."""
    named = df.select(_word(keys, words).alias("_word"), _bits(keys).alias("_bits"))
    # Words without a key are 0, so that a word's place in its block follows from its number.
    empty = df.sparkSession.range(words).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    each = named.unionByName(empty).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    block = F.floor(F.col("_word") / BLOCK).alias("_block")
    return each.groupBy(block).agg(F.sort_array(F.collect_list(F.struct("_word", "_bits")))["_bits"].alias("_words"))


def may_match(df: DataFrame, bloom: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """The rows of ``df`` whose keys may be in the filter, their own columns only."""
    probe = df.withColumn("_probe", _word([F.col(k) for k in keys], words))
    wanted = _bits([F.col(k) for k in keys])
    bits = F.get("_words", (F.col("_probe") % BLOCK).cast("int"))
    # The filter has ``words`` words at most, MOST_WORDS by construction.
    return (
        probe.join(F.broadcast(bloom), F.floor(F.col("_probe") / BLOCK) == F.col("_block"))
        .where(bits.bitwiseAND(wanted) == wanted)
        .select(*df.columns)
    )


def semi_join(
    df: DataFrame, build: DataFrame, keys: Sequence[str], condition: Column | None = None, words: int | None = None
) -> DataFrame:
    """Rows of ``df`` with a partner in ``build``: the filter first, then an exact left semi-join.

    ``condition`` may compare columns of ``d`` (this side) and ``b`` (the build side).  Null
    keys match nothing.
    """
    if words is None:
        words = words_for(build.select(F.approx_count_distinct(F.xxhash64(*keys))).first()[0])
    sieved = may_match(df, bloom_filter(build, keys, words), keys, words)
    cond = F.lit(True) if condition is None else condition
    for k in keys:
        cond = cond & (F.col(f"d.{k}") == F.col(f"b.{k}"))
    return sieved.alias("d").join(shuffled(build).alias("b"), cond, "left_semi")
