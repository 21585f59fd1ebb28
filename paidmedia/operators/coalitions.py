"""Sets of channels: what occurs together, and what a channel adds to the others.

Days and journeys are counted per distinct set first, a bitmask of at most 2**channels
values; everything else is a transform over these few rows (``functions/subsets.py``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.functions.exprs import double, paid, rounded, rounded_ratio, with_spend
from paidmedia.functions.subsets import all_masks, mask_of, members_of, subset_sums, superset_sums
from paidmedia.sources import schema
from paidmedia.sources.touchpoints import EVENT_CHANNELS, UNKNOWN

SET_SEPARATOR = " + "
PLAYERS = [*EVENT_CHANNELS, UNKNOWN]
WIDE = "decimal(38,2)"
PERMUTATIONS = 4096
SEED = 29


def _lift(count: str, domain: Sequence[str]) -> Column:
    """How much more often a set occurs than its members would if they were independent.

    The window runs over the lattice: one row per set.
    """
    every = Window.partitionBy()
    total = F.max(F.when(F.col("mask") == 0, F.col(count))).over(every)
    expected = F.lit(1.0)
    for k in range(len(domain)):
        alone = F.max(F.when(F.col("mask") == 1 << k, F.col(count))).over(every)
        held = F.col("mask").bitwiseAND(F.lit(1 << k)) != 0
        expected = expected * F.when(held, double(alone) / double(total)).otherwise(F.lit(1.0))
    return rounded(F.try_divide(double(count) / double(total), expected), 4)


def _size(mask: Column) -> Column:
    return F.bit_count(mask).cast("int")


def channel_sets(fact: DataFrame, channels: Sequence[str] = tuple(schema.PAID_CHANNELS)) -> DataFrame:
    """Every set of two or more paid channels by the days on which all of them spent.

    Spend and revenue are those of the set's own channels on these days.
    """
    days = (
        with_spend(paid(fact))
        .where(F.col("channel").isin(*channels))
        .groupBy("date", "channel")
        .agg(F.sum("spend_gbp").cast(WIDE).alias("spend"), F.sum("revenue_gbp").cast(WIDE).alias("revenue"))
    )
    own = [F.col("channel") == c for c in channels]
    bit = F.lit(0).cast("long")
    for k, is_own in enumerate(own):
        bit = F.when(is_own, F.lit(1 << k).cast("long")).otherwise(bit)
    zero = F.lit(0).cast(WIDE)
    per_day = days.groupBy("date").agg(
        F.bit_or(bit).alias("mask"),
        *[F.sum(F.when(o, F.col(m)).otherwise(zero)).cast(WIDE).alias(f"{m}_{k}") for k, o in enumerate(own) for m in ("spend", "revenue")],
    )
    measures = ["days", *[f"{m}_{k}" for k in range(len(channels)) for m in ("spend", "revenue")]]
    lattice = superset_sums(per_day.withColumn("days", F.lit(1).cast("long")).drop("date"), "mask", len(channels), measures)

    def own_sum(measure: str) -> Column:
        total = zero
        for k in range(len(channels)):
            held = F.col("mask").bitwiseAND(F.lit(1 << k)) != 0
            total = total + F.when(held, F.col(f"{measure}_{k}")).otherwise(zero)
        return total.cast(WIDE)

    found = lattice.withColumns({"lift": _lift("days", channels), "spend": own_sum("spend"), "revenue": own_sum("revenue")})
    return (
        found.where(_size(F.col("mask")) > 1)
        .select(
            F.array_join(F.array_sort(members_of(F.col("mask"), channels)), SET_SEPARATOR).alias("channel_set"),
            _size(F.col("mask")).alias("size"),
            "days",
            rounded("spend", 0).alias("combined_spend"),
            rounded("revenue", 0).alias("combined_revenue"),
            rounded_ratio("revenue", "spend", 3).alias("combined_roas"),
            "lift",
        )
        .orderBy("size", "channel_set")
    )


def journey_sets(journeys: DataFrame, channels: Sequence[str] = tuple(PLAYERS)) -> DataFrame:
    """Every set of two or more channels by the converting journeys that touched all of them."""
    each = journeys.select(
        mask_of(F.col("channels"), channels).alias("mask"),
        F.lit(1).cast("long").alias("journeys"),
        F.col("revenue").cast(WIDE).alias("revenue"),
    )
    lattice = superset_sums(each, "mask", len(channels), ["journeys", "revenue"])
    return (
        lattice.withColumn("lift", _lift("journeys", channels))
        .where(_size(F.col("mask")) > 1)
        .select(
            F.array_join(F.array_sort(members_of(F.col("mask"), channels)), SET_SEPARATOR).alias("channel_set"),
            _size(F.col("mask")).alias("size"),
            "journeys",
            double("revenue").alias("revenue"),
            "lift",
        )
        .orderBy("size", "channel_set")
    )


def touched_sets(numbered: DataFrame, channels: Sequence[str] = tuple(PLAYERS)) -> DataFrame:
    """(mask, journeys, conversions) by distinct set: journeys with a touch, converting or not.

    Touches are summed per journey into one bitmask, whatever the journey's length.
    """
    bit = F.lit(0).cast("long")
    for k, name in enumerate(channels):
        bit = F.when(F.col("channel") == name, F.lit(1 << k).cast("long")).otherwise(bit)
    per_journey = numbered.groupBy("customer_id", "journey_no").agg(
        F.bit_or(bit).alias("mask"),
        F.max("is_conversion").alias("converted"),
        F.max("is_touch").alias("touched"),
    )
    return (
        per_journey.where("touched = 1")
        .groupBy("mask")
        .agg(F.count(F.lit(1)).alias("journeys"), F.sum("converted").alias("conversions"))
    )


def conversion_worth(numbered: DataFrame, channels: Sequence[str] = tuple(PLAYERS)) -> DataFrame:
    """(mask, worth) of every coalition: the conversion rate of the journeys inside it, 0 without any."""
    inside = subset_sums(touched_sets(numbered, channels), "mask", len(channels), ["journeys", "conversions"])
    rate = F.coalesce(F.try_divide(double("conversions"), double("journeys")), F.lit(0.0))
    return all_masks(numbered.sparkSession, len(channels)).join(inside, "mask", "left").select("mask", rate.alias("worth"))


def _gains(steps: DataFrame, worth: DataFrame) -> DataFrame:
    """``steps`` (mask before, player k) with what the player adds there."""
    after = F.col("mask").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("k")))
    with_before = steps.join(worth.withColumnRenamed("worth", "before"), "mask")
    ahead = worth.select(F.col("mask").alias("joined"), F.col("worth").alias("with_player"))
    return with_before.withColumn("joined", after).join(ahead, "joined").withColumn("gain", F.col("with_player") - F.col("before"))


def shapley_conversion(worth: DataFrame, channels: Sequence[str] = tuple(PLAYERS)) -> DataFrame:
    """(channel, k, value): exact Shapley values of a worth of all masks, by enumeration."""
    n = len(channels)
    weights = F.array(*[F.lit(math.factorial(s) * math.factorial(n - s - 1) / math.factorial(n)) for s in range(n)])
    steps = worth.select("mask", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k")).where(
        F.col("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("k"))) == 0
    )
    weighed = _gains(steps, worth).withColumn("part", F.get(weights, _size(F.col("mask"))) * F.col("gain"))
    return weighed.groupBy("k").agg(F.sum(F.col("part").cast("decimal(38,18)")).cast("double").alias("value")).select(
        F.get(F.array(*[F.lit(c) for c in channels]), F.col("k")).alias("channel"), "k", "value"
    )


def shapley_sampled(
    worth: DataFrame, channels: Sequence[str] = tuple(PLAYERS), permutations: int = PERMUTATIONS, seed: int = SEED
) -> DataFrame:
    """(channel, k, estimate, standard_error) from random orders in which channels join.

    An order is the ranking of the channels by a hash of (seed, order, channel), so equal
    calls give equal estimates.  The work is ``permutations`` times the channels, whatever
    the number of coalitions; each step looks up two worths.
    """
    n = len(channels)
    ranked = F.transform(
        F.array_sort(F.array(*[F.struct(F.xxhash64(F.lit(seed), "id", F.lit(k)).alias("h"), F.lit(k).alias("k")) for k in range(n)])),
        lambda s: s["k"],
    )
    orders = worth.sparkSession.range(permutations).withColumn("order", ranked)
    before = F.aggregate(
        F.slice(F.col("order"), F.lit(1), F.col("at")),
        F.lit(0).cast("long"),
        lambda m, k: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), k)),
    )
    steps = orders.select("id", "order", F.posexplode("order").alias("at", "k")).select("k", before.alias("mask"))
    return (
        _gains(steps, worth)
        .groupBy("k")
        .agg(F.avg("gain").alias("estimate"), (F.stddev_samp("gain") / math.sqrt(permutations)).alias("standard_error"))
        .select(F.get(F.array(*[F.lit(c) for c in channels]), F.col("k")).alias("channel"), "k", "estimate", "standard_error")
    )


def shapley_conversion_report(worth: DataFrame, channels: Sequence[str] = tuple(PLAYERS)) -> DataFrame:
    """Each channel's share of the conversion rate, largest first."""
    value = shapley_conversion(worth, channels)
    return value.select("channel", rounded("value", 6).alias("shapley_value")).orderBy(F.desc("shapley_value"), "channel")


def shapley_sampled_check(worth: DataFrame, channels: Sequence[str] = tuple(PLAYERS), errors: float = 4.0) -> DataFrame:
    """The enumerated value of each channel, and whether the sampled one lies within ``errors`` standard errors."""
    near = F.abs(F.col("estimate") - F.col("value")) <= F.lit(errors) * F.col("standard_error") + F.lit(1e-12)
    joined = shapley_conversion(worth, channels).join(shapley_sampled(worth, channels).drop("channel"), "k")
    return joined.select("channel", rounded("value", 6).alias("shapley_value"), near.alias("sampled_agrees")).orderBy("channel")
