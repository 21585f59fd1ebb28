"""Customer journeys: touches before a conversion, their paths and their credit.

A journey table has one row per conversion with at least one touch before it.
Its ``channels`` list the distinct channels in the order of their first touch, so the
list is bounded by the number of channels however long the journey was.  Every single
touch, and with it the whole path, is in ``journey_touches``; whole paths are compared
by a fingerprint, never gathered into a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.functions.exprs import double, percent, ratio, rounded, rounded_ratio
from paidmedia.functions.scans import running_totals
from paidmedia.sources import dimensions
from paidmedia.sources.touchpoints import EVENT_CHANNELS

PATH_SEPARATOR = " > "
CREDIT = "decimal(38,10)"


def build_journeys(numbered: DataFrame) -> DataFrame:
    """Journeys from numbered touchpoints.

    Touches are summed per journey and channel first: a journey reaches the second
    sum as at most one row per channel, plus the row of its conversion.
    """
    is_touch = F.col("is_touch") == 1
    per_channel = numbered.groupBy("customer_id", "journey_no", "channel").agg(
        F.sum("is_touch").alias("touches"),
        F.min(F.when(is_touch, F.col("touch_no"))).alias("first_touch"),
        F.max(F.when(is_touch, F.col("touch_no"))).alias("last_touch"),
        F.max(F.when(F.col("is_conversion") == 1, F.col("event_id"))).alias("conversion_id"),
        F.max("revenue").alias("revenue"),
    )
    touched = F.col("touches") > 0
    step = F.when(touched, F.struct("first_touch", "channel"))
    return (
        per_channel.groupBy("customer_id", "journey_no")
        .agg(
            F.max("conversion_id").alias("conversion_id"),
            F.max("revenue").alias("revenue"),
            F.sum("touches").alias("touches"),
            F.max("last_touch").alias("last_touch"),
            F.array_sort(F.collect_list(step)).alias("steps"),
            F.max_by("channel", "last_touch").alias("last_channel"),
        )
        .filter(F.col("conversion_id").isNotNull() & (F.col("touches") > 0))
        .select(
            "customer_id",
            "journey_no",
            "conversion_id",
            "revenue",
            "touches",
            "last_touch",
            F.transform("steps", lambda s: s["channel"]).alias("channels"),
            F.element_at("steps", 1)["channel"].alias("first_channel"),
            "last_channel",
        )
    )


def journey_report(journeys: DataFrame) -> DataFrame:
    return journeys.select(
        "conversion_id",
        "customer_id",
        "journey_no",
        double("revenue").alias("revenue"),
        "touches",
        F.size("channels").alias("distinct_channels"),
        "first_channel",
        "last_channel",
        F.array_join("channels", PATH_SEPARATOR).alias("channel_order"),
    )


def journey_touches(numbered: DataFrame, journeys: DataFrame) -> DataFrame:
    """Every touch of every journey with its position in it.

    A shuffle join on customer and journey; no journey is gathered into one row.
    """
    ends = journeys.select("customer_id", "journey_no", "conversion_id", "touches", "last_touch")
    return (
        numbered.filter(F.col("is_touch") == 1)
        .join(ends, ["customer_id", "journey_no"])
        .select(
            "conversion_id",
            "customer_id",
            "event_id",
            (F.col("touches") - (F.col("last_touch") - F.col("touch_no"))).alias("position"),
            (F.col("last_touch") - F.col("touch_no")).alias("touches_to_last"),
            "channel",
        )
    )


def equal_split_weights(journeys: DataFrame) -> DataFrame:
    """Weight of each distinct channel of each journey; weights of a journey sum to 1."""
    return journeys.select(
        "conversion_id",
        F.explode("channels").alias("channel"),
        (F.lit(1.0) / F.size("channels")).alias("weight"),
    )


def _share_of_journeys(paths: DataFrame) -> DataFrame:
    """Revenue as DOUBLE and the share of all journeys; the window runs over paths."""
    every = Window.partitionBy()
    kept = [c for c in paths.columns if c not in ("journeys", "revenue")]
    return paths.withColumn("all_journeys", F.sum("journeys").over(every)).select(
        *kept,
        "journeys",
        double("revenue").alias("revenue"),
        percent("journeys", "all_journeys", 2).alias("share_pct"),
    )


def path_of_journey(touches: DataFrame) -> DataFrame:
    """(conversion_id, path_a, path_b): an order-sensitive fingerprint of each whole path.

    Two 64-bit hashes of (position, channel), each summed over the touches: partial sums
    combine before the shuffle, and a journey of any length is one row.
    """
    parts = [
        F.sum(F.xxhash64(F.lit(seed), "position", "channel").cast("decimal(20,0)")).alias(name)
        for seed, name in ((1, "path_a"), (2, "path_b"))
    ]
    return touches.groupBy("conversion_id").agg(*parts)


def _paths(journeys: DataFrame, touches: DataFrame) -> DataFrame:
    """Distinct whole paths; the smallest conversion of each stands for it."""
    return (
        journeys.join(path_of_journey(touches), "conversion_id")
        .groupBy("path_a", "path_b", "touches", "first_channel", "last_channel")
        .agg(
            F.min("conversion_id").alias("example_conversion_id"),
            F.count(F.lit(1)).alias("journeys"),
            F.sum("revenue").alias("revenue"),
        )
        .drop("path_a", "path_b")
    )


def path_frequency(journeys: DataFrame, touches: DataFrame) -> DataFrame:
    """Whole ordered paths by how often they lead to a conversion, and what they bring.

    A path is named by its smallest conversion; ``path_steps`` has its touches.
    """
    return _share_of_journeys(_paths(journeys, touches)).orderBy(
        F.desc("journeys"), "example_conversion_id"
    )


def path_steps(journeys: DataFrame, touches: DataFrame) -> DataFrame:
    """The touches of each distinct path, one row each."""
    named = _paths(journeys, touches).select("example_conversion_id")
    return touches.join(named, F.col("conversion_id") == F.col("example_conversion_id")).select(
        "example_conversion_id", "position", "channel"
    )


def journey_prefixes(numbered: DataFrame, slices: int | None = None) -> DataFrame:
    """Every touch of every journey, converting or not, with fingerprints of the path up to it.

    The fingerprint of a prefix is that of the prefix before it plus two hashes of (position,
    channel): a running sum, so a journey of any length stays rows, dealt to many slices.
    """
    touched = F.col("is_touch") == 1
    whole = numbered.groupBy("customer_id", "journey_no").agg(
        F.min(F.when(touched, F.col("touch_no"))).alias("first_no"),
        F.sum("is_touch").alias("touches"),
        F.max("is_conversion").alias("converted"),
        F.max("revenue").alias("revenue"),
    )
    placed = (
        numbered.filter(touched)
        .select("customer_id", "journey_no", "touch_no", "event_id", "channel")
        .join(whole, ["customer_id", "journey_no"])
        .withColumn("position", F.col("touch_no") - F.col("first_no") + 1)
    )
    for seed, name in ((1, "step_a"), (2, "step_b")):
        placed = placed.withColumn(name, F.xxhash64(F.lit(seed), "position", "channel").cast("decimal(20,0)"))
    return running_totals(
        placed, ["customer_id", "journey_no"], ["position"], {"path_a": "step_a", "path_b": "step_b"}, slices
    )


def path_trie(prefixes: DataFrame) -> DataFrame:
    """The trie of all paths as a table: a node per distinct prefix, with who went on and who was lost.

    A node is named by its smallest event and names its parent in the same way.  ``lost`` are
    journeys that end here without a conversion, ``drop_off_pct`` their share of the node's.
    Journeys with the same prefix share its row, and no path is gathered.
    """
    ends = F.col("position") == F.col("touches")
    nodes = prefixes.groupBy("path_a", "path_b", "position").agg(
        F.min("event_id").alias("node_id"),
        F.max("channel").alias("channel"),
        F.max(F.col("path_a") - F.col("step_a")).alias("above_a"),
        F.max(F.col("path_b") - F.col("step_b")).alias("above_b"),
        F.count(F.lit(1)).alias("journeys"),
        F.sum("converted").alias("conversions"),
        F.count_if(ends & (F.col("converted") == 1)).alias("converted_here"),
        F.count_if(ends & (F.col("converted") == 0)).alias("lost"),
        F.sum(F.col("revenue")).alias("revenue"),
    )
    above = nodes.select(
        F.col("path_a").alias("above_a"),
        F.col("path_b").alias("above_b"),
        (F.col("position") + 1).alias("position"),
        F.col("node_id").alias("parent_id"),
    )
    return nodes.join(above, ["above_a", "above_b", "position"], "left").select(
        "node_id",
        "parent_id",
        F.col("position").alias("depth"),
        "channel",
        "journeys",
        "conversions",
        "converted_here",
        "lost",
        F.coalesce(double("revenue"), F.lit(0.0)).alias("revenue"),
        rounded_ratio("lost", "journeys", 2, 100).alias("drop_off_pct"),
    )


def channel_order_frequency(journeys: DataFrame) -> DataFrame:
    """Journeys by the order in which their distinct channels came first."""
    orders = journeys.groupBy(
        F.array_join("channels", PATH_SEPARATOR).alias("channel_order"),
        "first_channel",
        "last_channel",
    ).agg(F.count(F.lit(1)).alias("journeys"), F.sum("revenue").alias("revenue"))
    return _share_of_journeys(orders).orderBy(F.desc("journeys"), "channel_order", "last_channel")


def journey_credit(journeys: DataFrame) -> DataFrame:
    """Last-click and equal-split revenue per channel over real journeys.

    Revenue is summed per channel and number of channels before it is divided, so the
    split loses nothing to rounding below the tenth digit.  The four named channels are
    always listed, and the unknown one where it has credit, so that credit sums to revenue.
    """
    length = F.size("channels")
    touched = journeys.select(
        F.explode("channels").alias("channel"), length.alias("n"), "revenue", "last_channel"
    )
    last = F.col("channel") == F.col("last_channel")
    per_length = touched.groupBy("channel", "n").agg(
        F.count(F.lit(1)).alias("journeys"),
        F.sum("revenue").alias("revenue"),
        F.sum(F.when(last, F.col("revenue"))).alias("lc"),
    )
    credit = per_length.groupBy("channel").agg(
        F.sum("journeys").alias("journeys"),
        F.sum("lc").alias("lc"),
        F.sum(ratio("revenue", "n").cast(CREDIT)).alias("sv"),
    )
    named = dimensions.channels(journeys.sparkSession, EVENT_CHANNELS)
    lc, sv = F.col("last_click_revenue"), F.col("shapley_revenue")
    return (
        named.join(credit, "channel", "full")
        .select(
            "channel",
            F.coalesce("journeys", F.lit(0)).cast("bigint").alias("journeys"),
            F.coalesce(double("lc"), F.lit(0.0)).alias("last_click_revenue"),
            F.coalesce(rounded("sv", 6), F.lit(0.0)).alias("shapley_revenue"),
        )
        .withColumn("delta_pct", F.when(lc > 0, rounded(F.try_divide(sv - lc, lc) * 100, 4)))
    )


def shapley_exact(journeys: DataFrame) -> DataFrame:
    """Shapley value of each channel, worth of a coalition = revenue it covers alone.

    The game is a sum of unanimity games, one per distinct set of channels, so its
    value is the equal split of each set's revenue: no coalition is enumerated.
    """
    sets = journeys.groupBy(F.array_sort("channels").alias("members")).agg(
        F.sum("revenue").alias("worth")
    )
    value = sets.select(
        F.explode("members").alias("channel"),
        (double("worth") / F.size("members")).cast(CREDIT).alias("part"),
    ).groupBy("channel").agg(F.sum("part").alias("value"))
    every = Window.partitionBy()
    return value.select(
        "channel",
        rounded("value", 4).alias("shapley_value"),
        rounded(ratio("value", F.sum("value").over(every)) * 100, 4).alias("share_pct"),
    )
