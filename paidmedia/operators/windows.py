"""Raw rows inside the time windows of others: cohorts and their orders, conversions and their touches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidmedia.functions.bloom import semi_join
from paidmedia.functions.exprs import double, month_start, rounded, rounded_ratio
from paidmedia.functions.intervals import HOT_ROWS, interval_totals
from paidmedia.sources.fact import order_touches

VALUE = "decimal(28,2)"
MICROS_PER_DAY = 86_400_000_000


def _placed(orders: DataFrame) -> DataFrame:
    """Orders with their day number and value."""
    value = F.col("o_totalprice").cast("decimal(12,2)").alias("value")
    return order_touches(orders, value).withColumn("day", F.unix_date("date"))


def first_orders(orders: DataFrame) -> DataFrame:
    """(o_custkey, date, channel) of each customer's first order; a hash aggregate."""
    known = order_touches(orders).where(F.col("o_custkey").isNotNull())
    return (
        known.groupBy("o_custkey")
        .agg(F.min(F.struct("date", "o_orderkey", "channel")).alias("first"))
        .select("o_custkey", "first.date", "first.channel")
    )


def cohort_orders_90d(orders: DataFrame, days: int = 90, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Cohorts of new customers by month and channel, and all orders of the channel up to ``days`` later.

    A left interval join on raw orders: a cohort without any such order stays.  Orders and
    first orders of an unlisted priority have no channel and join no cohort.
    """
    cohorts = (
        first_orders(orders)
        .where(F.col("channel").isNotNull())
        .groupBy(month_start("date").alias("cohort_month"), "channel")
        .agg(F.count(F.lit(1)).alias("new_customers"))
        .withColumn("low", F.unix_date("cohort_month"))
        .withColumn("high", F.col("low") + days)
    )
    points = _placed(orders).select("channel", "day", "value", "o_orderkey")
    found = interval_totals(
        cohorts,
        points,
        ["channel"],
        ("low", "high"),
        "day",
        days,
        [F.count("p.o_orderkey").alias("orders_90d"), F.sum("p.value").cast(VALUE).alias("revenue")],
        hot_rows,
    )
    revenue = F.coalesce("revenue", F.lit(0).cast(VALUE))
    return found.select(
        "cohort_month",
        "channel",
        "new_customers",
        "orders_90d",
        rounded(revenue, 2).alias("revenue_90d_gbp"),
        rounded_ratio(revenue, "new_customers", 2).alias("revenue_per_new_customer"),
    ).orderBy("cohort_month", "channel")


def lookback_touches(touches: DataFrame, days: int = 7, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each conversion with its customer's touches of the ``days`` before it, conversions without any too.

    Unlike a journey, the window reaches over earlier conversions.
    """
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    conversions = touches.where("is_conversion = 1").select(
        F.col("event_id").alias("conversion_id"),
        "customer_id",
        "revenue",
        (at - days * MICROS_PER_DAY).alias("low"),
        (at - 1).alias("high"),
    )
    points = touches.where("is_touch = 1").select("customer_id", "channel", "event_id", at.alias("at"))
    last = F.struct("p.at", "p.event_id")
    found = interval_totals(
        conversions,
        points,
        ["customer_id"],
        ("low", "high"),
        "at",
        days * MICROS_PER_DAY,
        [
            F.count("p.event_id").alias("touches"),
            # At most one entry per channel.
            F.array_sort(F.collect_set("p.channel")).alias("channels"),
            F.max_by("p.channel", F.when(F.col("p.event_id").isNotNull(), last)).alias("last_channel"),
            F.max("p.at").alias("last_at"),
        ],
        hot_rows,
    )
    return found.select(
        "conversion_id",
        "customer_id",
        double("revenue").alias("revenue"),
        "touches",
        F.size("channels").alias("distinct_channels"),
        F.array_join("channels", " + ").alias("channels"),
        "last_channel",
        F.floor((F.col("high") + 1 - F.col("last_at")) / F.lit(60_000_000)).alias("minutes_since_last"),
    )


def crossover_orders(orders: DataFrame, first: str = "TikTok", later: str = "Google_Search") -> DataFrame:
    """Orders through ``later`` of customers that had come through ``first`` on an earlier day, by month.

    An exact semi-join on raw orders behind a Bloom filter of the customers of ``first``;
    that side holds one row per customer, the first day.
    """
    placed = _placed(orders)
    came = (
        placed.where((F.col("channel") == first) & F.col("o_custkey").isNotNull())
        .groupBy("o_custkey")
        .agg(F.min("date").alias("first_date"))
    )
    after = placed.where((F.col("channel") == later) & F.col("o_custkey").isNotNull()).select("o_custkey", "date", "value")
    crossed = semi_join(after, came, ["o_custkey"], F.col("d.date") > F.col("b.first_date"))
    per_customer = crossed.groupBy(month_start("date").alias("month"), "o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("value").alias("value")
    )
    return (
        per_customer.groupBy("month")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("orders").alias("orders"), F.sum("value").alias("value"))
        .select("month", "customers", "orders", rounded("value", 2).alias("revenue_gbp"))
        .orderBy("month")
    )

