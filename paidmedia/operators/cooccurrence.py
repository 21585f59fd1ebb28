"""Channels active on the same days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.functions.exprs import double, month_start, paid, rounded, rounded_ratio, with_spend

PATH_SEPARATOR = " > "
EXACT_SUM = "decimal(38,2)"


def _channel_days(fact: DataFrame) -> DataFrame:
    """One row per date and channel with spend."""
    return with_spend(paid(fact)).groupBy("date", "channel").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("spend_gbp").alias("spend"),
        F.sum("revenue_gbp").alias("revenue"),
        F.sum("orders").alias("orders"),
    )


def _path(channels):
    return F.array_join(F.array_sort(channels), PATH_SEPARATOR)


def daily_active_channels(fact: DataFrame) -> DataFrame:
    """Channels with spend on each date, and the date's totals."""
    return (
        _channel_days(fact)
        .groupBy("date")
        .agg(
            _path(F.collect_list("channel")).alias("active_channel_path"),
            F.count(F.lit(1)).alias("channels_active"),
            double(F.sum("spend")).alias("total_daily_spend"),
            double(F.sum("revenue")).alias("total_daily_revenue"),
            F.sum("orders").alias("total_daily_orders"),
        )
        .orderBy("date")
    )


def monthly_channel_mix(fact: DataFrame) -> DataFrame:
    """Channels with spend in each month; days are counted after a sum per day."""
    return (
        _channel_days(fact)
        .groupBy("date")
        .agg(
            F.collect_set("channel").alias("channels"),
            F.sum("spend").alias("spend"),
            F.sum("revenue").alias("revenue"),
        )
        .groupBy(month_start().alias("month"))
        .agg(
            _path(F.array_distinct(F.flatten(F.collect_set("channels")))).alias("channel_mix"),
            F.count(F.lit(1)).alias("days_in_month"),
            rounded(F.sum("spend"), 0).alias("monthly_spend"),
            rounded(F.sum("revenue"), 0).alias("monthly_revenue"),
        )
        .orderBy("month")
    )


def channel_pairs(fact: DataFrame, min_pairs: int = 30, details: bool = False) -> DataFrame:
    """Channel pairs active on the same date, over pairs of fact rows.

    Rows are summed per date and channel first; a pair of rows then counts
    ``n_a * n_b`` times and each side's sum once per row of the other.  The join
    holds at most one row per date and pair of channels, however many rows the
    fact has per day.  ``details`` adds the number of dates.
    """
    days = _channel_days(fact)
    a, b = days.alias("a"), days.alias("b")

    def both(column: str):
        return F.sum(
            F.col(f"a.{column}").cast(EXACT_SUM) * F.col("b.n")
            + F.col(f"b.{column}").cast(EXACT_SUM) * F.col("a.n")
        )

    pairs = (
        a.join(b, (F.col("a.date") == F.col("b.date")) & (F.col("a.channel") < F.col("b.channel")))
        .groupBy(F.col("a.channel").alias("channel_a"), F.col("b.channel").alias("channel_b"))
        .agg(
            F.sum(F.col("a.n") * F.col("b.n")).alias("days_cooccurred"),
            F.count(F.lit(1)).alias("distinct_days"),
            both("spend").alias("spend"),
            both("revenue").alias("revenue"),
        )
        .filter(F.col("days_cooccurred") > min_pairs)
        .withColumn("combined_revenue", rounded("revenue", 0))
    )
    columns: list = [
        F.concat_ws(" + ", "channel_a", "channel_b").alias("channel_pair"),
        "days_cooccurred",
        rounded("spend", 0).alias("combined_spend"),
        "combined_revenue",
        rounded_ratio("revenue", "spend", 3).alias("combined_roas"),
        F.rank()
        .over(Window.orderBy(F.desc_nulls_first("combined_revenue")))
        .cast("bigint")
        .alias("revenue_rank"),
    ]
    if details:
        columns.append("distinct_days")
    return pairs.select(*columns).orderBy("revenue_rank")


def isolated_channel_days(
    fact: DataFrame, channel: str = "TikTok", without: str = "Google_Search"
) -> DataFrame:
    """Dates on which one channel had spend and another had none.

    Both sides of the anti-join come from one scan: one conditional sum per date.
    """
    own = F.col("channel") == channel
    return (
        with_spend(fact)
        .filter(F.col("channel").isin(channel, without))
        .groupBy("date")
        .agg(
            F.count(F.when(own, 1)).alias("own_rows"),
            F.count(F.when(F.col("channel") == without, 1)).alias("other_rows"),
            F.sum(F.when(own, F.col("spend_gbp"))).alias("spend"),
            F.sum(F.when(own, F.col("revenue_gbp"))).alias("revenue"),
            F.sum(F.when(own, F.col("orders"))).alias("orders"),
        )
        .filter((F.col("own_rows") > 0) & (F.col("other_rows") == 0))
        .select(
            "date",
            F.lit(channel).alias("channel"),
            double("spend").alias("spend"),
            double("revenue").alias("revenue"),
            "orders",
            rounded_ratio("revenue", "spend", 3).alias("roas"),
        )
        .orderBy("date")
    )
