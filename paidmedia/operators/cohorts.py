"""Lifetime value: channel cohorts from the fact, customer cohorts from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.functions.exprs import double, month_index, month_start, paid, rounded, rounded_ratio
from paidmedia.sources import schema
from paidmedia.sources.fact import choose, order_touches


def ltv_cohort_90d(fact: DataFrame, months: int = 3) -> DataFrame:
    """Cohorts per month and channel, valued by the channel's next three months.

    Cohort and revenue come from one scan and one aggregate; the interval join
    of a cohort with the following months is a range frame over the month number.
    """
    new = F.col("new_customers") > 0
    by_month = paid(fact).groupBy(month_start().alias("cohort_month"), "channel").agg(
        F.sum(F.when(new, F.col("new_customers"))).alias("cohort_size"),
        F.sum(F.when(new, F.col("spend_gbp"))).alias("spend"),
        F.sum("revenue_gbp").alias("revenue"),
        F.sum("returning_customers").alias("returning"),
    )
    following = (
        Window.partitionBy("channel").orderBy(month_index("cohort_month")).rangeBetween(1, months)
    )
    valued = by_month.withColumns(
        {
            "revenue_90d": F.coalesce(
                F.sum("revenue").over(following), F.lit(0).cast("decimal(28,2)")
            ),
            "returning_90d": F.coalesce(F.sum("returning").over(following), F.lit(0)),
            "cac": rounded_ratio("spend", "cohort_size", 2).cast("decimal(28,2)"),
        }
    ).filter(F.col("cohort_size") > 0)
    return valued.select(
        "cohort_month",
        "channel",
        "cohort_size",
        double("cac").alias("cohort_cac"),
        rounded("revenue_90d", 2).alias("revenue_90d_gbp"),
        rounded_ratio("revenue_90d", "cohort_size", 2).alias("ltv_90d_per_customer"),
        rounded_ratio("revenue_90d", "spend", 3).alias("ltv_roas_90d"),
        "returning_90d",
        rounded_ratio("returning_90d", "cohort_size", 1, 100).alias("return_rate_90d_pct"),
        rounded_ratio("revenue_90d", F.col("cohort_size") * F.col("cac"), 2).alias("ltv_cac_ratio"),
    ).orderBy("cohort_month", "channel")


def customer_ltv_90d(orders: DataFrame, days: int = 90) -> DataFrame:
    """Real cohorts: each customer's first order, and what followed within ``days``.

    Orders are summed per customer and day before anything is ordered, so a
    customer contributes at most one row per calendar day to the window.  Orders
    without a customer belong to no cohort.
    """
    known = orders.where(F.col("o_custkey").isNotNull())
    touches = order_touches(known, F.col("o_totalprice").cast("decimal(12,2)").alias("value"))
    # A number instead of the name keeps min_by in a hash aggregate.
    number = choose(F.col("channel"), {c: i for i, c in enumerate(schema.CHANNELS, 1)})
    # get() gives NULL for the NULL number of an unlisted priority.
    name = F.get(F.array(*[F.lit(c) for c in schema.CHANNELS]), F.col("first_channel") - 1)
    daily = touches.groupBy("o_custkey", "date").agg(
        F.min_by(number, "o_orderkey").alias("channel"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("value").alias("value"),
    )
    by_date = Window.partitionBy("o_custkey").orderBy("date")
    in_window = F.datediff("date", "first_date").between(1, days)
    per_customer = (
        daily.withColumns(
            {
                "first_date": F.first("date").over(by_date),
                "first_channel": F.first("channel").over(by_date),
            }
        )
        .groupBy("o_custkey", "first_date", name.alias("channel"))
        .agg(
            F.sum(F.when(in_window, F.col("orders"))).alias("orders"),
            F.sum(F.when(in_window, F.col("value"))).alias("value"),
        )
    )
    cohorts = per_customer.groupBy(
        month_start("first_date").alias("cohort_month"), "channel"
    ).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count("orders").alias("repeat_customers"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders_90d"),
        F.coalesce(F.sum("value"), F.lit(0).cast("decimal(28,2)")).alias("revenue"),
    )
    return cohorts.select(
        "cohort_month",
        "channel",
        "customers",
        "repeat_customers",
        "orders_90d",
        rounded("revenue", 2).alias("revenue_90d_gbp"),
        rounded_ratio("revenue", "customers", 2).alias("ltv_90d_per_customer"),
        rounded_ratio("repeat_customers", "customers", 1, 100).alias("repeat_rate_90d_pct"),
    ).orderBy("cohort_month", "channel")
