"""Channel and campaign efficiency: spend, revenue, ratios, funnels, KPI cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.functions.exprs import (
    EXACT,
    double,
    mean,
    paid,
    percent,
    ratio,
    rounded,
    rounded_even,
    rounded_ratio,
    totals,
    with_spend,
)

# Labels of the reports.
HIGH_LOYALTY, MID_LOYALTY, LOW_LOYALTY = "High Loyalty", "Mid Loyalty", "Low Loyalty"
WEAK_CREATIVE = "Creative/Targeting weak — fix impression->click"
WEAK_LANDING = "Landing page/product weak — fix click->order"
HEALTHY = "Funnel healthy"


def channel_performance(fact: DataFrame) -> DataFrame:
    """Paid channels over the whole period, best pooled ROAS first."""
    sums = paid(fact).groupBy("channel").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("spend_gbp").alias("spend"),
        F.sum("revenue_gbp").alias("revenue"),
        F.sum("orders").alias("total_orders"),
        F.sum("new_customers").alias("total_new_customers"),
        mean("avg_order_value_gbp").alias("aov"),
    )
    return sums.select(
        "channel",
        "total_rows",
        "total_impressions",
        "total_clicks",
        percent("total_clicks", "total_impressions", 3).alias("blended_ctr_pct"),
        rounded("spend", 2).alias("total_spend_gbp"),
        rounded("revenue", 2).alias("total_revenue_gbp"),
        rounded_ratio("revenue", "spend", 3).alias("blended_roas"),
        "total_orders",
        rounded_ratio("spend", "total_orders", 2).alias("blended_cpo_gbp"),
        "total_new_customers",
        rounded_ratio("spend", "total_new_customers", 2).alias("blended_cac_gbp"),
        rounded("aov", 2).alias("avg_aov_gbp"),
    ).orderBy(F.desc_nulls_first("blended_roas"))


def channel_share(fact: DataFrame) -> DataFrame:
    """Share of each paid channel in spend and revenue.

    The window runs over channel totals: one row per channel, whatever the fact holds.
    """
    everything = Window.partitionBy()
    return (
        totals(paid(fact), "channel")
        .withColumns(
            {
                "all_spend": F.sum("spend").over(everything),
                "all_revenue": F.sum("revenue").over(everything),
            }
        )
        .select(
            "channel",
            rounded("spend", 0).alias("spend_gbp"),
            rounded("revenue", 0).alias("revenue_gbp"),
            rounded_ratio("revenue", "spend", 2).alias("roas"),
            percent("spend", "all_spend", 1).alias("spend_share_pct"),
            percent("revenue", "all_revenue", 1).alias("revenue_share_pct"),
        )
        .orderBy(F.desc_nulls_first("roas"))
    )


def repeat_rate_by_channel(
    fact: DataFrame, min_new: int = 100, high: float = 0.45, mid: float = 0.30
) -> DataFrame:
    """Loyalty of the customers each channel (also the unpaid one) brings."""
    rate = ratio("returning_customers", "customers")
    return (
        totals(fact, "channel")
        .filter(F.col("new_customers") > min_new)
        .withColumn("customers", F.col("new_customers") + F.col("returning_customers"))
        .select(
            "channel",
            F.col("new_customers").alias("total_new_customers"),
            F.col("returning_customers").alias("total_returning_customers"),
            F.col("customers").alias("total_customers"),
            percent("returning_customers", "customers", 2).alias("repeat_rate_pct"),
            rounded("spend", 0).alias("total_spend_gbp"),
            rounded_ratio("spend", "new_customers", 2).alias("cac_gbp"),
            rounded_ratio("revenue", "spend", 3).alias("roas"),
            F.when(rate >= high, HIGH_LOYALTY)
            .when(rate >= mid, MID_LOYALTY)
            .otherwise(LOW_LOYALTY)
            .alias("loyalty_tier"),
        )
        .orderBy(F.desc_nulls_first("repeat_rate_pct"))
    )


def repeat_rate_by_campaign(fact: DataFrame, min_orders: int = 50) -> DataFrame:
    return (
        totals(paid(fact), "channel", "campaign_type")
        .filter(F.col("orders") > min_orders)
        .select(
            "channel",
            "campaign_type",
            "new_customers",
            "returning_customers",
            percent(
                "returning_customers", F.col("new_customers") + F.col("returning_customers"), 1
            ).alias("repeat_rate_pct"),
            rounded_ratio("revenue", "spend", 2).alias("roas"),
        )
        .orderBy("channel", F.desc_nulls_first("repeat_rate_pct"))
    )


def funnel_by_channel(fact: DataFrame, weak: float = 0.01, details: bool = False) -> DataFrame:
    """Impression -> click -> order losses and the weaker stage.

    ``details`` adds the share of orders that come from new customers.
    """
    lost_click = F.col("impressions") - F.col("clicks")
    lost_order = F.col("clicks") - F.col("orders")
    columns: list = [
        "channel",
        F.col("impressions").alias("total_impressions"),
        F.col("clicks").alias("total_clicks"),
        F.col("orders").alias("total_orders"),
        percent("clicks", "impressions", 3).alias("ctr_pct"),
        percent("orders", "clicks", 3).alias("cvr_pct"),
        percent("orders", "impressions", 5).alias("end_to_end_cvr_pct"),
        lost_click.alias("dropped_at_click"),
        lost_order.alias("dropped_at_order"),
        percent(lost_click, "impressions", 1).alias("pct_lost_at_click_stage"),
        percent(lost_order, "impressions", 1).alias("pct_lost_at_order_stage"),
        F.when(ratio("clicks", "impressions") < weak, WEAK_CREATIVE)
        .when(ratio("orders", "clicks") < weak, WEAK_LANDING)
        .otherwise(HEALTHY)
        .alias("bottleneck_diagnosis"),
    ]
    if details:
        columns.append(percent("new_customers", "orders", 1).alias("order_to_new_customer_pct"))
    return (
        totals(paid(fact), "channel")
        .select(*columns)
        .orderBy(F.desc_nulls_first("end_to_end_cvr_pct"))
    )


def funnel_by_campaign(fact: DataFrame) -> DataFrame:
    return (
        totals(paid(fact), "channel", "campaign_type")
        .select(
            "channel",
            "campaign_type",
            "impressions",
            "clicks",
            "orders",
            percent("clicks", "impressions", 3).alias("ctr_pct"),
            percent("orders", "clicks", 3).alias("cvr_pct"),
            rounded_ratio("revenue", "spend", 2).alias("roas"),
        )
        .orderBy("channel", F.desc_nulls_first("cvr_pct"))
    )


def funnel_long(fact: DataFrame) -> DataFrame:
    """One row per channel and funnel stage, with the step to the next stage."""
    stages = ["impressions", "clicks", "orders", "new_customers"]
    listed = ", ".join(f"{i}, '{s}', {s}" for i, s in enumerate(stages, 1))
    long = totals(paid(fact), "channel").selectExpr(
        "channel", f"stack({len(stages)}, {listed}) AS (stage_no, stage, volume)"
    )
    following = F.lead("volume").over(Window.partitionBy("channel").orderBy("stage_no"))
    return (
        long.withColumn("next_volume", following)
        .select(
            "channel",
            "stage_no",
            "stage",
            "volume",
            "next_volume",
            percent("next_volume", "volume", 3).alias("next_stage_pct"),
            (F.col("volume") - F.col("next_volume")).alias("dropped"),
        )
        .orderBy("channel", "stage_no")
    )


def compute_kpis(fact: DataFrame) -> DataFrame:
    """One row of headline figures over all channels; zeros on empty input."""
    sums = fact.agg(
        F.coalesce(F.sum("revenue_gbp"), F.lit(0).cast("decimal(28,2)")).alias("revenue"),
        F.coalesce(F.sum("spend_gbp"), F.lit(0).cast("decimal(28,2)")).alias("spend"),
        F.coalesce(F.sum("new_customers"), F.lit(0)).alias("new_customers"),
        F.coalesce(F.sum("returning_customers"), F.lit(0)).alias("returning_customers"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
    ).withColumn("customers", F.col("new_customers") + F.col("returning_customers"))
    return sums.select(
        double("revenue").alias("total_revenue"),
        ratio("revenue", "spend", 0).alias("blended_roas"),
        ratio("spend", "new_customers", 0).alias("avg_cac"),
        (ratio("returning_customers", "customers", 0) * 100).alias("repeat_rate"),
        double("spend").alias("total_spend"),
        "total_orders",
    )


def roas_by_channel(fact: DataFrame, target: float = 3.0) -> DataFrame:
    """Pooled ROAS of rows with spend, against a target line."""
    return (
        totals(with_spend(fact), "channel")
        .select(
            "channel",
            double("spend").alias("spend"),
            double("revenue").alias("revenue"),
            ratio("revenue", "spend").alias("ROAS"),
            F.lit(target).alias("target_roas"),
        )
        .orderBy(F.desc_nulls_last("ROAS"))
    )


def spend_revenue_orders(fact: DataFrame, scale: float = 1.2) -> DataFrame:
    """Totals by channel with a bubble size that grows with the root of orders."""
    return totals(fact, "channel").select(
        "channel",
        double("spend").alias("spend"),
        double("revenue").alias("revenue"),
        "orders",
        (F.sqrt(double("orders")) * F.lit(scale)).alias("bubble_size"),
    )


def avg_roas(fact: DataFrame) -> DataFrame:
    """Pooled revenue per unit of spend of each paid channel."""
    return totals(with_spend(paid(fact)), "channel").select(
        "channel", ratio("revenue", "spend").alias("avg_roas")
    )


def channel_totals(fact: DataFrame) -> DataFrame:
    return (
        totals(fact, "channel")
        .select(
            "channel",
            double("spend").alias("spend_gbp"),
            double("revenue").alias("revenue_gbp"),
        )
        .orderBy(F.desc_nulls_last("spend_gbp"))
    )


def channel_quality(fact: DataFrame) -> DataFrame:
    """Pooled CAC, repeat rate and ROAS of paid channels."""
    customers = F.col("new_customers") + F.col("returning_customers")
    return totals(paid(fact), "channel").select(
        "channel",
        double("spend").alias("total_spend"),
        F.col("new_customers").alias("total_new"),
        F.col("returning_customers").alias("total_ret"),
        double("revenue").alias("total_revenue"),
        ratio("spend", "new_customers").alias("CAC"),
        ratio("returning_customers", customers).alias("Repeat_Rate"),
        ratio("revenue", "spend").alias("ROAS"),
    )


def row_roas() -> Column:
    return ratio("revenue_gbp", "spend_gbp", 0).cast(EXACT)


def row_cac() -> Column:
    return ratio("spend_gbp", "new_customers", 0).cast(EXACT)


def row_repeat_rate() -> Column:
    customers = F.col("new_customers") + F.col("returning_customers")
    return ratio("returning_customers", customers, 0).cast(EXACT)


def summary_report(fact: DataFrame) -> DataFrame:
    """Downloadable summary of rows with spend: totals and means of row ratios."""
    sums = with_spend(fact).groupBy("channel").agg(
        F.sum("spend_gbp").alias("spend"),
        F.sum("revenue_gbp").alias("revenue"),
        F.sum("orders").alias("Total_Orders"),
        F.sum("new_customers").alias("Total_New_Customers"),
        mean(row_roas()).alias("roas"),
        mean(row_cac()).alias("cac"),
        mean(row_repeat_rate()).alias("repeat_rate"),
    )
    return sums.select(
        "channel",
        rounded_even("spend", 2).alias("Total_Spend_GBP"),
        rounded_even("revenue", 2).alias("Total_Revenue_GBP"),
        "Total_Orders",
        "Total_New_Customers",
        rounded_even("roas", 2).alias("Avg_ROAS"),
        rounded_even("cac", 2).alias("Avg_CAC"),
        rounded_even("repeat_rate", 2).alias("Avg_Repeat_Rate"),
    ).orderBy("channel")


def final_summary(fact: DataFrame) -> DataFrame:
    """Printable summary of paid channels; money and rates become text."""
    sums = paid(fact).groupBy("channel").agg(
        F.sum("spend_gbp").alias("spend"),
        F.sum("revenue_gbp").alias("revenue"),
        mean(row_roas()).alias("roas"),
        mean(row_cac()).alias("cac"),
        mean(row_repeat_rate()).alias("repeat_rate"),
        F.sum("orders").alias("Total_Orders"),
    )

    def money(c: str, digits: int) -> Column:
        whole = F.bround(F.col(c).cast("decimal(38,10)"), 2)
        return F.concat(F.lit("£"), F.format_number(F.bround(whole, digits), digits))

    # '£{:.2f}' has no thousands separator, '£{:,.0f}' has one.
    cac = F.bround(F.col("cac").cast("decimal(38,10)"), 2).cast("decimal(18,2)").cast("string")
    rate = F.bround(F.col("repeat_rate").cast("decimal(38,10)"), 2) * 100
    return sums.select(
        "channel",
        money("spend", 0).alias("Total_Spend_GBP"),
        money("revenue", 0).alias("Total_Revenue_GBP"),
        rounded_even("roas", 2).alias("Blended_ROAS"),
        F.concat(F.lit("£"), cac).alias("Avg_CAC_GBP"),
        F.concat(rate.cast("decimal(18,1)").cast("string"), F.lit("%")).alias("Avg_Repeat_Rate"),
        "Total_Orders",
    ).orderBy("channel")
