"""Budget: efficiency index, recommended split, scenario projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.functions.exprs import (
    GROSS_MARGIN,
    double,
    margin,
    paid,
    percent,
    ratio,
    rounded,
    rounded_ratio,
    totals,
)
from paidmedia.sources import dimensions

ALL = "ALL"
DEFAULT_ROAS, DEFAULT_AOV, DEFAULT_NC_RATIO = 2.5, 55.0, 0.5
AMOUNT = "decimal(28,6)"


def budget_efficiency_index(fact: DataFrame, budget: float = 100000) -> DataFrame:
    """Contribution margin per unit of spend, scored 0-100, and the split it implies.

    Shares are built on the rounded score.  The windows run over channel totals.
    """
    channels = Window.partitionBy()
    rows = totals(paid(fact), "channel").select(
        "channel",
        "spend",
        rounded_ratio(margin("revenue", "spend"), "spend", 4).cast("decimal(18,4)").alias("cm"),
        rounded_ratio("revenue", "spend", 3).alias("roas"),
    )
    low, high = F.min("cm").over(channels), F.max("cm").over(channels)
    scored = rows.withColumns(
        {
            "efficiency_percentile": rounded(F.percent_rank().over(Window.orderBy("cm")), 4),
            "score": F.round(
                (ratio(F.col("cm") - low, high - low) * 100).cast("decimal(38,10)"), 1
            ).cast("decimal(10,1)"),
            "all_spend": F.sum("spend").over(channels),
        }
    )
    share = ratio("score", F.sum("score").over(channels))
    return (
        scored.withColumn("share", share)
        .select(
            "channel",
            rounded("cm", 3).alias("cm_per_gbp"),
            "roas",
            double("score").alias("efficiency_score_0_100"),
            "efficiency_percentile",
            percent("spend", "all_spend", 1).alias("current_spend_share_pct"),
            rounded(F.col("share") * 100, 1).alias("recommended_spend_share_pct"),
            rounded(F.col("share") * budget, 0).alias("recommended_gbp_of_100k"),
            rounded(F.col("share") * budget * F.col("roas"), 0).alias("projected_revenue_gbp"),
        )
        .orderBy(F.desc_nulls_first("recommended_spend_share_pct"))
    )


def spend_cube(fact: DataFrame) -> DataFrame:
    """Spend, revenue and margin over every combination of channel and campaign."""

    def label(key: str) -> Column:
        return F.when(F.grouping(key) == 1, ALL).otherwise(F.col(key))

    return (
        paid(fact)
        .cube("channel", "campaign_type")
        .agg(
            label("channel").alias("channel_label"),
            label("campaign_type").alias("campaign_label"),
            F.sum("spend_gbp").alias("spend_sum"),
            F.sum("revenue_gbp").alias("revenue_sum"),
        )
        .select(
            F.col("channel_label").alias("channel"),
            F.col("campaign_label").alias("campaign_type"),
            rounded("spend_sum", 0).alias("spend"),
            rounded("revenue_sum", 0).alias("revenue"),
            rounded_ratio(margin("revenue_sum", "spend_sum"), "spend_sum", 3).alias("cm_per_gbp"),
        )
        .orderBy(F.asc_nulls_last("channel"), F.asc_nulls_last("campaign_type"))
    )


def cm_efficiency(fact: DataFrame) -> DataFrame:
    """Margin per unit of spend and its unrounded min-max index."""
    channels = Window.partitionBy()
    rows = totals(paid(fact), "channel").select(
        "channel",
        double("spend").alias("spend"),
        double("revenue").alias("revenue"),
        double(margin("revenue", "spend")).alias("cm"),
        ratio("revenue", "spend").alias("ROAS"),
        ratio(margin("revenue", "spend"), "spend").alias("CM_per_GBP_spent"),
    )
    low, high = (f("CM_per_GBP_spent").over(channels) for f in (F.min, F.max))
    index = F.try_divide(F.col("CM_per_GBP_spent") - low, high - low) * 100
    return rows.withColumn("Budget_Eff_Index", index)


def spend_scenarios(fact: DataFrame, budget: float = dimensions.DEFAULT_BUDGET) -> DataFrame:
    """Scenarios taken from the data: each year's actual split of paid spend.

    Percentages are rounded to one digit, so a scenario need not sum to 100.
    """
    year = Window.partitionBy("year")
    return (
        totals(paid(fact), F.year("date").alias("year"), "channel")
        .withColumn("all_spend", F.sum("spend").over(year))
        .select(
            F.concat(F.lit("year_"), F.col("year").cast("string")).alias("scenario_id"),
            F.lit(float(budget)).alias("budget"),
            "channel",
            percent("spend", "all_spend", 1).alias("pct"),
        )
    )


def allocation_check(scenarios: DataFrame) -> DataFrame:
    """Whether the percentages of each scenario sum to 100."""
    total = F.sum(F.col("pct").cast("decimal(18,6)"))
    return scenarios.groupBy("scenario_id").agg(
        double(total).alias("total_pct"), (total == 100).alias("sums_to_100")
    )


def _priced(
    scenarios: DataFrame,
    roas: DataFrame,
    economics: DataFrame | None,
    weights: DataFrame | None = None,
) -> DataFrame:
    """Scenario rows with what their channel returns, costs and weighs.

    The joined tables hold one row per channel; Catalyst broadcasts them by their
    known or measured size.
    """
    spark = scenarios.sparkSession
    economics = dimensions.channel_economics(spark) if economics is None else economics
    weights = dimensions.channel_weights(spark) if weights is None else weights
    return (
        scenarios.join(roas, "channel", "left")
        .join(economics, "channel", "left")
        .join(weights, "channel", "left")
        .select(
            "scenario_id",
            "budget",
            "channel",
            "pct",
            (double("weight") * 100).alias("baseline_pct"),
            F.coalesce("avg_roas", F.lit(DEFAULT_ROAS)).alias("roas"),
            F.coalesce("aov", F.lit(DEFAULT_AOV)).alias("aov"),
            F.coalesce("nc_ratio", F.lit(DEFAULT_NC_RATIO)).alias("nc_ratio"),
        )
    )


def _outcome(pct: str) -> dict[str, Column]:
    """What a percentage of the budget buys in one channel."""
    spend = F.col("budget") * F.col(pct) / 100
    revenue = spend * F.col("roas")
    orders = ratio(revenue, "aov", 0)
    return {
        "spend": spend,
        "revenue": revenue,
        "orders": orders,
        "new_cust": orders * F.col("nc_ratio"),
        "cm": revenue * float(GROSS_MARGIN) - spend,
    }


def budget_projection(
    scenarios: DataFrame, roas: DataFrame, economics: DataFrame | None = None
) -> DataFrame:
    """Spend, revenue, orders, new customers and margin per scenario and channel."""
    return _priced(scenarios, roas, economics).select(
        "scenario_id", "channel", *[c.alias(name) for name, c in _outcome("pct").items()]
    )


def _scenario_sums(priced: DataFrame) -> DataFrame:
    chosen, baseline = _outcome("pct"), _outcome("baseline_pct")

    def total(amount: Column) -> Column:
        return F.sum(amount.cast(AMOUNT))

    margin_on_budget = double("revenue") * float(GROSS_MARGIN) - F.col("budget")
    baseline_margin = double("base_revenue") * float(GROSS_MARGIN) - F.col("budget")
    return (
        priced.groupBy("scenario_id")
        .agg(
            F.max("budget").alias("budget"),
            total(chosen["revenue"]).alias("revenue"),
            total(chosen["orders"]).alias("orders"),
            total(chosen["new_cust"]).alias("new_cust"),
            total(baseline["revenue"]).alias("base_revenue"),
        )
        .select(
            "scenario_id",
            double("revenue").alias("total_revenue"),
            double("orders").alias("total_orders"),
            ratio("budget", "new_cust", 0).alias("total_cac"),
            margin_on_budget.alias("total_cm"),
            (double("revenue") - double("base_revenue")).alias("revenue_vs_baseline"),
            (margin_on_budget - baseline_margin).alias("cm_vs_baseline"),
        )
    )


def projection_totals(
    scenarios: DataFrame, roas: DataFrame, economics: DataFrame | None = None
) -> DataFrame:
    """Scenario totals; CAC and margin are taken on the whole budget.

    Where percentages do not sum to 100, ``total_cm`` differs from the sum of margins.
    """
    return _scenario_sums(_priced(scenarios, roas, economics)).select(
        "scenario_id", "total_revenue", "total_orders", "total_cac", "total_cm"
    )


def scenario_vs_baseline(
    scenarios: DataFrame, roas: DataFrame, weights: DataFrame | None = None
) -> DataFrame:
    """Each scenario against its budget split by the channel weights, channel by channel."""
    chosen, baseline = _outcome("pct"), _outcome("baseline_pct")
    return _priced(scenarios, roas, None, weights).select(
        "scenario_id",
        "channel",
        chosen["revenue"].alias("revenue"),
        baseline["revenue"].alias("baseline_revenue"),
        (chosen["revenue"] - baseline["revenue"]).alias("revenue_delta"),
        (chosen["cm"] - baseline["cm"]).alias("cm_delta"),
    )


def scenario_totals_vs_baseline(
    scenarios: DataFrame, roas: DataFrame, weights: DataFrame | None = None
) -> DataFrame:
    """Scenario totals and how far revenue and margin lie from the split by weights."""
    return _scenario_sums(_priced(scenarios, roas, None, weights))
