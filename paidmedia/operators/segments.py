"""Channel x campaign segments: ranking, scoring and budget advice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.functions.exprs import double, paid, percent, ratio, rounded, rounded_ratio, totals

# Labels of the report.
SCALE_UP, REDUCE, MAINTAIN = "Scale Up", "Reduce or Pause", "Maintain"


def top_segments(fact: DataFrame, above: float = 1.10, below: float = 0.90) -> DataFrame:
    """Segments at or above the median ROAS of their channel.

    All windows run over segment totals: campaigns within a channel, or segments.
    """
    channel = Window.partitionBy("channel")
    best_first = F.desc_nulls_first("roas")
    segments = totals(paid(fact), "channel", "campaign_type").select(
        "channel",
        "campaign_type",
        "spend",
        "revenue",
        rounded_ratio("revenue", "spend", 3).alias("roas"),
        percent("clicks", "impressions", 3).alias("ctr_pct"),
        percent("orders", "clicks", 3).alias("cvr_pct"),
        rounded_ratio("spend", "orders", 2).alias("cpo_gbp"),
        rounded_ratio("spend", "new_customers", 2).alias("cac_gbp"),
    )
    exact = F.col("roas").cast("decimal(18,3)")
    scored = segments.withColumns(
        {
            "roas_rank_within_channel": F.rank().over(channel.orderBy(best_first)).cast("bigint"),
            "overall_roas_rank": F.rank().over(Window.orderBy(best_first)).cast("bigint"),
            "composite_efficiency_score": rounded(
                F.col("roas") * 0.5
                + F.col("cvr_pct") * 10 * 0.3
                + F.when(F.col("cac_gbp") > 0, F.lit(100.0) / F.col("cac_gbp") * 0.2).otherwise(0.0),
                2,
            ),
            "mean_roas": ratio(F.sum(exact).over(channel), F.count(exact).over(channel)),
            "median_roas": F.percentile("roas", 0.5).over(channel),
        }
    )
    return (
        scored.filter(F.col("roas") >= F.col("median_roas"))
        .select(
            "channel",
            "campaign_type",
            double("spend").alias("total_spend"),
            double("revenue").alias("total_revenue"),
            "roas",
            "ctr_pct",
            "cvr_pct",
            "cpo_gbp",
            "cac_gbp",
            "roas_rank_within_channel",
            "overall_roas_rank",
            "composite_efficiency_score",
            rounded("mean_roas", 3).alias("channel_avg_roas"),
            rounded(F.col("roas") - F.col("mean_roas"), 3).alias("roas_vs_channel_avg"),
            F.when(F.col("roas") > F.col("mean_roas") * above, SCALE_UP)
            .when(F.col("roas") < F.col("mean_roas") * below, REDUCE)
            .otherwise(MAINTAIN)
            .alias("budget_recommendation"),
        )
        .orderBy(F.desc_nulls_first("composite_efficiency_score"))
    )
