"""Revenue attribution.

Three definitions exist side by side and are never mixed:

* by journey templates: last touch, or equal split over distinct channels;
* by given weights of the total revenue;
* by given weights of each channel's own revenue.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.functions.exprs import double, paid, ratio, rounded, rounded_ratio, totals
from paidmedia.sources import dimensions, schema
from paidmedia.sources.store import materialise

# Labels of the reports.
UNDERVALUED, OVERVALUED, NEUTRAL = (
    "UNDERVALUED by Last-Click",
    "OVERVALUED by Last-Click",
    "Neutral",
)
NO_LAST_CLICK = "Last-Click = £0\n(fully undervalued)"
INFINITE = "+inf%"

SHARE = "decimal(38,15)"


def channel_revenue(
    fact: DataFrame, channels: Sequence[str] = schema.PAID_CHANNELS
) -> DataFrame:
    """Revenue of the listed channels."""
    return (
        fact.filter(F.col("channel").isin(list(channels)))
        .groupBy("channel")
        .agg(F.sum("revenue_gbp").alias("revenue"))
        .select("channel", double("revenue").alias("revenue_gbp"))
    )


def equal_split(journeys: DataFrame) -> DataFrame:
    """Each distinct channel of a path weighs 1 / number of distinct channels."""
    distinct = journeys.withColumn("touched", F.array_distinct("path"))
    return distinct.select(
        *journeys.columns,
        F.explode("touched").alias("channel"),
        (F.lit(1.0) / F.size("touched")).alias("weight"),
    )


def journey_shares(
    journeys: DataFrame, channels: Sequence[str] = schema.PAID_CHANNELS
) -> DataFrame:
    """Share of revenue credited to each channel by last touch and by equal split."""
    named = dimensions.channels(journeys.sparkSession, channels)
    last = F.element_at("path", -1) == F.col("channel")
    credit = equal_split(journeys).groupBy("channel").agg(
        F.sum(F.when(last, F.col("share")).otherwise(0).cast(SHARE)).alias("lc"),
        F.sum((double("share") / F.size(F.array_distinct("path"))).cast(SHARE)).alias("sv"),
    )
    every = Window.partitionBy()
    none = F.lit(0).cast(SHARE)
    shares = named.join(credit, "channel", "left").select(
        "channel",
        F.coalesce("lc", none).alias("lc"),
        F.coalesce("sv", none).alias("sv"),
    )
    return shares.select(
        "channel",
        ratio("lc", F.sum("lc").over(every)).alias("lastclick_share"),
        ratio("sv", F.sum("sv").over(every)).alias("shapley_share"),
    )


def journey_credits(
    fact: DataFrame,
    journeys: DataFrame | None = None,
    channels: Sequence[str] = schema.PAID_CHANNELS,
) -> DataFrame:
    """Total paid revenue shared out by the journey templates: one row per listed channel."""
    journeys = (
        dimensions.journey_templates(fact.sparkSession) if journeys is None else journeys
    )
    every = Window.partitionBy()
    revenue = (
        fact.filter(F.col("channel").isin(list(channels)))
        .groupBy("channel")
        .agg(F.sum("revenue_gbp").alias("revenue"))
    )
    with_total = journey_shares(journeys, channels).join(revenue, "channel", "left").withColumn(
        "total", double(F.coalesce(F.sum("revenue").over(every), F.lit(0).cast("decimal(28,2)")))
    )
    return with_total.select(
        "channel",
        double(F.coalesce("revenue", F.lit(0).cast("decimal(28,2)"))).alias("channel_revenue"),
        (F.col("lastclick_share") * F.col("total")).alias("lastclick_credit"),
        (F.col("shapley_share") * F.col("total")).alias("shapley_credit"),
    )


def _delta_pct(new: Column, old: Column, on_zero: Column) -> Column:
    return F.when(old > 0, F.try_divide(new - old, old) * 100).otherwise(on_zero)


def attribution_summary(fact: DataFrame, journeys: DataFrame | None = None) -> DataFrame:
    """Credits per channel and their difference; infinite without last-click credit."""
    lc, sv = F.col("lastclick_credit"), F.col("shapley_credit")
    return journey_credits(fact, journeys).select(
        "channel",
        "lastclick_credit",
        "shapley_credit",
        _delta_pct(sv, lc, F.lit(float("inf"))).alias("delta_pct"),
    )


def row_attribution(fact: DataFrame, credits: DataFrame) -> DataFrame:
    """Spread the credits over rows in proportion to their revenue.

    The credits are written before the join, so Spark knows their size and broadcasts
    them if it is small; the fact is then not shuffled.  Credits of a channel that is
    listed twice add up.  Rows of other channels get 0.
    """
    per_channel = credits.groupBy("channel").agg(
        F.max("channel_revenue").alias("channel_revenue"),
        F.sum("lastclick_credit").alias("lastclick_credit"),
        F.sum("shapley_credit").alias("shapley_credit"),
    )
    factors = materialise(
        per_channel.select(
            "channel",
            ratio("lastclick_credit", "channel_revenue").alias("_lc"),
            ratio("shapley_credit", "channel_revenue").alias("_sv"),
        ).coalesce(1),
        "credits",
    )

    def spread(factor: str) -> Column:
        return F.coalesce(double("revenue_gbp") * F.col(factor), F.lit(0.0))

    lc, sv = F.col("revenue_lastclick"), F.col("revenue_shapley")
    return (
        fact.join(factors, "channel", "left")
        .withColumns({"revenue_lastclick": spread("_lc"), "revenue_shapley": spread("_sv")})
        .withColumn("shapley_vs_lc_delta_pct", _delta_pct(sv, lc, F.lit(0.0)))
        .select(
            *fact.columns, "revenue_lastclick", "revenue_shapley", "shapley_vs_lc_delta_pct"
        )
    )


def attribution_by_weights(
    fact: DataFrame, weights: DataFrame | None = None, lc_shares: DataFrame | None = None
) -> DataFrame:
    """Fixed last-click shares of own revenue, rescaled, against weights of the total.

    Always one row per weighted channel, also for channels absent from ``fact``.
    """
    spark = fact.sparkSession
    weights = dimensions.channel_weights(spark) if weights is None else weights
    lc_shares = dimensions.lastclick_shares(spark) if lc_shares is None else lc_shares
    every = Window.partitionBy()
    revenue = totals(paid(fact), "channel").select("channel", "revenue")
    # Amounts to the penny times a share of two digits: exact in DECIMAL.
    own = F.coalesce("revenue", F.lit(0)).cast("decimal(24,2)")
    kept = F.coalesce("share", F.lit("0.5").cast("decimal(4,2)"))
    base = (
        weights.join(lc_shares, "channel", "left")
        .join(revenue, "channel", "left")
        .select("channel", "weight", own.alias("own"), (own * kept).alias("kept"))
        .withColumns(
            {"total": F.sum("own").over(every), "all_kept": F.sum("kept").over(every)}
        )
    )
    last_click = F.when(
        F.col("all_kept") > 0, ratio("kept", "all_kept") * double("total")
    ).otherwise(double("kept"))
    lc, sv = F.col("last_click_revenue"), F.col("shapley_revenue")
    return base.select(
        "channel",
        last_click.alias("last_click_revenue"),
        (double("total") * double("weight")).alias("shapley_revenue"),
    ).withColumn("delta_pct", _delta_pct(sv, lc, F.lit(float("inf"))))


def delta_display(compared: DataFrame, low: float = -200, high: float = 500) -> DataFrame:
    """Deltas clipped for a chart, their sign, and a text label."""
    delta = F.col("delta_pct")
    infinite = F.abs(delta) == float("inf")
    return compared.select(
        "channel",
        "delta_pct",
        F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), delta)).alias("delta_display"),
        (delta > 0).alias("gains_credit"),
        F.when(infinite, INFINITE)
        .otherwise(F.format_string("%+.0f%%", F.rint(F.when(~infinite, delta))))
        .alias("delta_label"),
    )


def attribution_compare(
    attributed: DataFrame, low: float = -200, high: float = 300
) -> DataFrame:
    """Attributed columns summed by channel; the delta is NULL without last-click revenue.

    Row credits are summed at eight digits after the point, so the sum does not
    depend on the order of rows.
    """
    sums = (
        attributed.filter(F.col("channel").isin(schema.PAID_CHANNELS))
        .groupBy("channel")
        .agg(
            F.sum(F.col("revenue_lastclick").cast("decimal(28,8)")).alias("lc"),
            F.sum(F.col("revenue_shapley").cast("decimal(28,8)")).alias("sv"),
        )
    )
    delta = ratio(F.col("sv") - F.col("lc"), "lc") * 100
    return sums.withColumn("delta", delta).select(
        "channel",
        rounded("lc", 4).alias("revenue_lastclick"),
        rounded("sv", 4).alias("revenue_shapley"),
        rounded("delta", 6).alias("delta_pct"),
        rounded(
            F.when(
                F.col("delta").isNotNull(),
                F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), F.col("delta"))),
            ),
            6,
        ).alias("delta_display"),
        F.when(F.col("delta").isNull(), NO_LAST_CLICK)
        .otherwise(F.format_string("%+.0f%%", F.rint(F.col("delta"))))
        .alias("delta_label"),
    )


def attribution_own_revenue(
    fact: DataFrame, weights: DataFrame | None = None, details: bool = False
) -> DataFrame:
    """Own revenue on days with spend against own revenue times a weight.

    The two sides differ in their filter, so they are two conditional sums of one
    aggregate.  A channel without a weight keeps its revenue.  ``details`` adds the
    number of days with spend; days are counted after a sum per channel and day.
    """
    weights = dimensions.channel_weights(fact.sparkSession) if weights is None else weights
    spends = F.col("spend_gbp") > 0
    daily = paid(fact).groupBy("channel", "date").agg(
        F.count(F.when(spends, 1)).alias("n"),
        F.sum(F.when(spends, F.col("spend_gbp"))).alias("spend"),
        F.sum(F.when(spends, F.col("revenue_gbp"))).alias("lc"),
        F.sum("revenue_gbp").alias("own"),
    ) if details else paid(fact).select(
        "channel",
        F.when(spends, 1).otherwise(0).alias("n"),
        F.when(spends, F.col("spend_gbp")).alias("spend"),
        F.when(spends, F.col("revenue_gbp")).alias("lc"),
        F.col("revenue_gbp").alias("own"),
    )
    sums = (
        daily.groupBy("channel")
        .agg(
            F.sum("n").alias("n"),
            F.count(F.when(F.col("n") > 0, 1)).alias("active_days"),
            F.sum("spend").alias("spend"),
            F.sum("lc").alias("lc"),
            F.sum("own").cast("decimal(28,2)").alias("own"),
        )
        .filter(F.col("n") > 0)
        .join(weights, "channel", "left")
        .withColumn(
            "sv", F.col("own") * F.coalesce("weight", F.lit(1).cast("decimal(4,3)"))
        )
        .withColumn("delta", F.col("sv") - F.col("lc"))
    )
    columns: list = [
        "channel",
        rounded("spend", 0).alias("total_spend_gbp"),
        rounded("lc", 0).alias("lc_revenue_gbp"),
        rounded("sv", 0).alias("sv_revenue_gbp"),
        rounded("delta", 0).alias("delta_gbp"),
        rounded_ratio("delta", "lc", 1, 100).alias("delta_pct"),
        rounded_ratio("lc", "spend", 3).alias("lc_roas"),
        rounded_ratio("sv", "spend", 3).alias("sv_roas"),
        F.when(F.col("delta") > 0, UNDERVALUED)
        .when(F.col("delta") < 0, OVERVALUED)
        .otherwise(NEUTRAL)
        .alias("attribution_bias"),
    ]
    if details:
        columns.append("active_days")
    return sums.select(*columns).orderBy(F.desc_nulls_first("delta_pct"))
