"""Creative formats: fatigue curves, rollups, ROAS matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.functions.exprs import (
    EXACT,
    double,
    mean,
    paid,
    ratio,
    rounded,
    rounded_ratio,
    totals,
    with_spend,
)
from paidmedia.functions.selection import bucketed
from paidmedia.sources import schema

# Labels of the reports.
QUARTILE_LABELS = [
    "Low Spend (Q1)",
    "Mid-Low Spend (Q2)",
    "Mid-High Spend (Q3)",
    "High Spend (Q4)",
]
ALL_CREATIVES, ALL_CHANNELS = "ALL CREATIVES", "ALL CHANNELS"


def creative_fatigue_curve(
    fact: DataFrame,
    min_rows: int = 10,
    details: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """ROAS by spend quartile of each creative.

    Rows of equal spend are ordered by the rest of the grain, which makes the
    quartiles repeatable.  ``details`` adds spend bounds, the row count and
    the conversion density, which is 1 wherever there are orders.
    """
    rows = with_spend(paid(fact)).select(
        "creative_type",
        "spend_gbp",
        "date",
        "channel",
        "campaign_type",
        "revenue_gbp",
        "orders",
        # Row ratios before the shuffle: there are more scan tasks than creatives.
        rounded_ratio("revenue_gbp", "spend_gbp", 3)
        .cast("decimal(18,3)")
        .alias("row_roas"),
        ratio("spend_gbp", "orders").cast(EXACT).alias("row_cpo"),
    )
    quartiles = bucketed(
        rows,
        len(QUARTILE_LABELS),
        ["creative_type"],
        ["spend_gbp", "date", "channel", "campaign_type"],
        "spend_quartile",
        slices,
    )
    curve = (
        quartiles.groupBy("creative_type", "spend_quartile")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("spend_gbp").alias("lowest"),
            F.max("spend_gbp").alias("highest"),
            mean("spend_gbp").alias("avg_spend"),
            mean("row_roas").alias("avg_row_roas"),
            mean("row_cpo").alias("avg_row_cpo"),
            rounded_ratio(F.sum("revenue_gbp"), F.sum("spend_gbp"), 3).alias("pooled_roas"),
            F.sum("orders").alias("orders"),
        )
        .filter(F.col("row_count") > min_rows)
    )
    label = F.get(
        F.array(*[F.lit(x) for x in QUARTILE_LABELS]), F.col("spend_quartile").cast("int") - 1
    )
    before = Window.partitionBy("creative_type").orderBy("spend_quartile")
    columns: list = [
        "creative_type",
        F.col("spend_quartile").cast("bigint").alias("spend_quartile"),
        label.alias("quartile_label"),
        rounded("avg_spend", 2).alias("avg_daily_spend"),
        rounded("avg_row_roas", 3).alias("avg_roas"),
        "pooled_roas",
        rounded("avg_row_cpo", 2).alias("avg_cpo"),
        F.lag("pooled_roas").over(before).alias("prev_quartile_roas"),
    ]
    if details:
        columns += [
            double("lowest").alias("min_spend"),
            double("highest").alias("max_spend"),
            "row_count",
            rounded_ratio("orders", "orders", 3).alias("conversion_density"),
        ]
    return curve.select(*columns).orderBy("creative_type", "spend_quartile")


def _label(key: str, everything: str) -> Column:
    """Subtotal rows by grouping(), so that a NULL key stays NULL."""
    return F.when(F.grouping(key) == 1, everything).otherwise(F.col(key))


def creative_channel_rollup(fact: DataFrame, min_spend: float = 1000) -> DataFrame:
    """Creative -> channel subtotals and the grand total."""
    return (
        with_spend(paid(fact))
        .rollup("creative_type", "channel")
        .agg(
            _label("creative_type", ALL_CREATIVES).alias("creative_label"),
            _label("channel", ALL_CHANNELS).alias("channel_label"),
            F.count(F.lit(1)).alias("rows"),
            F.sum("spend_gbp").alias("spend"),
            F.sum("revenue_gbp").alias("revenue"),
        )
        .filter(F.col("spend") > min_spend)
        .select(
            F.col("creative_label").alias("creative_type"),
            F.col("channel_label").alias("channel"),
            "rows",
            rounded("spend", 0).alias("total_spend"),
            rounded("revenue", 0).alias("total_revenue"),
            rounded_ratio("revenue", "spend", 3).alias("roas"),
        )
        .orderBy(F.asc_nulls_last("creative_type"), F.asc_nulls_last("channel"))
    )


def _cells(fact: DataFrame) -> DataFrame:
    return totals(fact, "creative_type", "channel").withColumn("ROAS", ratio("revenue", "spend"))


def _matrix(fact: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Wide form of the listed channels; it fails on any other, which the long form has.

    Naming the columns up front saves the pass that would find them.
    """
    other = F.concat(F.lit("channel not among the columns: "), F.col("channel"))
    listed = F.when(F.col("channel").isin(list(channels)), F.col("channel")).otherwise(
        F.raise_error(F.coalesce(other, F.lit("rows without a channel")))
    )
    return (
        _cells(fact)
        .withColumn("channel", listed.cast("string"))
        .groupBy("creative_type")
        .pivot("channel", list(channels))
        .agg(F.first("ROAS"))
        .orderBy("creative_type")
    )


def _long(cells: DataFrame) -> DataFrame:
    return cells.select(
        "creative_type",
        "channel",
        double("spend").alias("spend"),
        double("revenue").alias("revenue"),
        "ROAS",
    ).orderBy("creative_type", "channel")


def roas_cells(fact: DataFrame) -> DataFrame:
    """ROAS of every creative and channel present, over rows with spend."""
    return _long(_cells(with_spend(fact)))


def creative_cells(fact: DataFrame) -> DataFrame:
    """ROAS of every creative and paid channel present, with or without spend."""
    return _long(_cells(paid(fact)))


def roas_matrix(fact: DataFrame, channels: Sequence[str] = schema.PAID_CHANNELS) -> DataFrame:
    """Creative x channel ROAS over rows with spend."""
    return _matrix(with_spend(fact), channels)


def creative_matrix(fact: DataFrame, channels: Sequence[str] = schema.PAID_CHANNELS) -> DataFrame:
    """Creative x channel ROAS over paid channels, with or without spend."""
    return _matrix(paid(fact), channels)


def _best(cells: DataFrame) -> DataFrame:
    """Highest ROAS of each channel; the alphabetically first creative on a tie."""
    order = Window.partitionBy("channel").orderBy(F.desc_nulls_last("ROAS"), "creative_type")
    return (
        cells.withColumn("place", F.row_number().over(order))
        .filter((F.col("place") == 1) & F.col("ROAS").isNotNull())
        .select(
            "channel",
            "creative_type",
            F.replace("creative_type", F.lit("_"), F.lit(" ")).alias("label"),
            double("spend").alias("spend"),
            double("revenue").alias("revenue"),
            "ROAS",
        )
        .orderBy("channel")
    )


def best_creative_per_channel(fact: DataFrame) -> DataFrame:
    return _best(_cells(with_spend(fact)))


def best_creative(fact: DataFrame) -> DataFrame:
    return _best(_cells(paid(fact)))


def quarterly_creative_roas(fact: DataFrame) -> DataFrame:
    """ROAS by quarter end and creative, over rows with spend."""
    quarter_end = F.last_day(F.add_months(F.trunc("date", "quarter"), 2))
    return (
        totals(with_spend(fact), quarter_end.alias("date"), "creative_type")
        .select(
            "date",
            "creative_type",
            double("spend").alias("spend"),
            double("revenue").alias("revenue"),
            ratio("revenue", "spend").alias("ROAS"),
        )
        .orderBy("date", "creative_type")
    )


def creative_premium(fact: DataFrame, creative: str = "Video_Drop_Test") -> DataFrame:
    """Mean cell ROAS of one creative against the mean over all cells, in percent."""
    roas = F.col("ROAS").cast(EXACT)
    return (
        _cells(paid(fact))
        .agg(
            mean(F.when(F.col("creative_type") == creative, roas)).alias("creative_avg_roas"),
            mean(roas).alias("overall_avg_roas"),
        )
        .select(
            F.lit(creative).alias("creative_type"),
            "creative_avg_roas",
            "overall_avg_roas",
            ((ratio("creative_avg_roas", "overall_avg_roas") - 1) * 100).alias("premium_pct"),
        )
    )


def cumulative_spend_fatigue(fact: DataFrame) -> DataFrame:
    """Daily and running ROAS of each creative along its cumulative spend.

    Days are summed first, so the running window sees one row per creative and day.
    """
    daily = totals(with_spend(paid(fact)), "creative_type", "date")
    creative = Window.partitionBy("creative_type")
    so_far = creative.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        daily.withColumns(
            {
                "spend_so_far": F.sum("spend").over(so_far),
                "revenue_so_far": F.sum("revenue").over(so_far),
                "all_spend": F.sum("spend").over(creative),
            }
        )
        .select(
            "creative_type",
            "date",
            double("spend").alias("daily_spend"),
            rounded_ratio("revenue", "spend", 3).alias("daily_roas"),
            double("spend_so_far").alias("cumulative_spend"),
            rounded_ratio("revenue_so_far", "spend_so_far", 3).alias("cumulative_roas"),
            rounded_ratio("spend_so_far", "all_spend", 1, 100).alias("cumulative_spend_pct"),
        )
        .orderBy("creative_type", "date")
    )
