"""Monthly, weekly and yearly trends.

Every window here runs over rows already summed per calendar bucket and
channel, so its partitions are bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.functions.exprs import (
    double,
    mean,
    month_index,
    month_start,
    paid,
    ratio,
    rounded,
    rounded_ratio,
    totals,
)

# Labels of the reports.
TOP_CHANNEL = "TOP CHANNEL"
CAC_SPIKE, CAC_FELL, CAC_NORMAL = "ALERT: CAC spike >20%", "POSITIVE: CAC fell >15%", "Normal"
BASELINE_YEAR, IMPROVING, DECLINING, STABLE = (
    "Baseline Year",
    "Improving (+)",
    "Declining (-)",
    "Stable",
)


def _money(c: str | Column, digits: int) -> Column:
    """A rounded amount that further arithmetic starts from, kept as DECIMAL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(38,10)"), digits).cast("decimal(28,3)")


def _change(now: str, before: str) -> Column:
    return ratio(F.col(now) - F.col(before), before)


def _ranked_months(fact: DataFrame) -> DataFrame:
    by_month = Window.partitionBy("month_start").orderBy(F.desc_nulls_first("new_customers"))
    return totals(
        paid(fact), month_start().alias("month_start"), "channel"
    ).withColumn("rank_in_month", F.rank().over(by_month).cast("bigint"))


def top_channels_monthly(fact: DataFrame, top: int = 3) -> DataFrame:
    """Channels ranked by new customers within each month; ties share a rank."""
    return (
        _ranked_months(fact)
        .filter(F.col("rank_in_month") <= top)
        .select(
            "month_start",
            "channel",
            F.col("new_customers").alias("total_new_customers"),
            double("spend").alias("total_spend"),
            rounded_ratio("spend", "new_customers", 2).alias("cac_gbp"),
            "rank_in_month",
            F.when(F.col("rank_in_month") == 1, TOP_CHANNEL).otherwise("").alias("top_channel_flag"),
        )
        .orderBy("month_start", "rank_in_month")
    )


def channel_rank_counts(fact: DataFrame) -> DataFrame:
    """How many months each channel spent at ranks 1, 2 and 3."""
    counts = [
        F.count_if(F.col("rank_in_month") == k).alias(f"months_at_rank_{k}") for k in (1, 2, 3)
    ]
    return (
        _ranked_months(fact)
        .groupBy("channel")
        .agg(*counts, rounded(mean("new_customers"), 0).alias("avg_monthly_new_customers"))
        .orderBy(F.desc("months_at_rank_1"))
    )


def rank1_streaks(fact: DataFrame, min_months: int = 3) -> DataFrame:
    """Runs of consecutive calendar months in which a channel was ranked first."""
    first = _ranked_months(fact).filter(F.col("rank_in_month") == 1)
    number = F.row_number().over(Window.partitionBy("channel").orderBy("month_start"))
    return (
        first.withColumn("island", month_index("month_start") - number)
        .groupBy("channel", "island")
        .agg(
            F.min("month_start").alias("streak_start"),
            F.max("month_start").alias("streak_end"),
            F.count(F.lit(1)).alias("months"),
        )
        .filter(F.col("months") >= min_months)
        .drop("island")
        .orderBy("streak_start", "channel")
    )


def _monthly_cac(fact: DataFrame) -> DataFrame:
    """Rows without a new customer do not count, nor does their spend."""
    months = totals(
        paid(fact).filter(F.col("new_customers") > 0),
        month_start().alias("month_start"),
        "channel",
    )
    return months.withColumn("cac", _money(rounded_ratio("spend", "new_customers", 2), 2))


def cac_monthly_trend(
    fact: DataFrame, spike: float = 0.20, fall: float = -0.15, details: bool = False
) -> DataFrame:
    """CAC by month against the channel's previous month that has rows.

    ``details`` adds the new customers of that previous month.
    """
    over = Window.partitionBy("channel").orderBy("month_start")
    change = _change("cac", "prev")
    columns: list = [
        "month_start",
        "channel",
        double("spend").alias("monthly_spend"),
        F.col("new_customers").alias("monthly_new_customers"),
        double("cac").alias("cac_gbp"),
        double("prev").alias("prev_month_cac"),
        rounded_ratio(F.col("cac") - F.col("prev"), "prev", 1, 100).alias("cac_mom_change_pct"),
        F.when(rounded(change, 10) > spike, CAC_SPIKE)
        .when(rounded(change, 10) < fall, CAC_FELL)
        .otherwise(CAC_NORMAL)
        .alias("cac_flag"),
    ]
    if details:
        columns.append(F.col("prev_new").alias("prev_month_new_customers"))
    return (
        _monthly_cac(fact)
        .withColumns(
            {"prev": F.lag("cac").over(over), "prev_new": F.lag("new_customers").over(over)}
        )
        .select(*columns)
        .orderBy("channel", "month_start")
    )


def cac_rolling_3m(fact: DataFrame, months: int = 3) -> DataFrame:
    frame = Window.partitionBy("channel").orderBy("month_start").rowsBetween(1 - months, 0)
    return (
        _monthly_cac(fact)
        .select(
            "month_start",
            "channel",
            double("cac").alias("cac_gbp"),
            rounded_ratio(F.sum("cac").over(frame), F.count("cac").over(frame), 2).alias(
                "rolling_3m_avg_cac"
            ),
        )
        .orderBy("channel", "month_start")
    )


def roas_yoy(fact: DataFrame, band: float = 5.0) -> DataFrame:
    """Yearly ROAS, CAC and spend against the channel's previous year."""
    over = Window.partitionBy("channel").orderBy("year")
    in_year = Window.partitionBy("year").orderBy(F.desc_nulls_first("roas"))
    years = totals(paid(fact), F.year("date").alias("year"), "channel").withColumns(
        {
            "roas": _money(rounded_ratio("revenue", "spend", 3), 3),
            "cac": _money(rounded_ratio("spend", "new_customers", 2), 2),
        }
    )
    compared = years.withColumns(
        {
            "prev_roas": F.lag("roas").over(over),
            "prev_cac": F.lag("cac").over(over),
            "prev_spend": F.lag("spend").over(over),
            "roas_rank_in_year": F.dense_rank().over(in_year).cast("bigint"),
        }
    ).withColumn("roas_yoy_change_pct", rounded_ratio(F.col("roas") - F.col("prev_roas"), "prev_roas", 1, 100))
    change = F.col("roas_yoy_change_pct")
    return compared.select(
        "year",
        "channel",
        rounded(F.col("spend") / 1000, 1).alias("annual_spend_k"),
        rounded(F.col("revenue") / 1000, 1).alias("annual_revenue_k"),
        double("roas").alias("annual_roas"),
        double("prev_roas").alias("prev_year_roas"),
        "roas_yoy_change_pct",
        rounded_ratio(F.col("cac") - F.col("prev_cac"), "prev_cac", 1, 100).alias("cac_yoy_change_pct"),
        rounded_ratio(F.col("spend") - F.col("prev_spend"), "prev_spend", 1, 100).alias("spend_yoy_growth_pct"),
        "roas_rank_in_year",
        F.when(change.isNull(), BASELINE_YEAR)
        .when(change > band, IMPROVING)
        .when(change < -band, DECLINING)
        .otherwise(STABLE)
        .alias("roas_trend"),
    ).orderBy("channel", "year")


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """Revenue by month end and channel."""
    return (
        fact.groupBy(F.last_day("date").alias("date"), "channel")
        .agg(F.sum("revenue_gbp").alias("revenue"))
        .select(
            "date",
            "channel",
            double("revenue").alias("revenue_gbp"),
            F.date_format("date", "yyyy-MM").alias("month"),
        )
        .orderBy("date", "channel")
    )


def monthly_roas(fact: DataFrame) -> DataFrame:
    return totals(
        paid(fact), F.year("date").alias("year"), F.month("date").alias("month"), "channel"
    ).select(
        "year",
        "month",
        "channel",
        double("spend").alias("spend"),
        double("revenue").alias("revenue"),
        F.make_date("year", "month", F.lit(1)).alias("period"),
        ratio("revenue", "spend").alias("ROAS"),
    )


def roas_extremes(fact: DataFrame) -> DataFrame:
    """Lowest, highest, first and last monthly ROAS of each paid channel."""
    return (
        monthly_roas(fact)
        .groupBy("channel")
        .agg(
            F.min("ROAS").alias("min_roas"),
            F.max("ROAS").alias("max_roas"),
            F.min("period").alias("first_period"),
            F.min_by("ROAS", "period").alias("first_roas"),
            F.max("period").alias("last_period"),
            F.max_by("ROAS", "period").alias("last_roas"),
        )
        .orderBy("channel")
    )


def _weeks(fact: DataFrame) -> DataFrame:
    """Calendar year with ISO week: the last days of a year may be in its week 1."""
    return totals(fact, F.year("date").alias("year"), F.weekofyear("date").alias("week_number"))


def weekly_revenue(fact: DataFrame) -> DataFrame:
    label = F.concat(
        F.col("year").cast("string"),
        F.lit("-W"),
        F.lpad(F.col("week_number").cast("string"), 2, "0"),
    )
    return (
        _weeks(fact)
        .select(
            "year",
            "week_number",
            double("revenue").alias("revenue"),
            double("spend").alias("spend"),
            label.alias("week_label"),
        )
        .orderBy("year", "week_number")
    )


def seasonal_lift(
    fact: DataFrame,
    launch: tuple[int, int] = (36, 39),
    peak: tuple[int, int] = (48, 52),
    season: tuple[int, int] = (36, 52),
) -> DataFrame:
    """Mean weekly revenue of the launch and peak weeks against the rest of the year."""
    week = F.col("week_number")

    def weekly(cond: Column) -> Column:
        return mean(F.when(cond, F.col("revenue")))

    return (
        _weeks(fact)
        .agg(
            weekly(~week.between(*season)).alias("baseline_weekly_revenue"),
            weekly(week.between(*launch)).alias("launch_weekly_revenue"),
            weekly(week.between(*peak)).alias("peak_weekly_revenue"),
            F.count_if(week.between(*launch)).alias("launch_weeks"),
            F.count_if(week.between(*peak)).alias("peak_weeks"),
        )
        .withColumn(
            "peak_lift_pct",
            (ratio("peak_weekly_revenue", "baseline_weekly_revenue") - 1) * 100,
        )
    )
