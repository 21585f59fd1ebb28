"""Every query by name: ``(spark, folder) -> DataFrame`` over the raw tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paidmedia.operators import (
    attribution,
    budget,
    coalitions,
    cohorts,
    cooccurrence,
    creative,
    enrich,
    journeys,
    performance,
    profile,
    reach,
    segments,
    trends,
    windows,
)
from paidmedia.sources import dimensions, files, increment, layout, schema
from paidmedia.sources.fact import fact_table, raw
from paidmedia.sources.store import derived, new_path
from paidmedia.sources.touchpoints import numbered_touchpoints, touchpoints

Query = Callable[[SparkSession, str], DataFrame]

# Choices of the registered filter query: a date range and some of each domain.
FILTER = {
    "start_date": "1996-01-01",
    "end_date": "1999-12-31",
    "channels": ["Meta", "TikTok", "Google_Search"],
    "campaign_types": ["Prospecting", "Retargeting"],
    "creative_types": schema.CREATIVE_TYPES,
}


def on_fact(operator: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, folder: operator(fact_table(spark, folder), **options)


def numbered_table(spark: SparkSession, folder: str) -> DataFrame:
    """Numbered touchpoints of a folder's event log, built once per application."""
    return derived(
        spark,
        f"numbered:{folder}",
        [f"{folder}/events.parquet"],
        lambda: numbered_touchpoints(touchpoints(raw(spark, folder, "events"))),
    )


def journey_table(spark: SparkSession, folder: str) -> DataFrame:
    """Journeys of a folder's event log, built once per application."""
    return derived(
        spark,
        f"journeys:{folder}",
        [f"{folder}/events.parquet"],
        lambda: journeys.build_journeys(numbered_table(spark, folder)),
    )


def on_journeys(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(journey_table(spark, folder))


def _journey_touches(spark: SparkSession, folder: str) -> DataFrame:
    return journeys.journey_touches(numbered_table(spark, folder), journey_table(spark, folder))


def on_paths(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(
        journey_table(spark, folder), _journey_touches(spark, folder)
    )


def _customer_ltv(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.customer_ltv_90d(raw(spark, folder, "orders"))


def on_orders(operator: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, folder: operator(raw(spark, folder, "orders"), **options)


def _lookback(spark: SparkSession, folder: str) -> DataFrame:
    return windows.lookback_touches(touchpoints(raw(spark, folder, "events")))


def _path_trie(spark: SparkSession, folder: str) -> DataFrame:
    return journeys.path_trie(journeys.journey_prefixes(numbered_table(spark, folder)))


def on_worth(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """The worth of every coalition, built once per application: a row per set of channels."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        worth = derived(
            spark,
            f"worth:{folder}",
            [f"{folder}/events.parquet"],
            lambda: coalitions.conversion_worth(numbered_table(spark, folder)),
        )
        return operator(worth)

    return query


def _filtered(spark: SparkSession, folder: str) -> DataFrame:
    return files.apply_filters(fact_table(spark, folder), **FILTER)


def _fact_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "fact-csv")
    files.write_csv(fact_table(spark, folder), path)
    return files.load_csv(spark, path)


def _fact_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The fact kept up to date while a tenth of the orders, and a third of the lines, come late."""
    inputs, kept = new_path(spark, "arriving"), new_path(spark, "kept-fact")
    orders, lines = raw(spark, folder, "orders"), raw(spark, folder, "lineitem")
    late_order = F.pmod(F.xxhash64("o_orderkey"), F.lit(10)) == 0
    late_line = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
    raw(spark, folder, "part").write.parquet(f"{inputs}/part.parquet")
    for late in (False, True):
        orders.where(late_order == late).write.mode("append").parquet(f"{inputs}/orders.parquet")
        lines.where(late_line == late).write.mode("append").parquet(f"{inputs}/lineitem.parquet")
        increment.update_fact(spark, inputs, kept)
    return increment.kept_fact(spark, kept)


def _fact_by_z(spark: SparkSession, folder: str) -> DataFrame:
    """One channel's rows of the fact in Z-order."""
    table = derived(
        spark,
        f"z-ordered:{folder}",
        [f"{folder}/{t}.parquet" for t in ("orders", "lineitem", "part")],
        lambda: layout.z_ordered(fact_table(spark, folder)),
    )
    return table.where(F.col("channel") == "TikTok")


def _damaged_csv(spark: SparkSession, folder: str) -> files.CheckedCsv:
    """The fact as lines of a CSV, some of which have a bad value or a field too many."""
    path = new_path(spark, "damaged-csv")
    text = {c: F.col(c).cast("string") for c in schema.FACT.fieldNames()}
    text["spend_gbp"] = F.when(F.col("clicks") % 10 == 0, "n/a").otherwise(text["spend_gbp"])
    text["date"] = F.when(F.col("clicks") % 15 == 0, F.concat("date", F.lit(" noon?"))).otherwise(text["date"])
    text["campaign_type"] = F.when(
        F.col("clicks") % 7 == 0, F.concat("campaign_type", F.lit(",x"))
    ).otherwise(F.col("campaign_type"))
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in text.values()])
    # Whole lines under the whole header, so that nothing is quoted.
    lines = fact_table(spark, folder).select(line.alias(",".join(text)))
    lines.write.option("header", True).option("sep", "\x01").csv(path)
    return files.load_csv_checked(spark, path)


def _enriched_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "enriched-csv")
    files.write_csv(enrich.enrich(fact_table(spark, folder)), path)
    return files.load_csv(spark, path, schema.ENRICHED)


def _enriched_parquet(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "enriched")
    files.write_enriched(enrich.enrich(fact_table(spark, folder)), path)
    return files.load_enriched(spark, path)


def _row_attribution(spark: SparkSession, folder: str) -> DataFrame:
    fact = fact_table(spark, folder)
    return attribution.row_attribution(fact, attribution.journey_credits(fact)).select(
        *schema.GRAIN,
        "revenue_gbp",
        "revenue_lastclick",
        "revenue_shapley",
        "shapley_vs_lc_delta_pct",
    )


def _attribution_compare(spark: SparkSession, folder: str) -> DataFrame:
    fact = fact_table(spark, folder)
    credits = attribution.journey_credits(fact)
    return attribution.attribution_compare(attribution.row_attribution(fact, credits))


def _delta_display(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.delta_display(attribution.attribution_by_weights(fact_table(spark, folder)))


def _describe(spark: SparkSession, folder: str) -> DataFrame:
    return profile.describe_metrics(enrich.add_row_metrics(fact_table(spark, folder)))


def _scenarios(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """The default split and each year's actual split."""
    return dimensions.scenarios(spark).unionByName(budget.spend_scenarios(fact))


def on_scenarios(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        fact = fact_table(spark, folder)
        return operator(_scenarios(spark, fact), performance.avg_roas(fact))

    return query


def queries() -> dict[str, Query]:
    return {
        # Channel efficiency
        "channel_performance": on_fact(performance.channel_performance),
        "channel_share": on_fact(performance.channel_share),
        "repeat_rate_by_channel": on_fact(performance.repeat_rate_by_channel),
        "repeat_rate_by_campaign": on_fact(performance.repeat_rate_by_campaign),
        "funnel_by_channel": on_fact(performance.funnel_by_channel),
        "funnel_by_channel_detailed": on_fact(performance.funnel_by_channel, details=True),
        "funnel_by_campaign": on_fact(performance.funnel_by_campaign),
        "funnel_long": on_fact(performance.funnel_long),
        "compute_kpis": on_fact(performance.compute_kpis),
        "roas_by_channel": on_fact(performance.roas_by_channel),
        "spend_revenue_orders": on_fact(performance.spend_revenue_orders),
        "avg_roas": on_fact(performance.avg_roas),
        "channel_totals": on_fact(performance.channel_totals),
        "channel_quality": on_fact(performance.channel_quality),
        "summary_report": on_fact(performance.summary_report),
        "final_summary": on_fact(performance.final_summary),
        # Trends
        "top_channels_monthly": on_fact(trends.top_channels_monthly),
        "channel_rank_counts": on_fact(trends.channel_rank_counts),
        "rank1_streaks": on_fact(trends.rank1_streaks),
        "cac_monthly_trend": on_fact(trends.cac_monthly_trend),
        "cac_monthly_trend_detailed": on_fact(trends.cac_monthly_trend, details=True),
        "cac_rolling_3m": on_fact(trends.cac_rolling_3m),
        "roas_yoy": on_fact(trends.roas_yoy),
        "monthly_revenue": on_fact(trends.monthly_revenue),
        "monthly_roas": on_fact(trends.monthly_roas),
        "roas_extremes": on_fact(trends.roas_extremes),
        "weekly_revenue": on_fact(trends.weekly_revenue),
        "seasonal_lift": on_fact(trends.seasonal_lift),
        # Cohorts
        "ltv_cohort_90d": on_fact(cohorts.ltv_cohort_90d),
        "customer_ltv_90d": _customer_ltv,
        "cohort_orders_90d": on_orders(windows.cohort_orders_90d),
        "crossover_orders": on_orders(windows.crossover_orders),
        "reach_by_level": on_orders(reach.reach_by_level),
        # Creatives
        "creative_fatigue_curve": on_fact(creative.creative_fatigue_curve),
        "creative_fatigue_curve_detailed": on_fact(creative.creative_fatigue_curve, details=True),
        "creative_channel_rollup": on_fact(creative.creative_channel_rollup),
        "roas_matrix": on_fact(creative.roas_matrix),
        "creative_matrix": on_fact(creative.creative_matrix),
        "roas_cells": on_fact(creative.roas_cells),
        "creative_cells": on_fact(creative.creative_cells),
        "best_creative_per_channel": on_fact(creative.best_creative_per_channel),
        "best_creative": on_fact(creative.best_creative),
        "quarterly_creative_roas": on_fact(creative.quarterly_creative_roas),
        "creative_premium": on_fact(creative.creative_premium),
        "cumulative_spend_fatigue": on_fact(creative.cumulative_spend_fatigue),
        # Segments and budget
        "top_segments": on_fact(segments.top_segments),
        "budget_efficiency_index": on_fact(budget.budget_efficiency_index),
        "spend_cube": on_fact(budget.spend_cube),
        "cm_efficiency": on_fact(budget.cm_efficiency),
        "spend_scenarios": on_fact(budget.spend_scenarios),
        "allocation_check": on_scenarios(lambda s, roas: budget.allocation_check(s)),
        "budget_projection": on_scenarios(budget.budget_projection),
        "projection_totals": on_scenarios(budget.projection_totals),
        "scenario_vs_baseline": on_scenarios(budget.scenario_vs_baseline),
        "scenario_totals_vs_baseline": on_scenarios(budget.scenario_totals_vs_baseline),
        # Attribution
        "channel_revenue": on_fact(attribution.channel_revenue),
        "journey_attribution": on_fact(attribution.journey_credits),
        "attribution_summary": on_fact(attribution.attribution_summary),
        "row_attribution": _row_attribution,
        "attribution_by_weights": on_fact(attribution.attribution_by_weights),
        "delta_display": _delta_display,
        "attribution_compare": _attribution_compare,
        "attribution_own_revenue": on_fact(attribution.attribution_own_revenue),
        "attribution_own_revenue_detailed": on_fact(
            attribution.attribution_own_revenue, details=True
        ),
        # Co-occurrence
        "channel_pairs": on_fact(cooccurrence.channel_pairs),
        "channel_pairs_detailed": on_fact(cooccurrence.channel_pairs, details=True),
        "channel_sets": on_fact(coalitions.channel_sets),
        "isolated_channel_days": on_fact(cooccurrence.isolated_channel_days),
        "monthly_channel_mix": on_fact(cooccurrence.monthly_channel_mix),
        "daily_active_channels": on_fact(cooccurrence.daily_active_channels),
        # Customer journeys
        "build_journeys": on_journeys(journeys.journey_report),
        "journey_touches": _journey_touches,
        "equal_split_weights": on_journeys(journeys.equal_split_weights),
        "path_frequency": on_paths(journeys.path_frequency),
        "path_steps": on_paths(journeys.path_steps),
        "path_trie": _path_trie,
        "journey_sets": on_journeys(coalitions.journey_sets),
        "lookback_touches": _lookback,
        "shapley_conversion": on_worth(coalitions.shapley_conversion_report),
        "shapley_sampled": on_worth(coalitions.shapley_sampled_check),
        "channel_order_frequency": on_journeys(journeys.channel_order_frequency),
        "journey_credit": on_journeys(journeys.journey_credit),
        "shapley_exact": on_journeys(journeys.shapley_exact),
        # Rows, sources and sinks
        "load_fact": fact_table,
        "load_fact_csv": _fact_csv,
        "load_fact_kept": _fact_kept,
        "load_fact_z_ordered": _fact_by_z,
        "load_csv_good_rows": lambda spark, folder: _damaged_csv(spark, folder).good,
        "load_csv_bad_rows": lambda spark, folder: _damaged_csv(spark, folder).bad.drop("file"),
        "apply_filters": _filtered,
        "add_time_columns": on_fact(enrich.add_time_columns),
        "add_row_metrics": on_fact(enrich.add_row_metrics),
        "enrich": on_fact(enrich.enrich),
        "write_enriched": _enriched_parquet,
        "load_enriched_csv": _enriched_csv,
        "profile": on_fact(profile.profile),
        "profile_overview": on_fact(profile.profile_overview),
        "date_bounds": on_fact(profile.date_bounds),
        "describe_metrics": _describe,
    }
