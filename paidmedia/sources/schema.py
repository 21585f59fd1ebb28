"""Schemas of the fact table and of its enriched form."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(18, 2)
GRAIN = ["date", "channel", "campaign_type", "creative_type"]

# The closed domains of the grain columns.
PAID_CHANNELS = ["Meta", "TikTok", "YouTube", "Google_Search"]
CHANNELS = ["Meta", "TikTok", "YouTube", "Google_Search", "Organic"]
CAMPAIGN_TYPES = ["Prospecting", "Retargeting", "Brand_Awareness"]
CREATIVE_TYPES = ["Video_Drop_Test", "UGC_Review", "Product_Showcase", "Influencer_Collab"]


def _struct(*columns: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns])


FACT = _struct(
    ("date", DateType()),
    ("channel", StringType()),
    ("campaign_type", StringType()),
    ("creative_type", StringType()),
    ("impressions", LongType()),
    ("clicks", LongType()),
    ("spend_gbp", MONEY),
    ("orders", LongType()),
    ("revenue_gbp", MONEY),
    ("new_customers", LongType()),
    ("returning_customers", LongType()),
    ("avg_order_value_gbp", MONEY),
)

ENRICHED = StructType(
    FACT.fields
    + _struct(
        ("year", IntegerType()),
        ("month", IntegerType()),
        ("quarter", IntegerType()),
        ("week_number", IntegerType()),
        ("CTR", DoubleType()),
        ("CPC", DoubleType()),
        ("CPO", DoubleType()),
        ("ROAS", DoubleType()),
        ("CAC", DoubleType()),
        ("Repeat_Rate", DoubleType()),
        ("Contribution_Margin_Proxy", DoubleType()),
        ("revenue_lastclick", DoubleType()),
        ("revenue_shapley", DoubleType()),
        ("shapley_vs_lc_delta_pct", DoubleType()),
    ).fields
)
