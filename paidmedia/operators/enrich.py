"""Row-level columns added to the fact: calendar, ratios, attributed revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidmedia.functions.exprs import double, margin, ratio
from paidmedia.operators.attribution import journey_credits, row_attribution
from paidmedia.sources import schema


def add_time_columns(fact: DataFrame) -> DataFrame:
    return fact.withColumns(
        {
            "year": F.year("date"),
            "month": F.month("date"),
            "quarter": F.quarter("date"),
            "week_number": F.weekofyear("date"),
        }
    )


def add_row_metrics(fact: DataFrame) -> DataFrame:
    """Ratios of each row; 0 where the denominator is zero."""
    customers = F.col("new_customers") + F.col("returning_customers")
    return fact.withColumns(
        {
            "CTR": ratio("clicks", "impressions", 0),
            "CPC": ratio("spend_gbp", "clicks", 0),
            "CPO": ratio("spend_gbp", "orders", 0),
            "ROAS": ratio("revenue_gbp", "spend_gbp", 0),
            "CAC": ratio("spend_gbp", "new_customers", 0),
            "Repeat_Rate": ratio("returning_customers", customers, 0),
            "Contribution_Margin_Proxy": double(margin("revenue_gbp", "spend_gbp")),
        }
    )


def enrich(fact: DataFrame, journeys: DataFrame | None = None) -> DataFrame:
    """The 26-column table: calendar, row ratios and attributed revenue."""
    rows = add_row_metrics(add_time_columns(fact))
    return row_attribution(rows, journey_credits(fact, journeys)).select(
        *schema.ENRICHED.fieldNames()
    )
