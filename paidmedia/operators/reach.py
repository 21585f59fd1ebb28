"""How many customers and days each channel reached, at every level of the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidmedia.functions.distinct import distinct_by_level
from paidmedia.sources.fact import order_touches

CALENDAR = [("year", "quarter", "month"), ("year", "quarter"), ("year",), ()]
#: Finest first: every channel by month, quarter, year and in all, then all channels together.
LEVELS = [("channel", *c) for c in CALENDAR] + CALENDAR


def reach_by_level(orders: DataFrame) -> DataFrame:
    """Distinct customers and days with orders; they do not add up from month to year, so each
    level merges the bitmaps of a finer one.  Orders without a customer make days, not customers."""
    touches = order_touches(orders).select(
        "channel",
        "date",
        "o_custkey",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
    )
    return distinct_by_level(
        touches, LEVELS, {"customers": F.col("o_custkey"), "days": F.unix_date("date")}
    )
