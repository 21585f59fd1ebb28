"""Customer touchpoints and the conversions they lead to, from the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidmedia.functions.scans import running_totals

# Event types and the channel of an event number modulo 4.
TOUCH_TYPES = ["view", "click", "signup"]
CONVERSION_TYPE = "purchase"
EVENT_CHANNELS = ["Meta", "TikTok", "YouTube", "Google_Search"]

# The channel of a touch whose event number cannot be read; it earns credit like any other.
UNKNOWN = "Unknown"


def touchpoints(events: DataFrame) -> DataFrame:
    """Touches and conversions; other event types are not part of a journey.

    Events without a customer belong to nobody's journey and are left out.
    """
    number = F.get_json_object("props", "$.k").try_cast("int")
    listed = F.array(*[F.lit(c) for c in EVENT_CHANNELS])
    # get() gives NULL for a NULL place, with and without generated code.
    channel = F.get(listed, F.pmod(number, F.lit(len(EVENT_CHANNELS))))
    converts = F.col("event_type") == CONVERSION_TYPE
    part = F.col("event_type").isin(*TOUCH_TYPES, CONVERSION_TYPE) & F.col("user_id").isNotNull()
    return events.filter(part).select(
        F.col("user_id").alias("customer_id"),
        "ts",
        "event_id",
        F.when(~converts, F.coalesce(channel, F.lit(UNKNOWN))).alias("channel"),
        F.when(converts, F.col("value").cast("decimal(18,2)")).alias("revenue"),
        F.when(converts, 1).otherwise(0).cast("bigint").alias("is_conversion"),
        F.when(converts, 0).otherwise(1).cast("bigint").alias("is_touch"),
    )


def numbered_touchpoints(touches: DataFrame, slices: int | None = None) -> DataFrame:
    """Touchpoints with the number of the journey they belong to.

    A journey ends with a conversion; it holds the customer's touches since the
    conversion before.  ``touch_no`` counts the customer's touches up to the row.
    """
    counted = running_totals(
        touches,
        ["customer_id"],
        ["ts", "event_id"],
        {"conversions": "is_conversion", "touch_no": "is_touch"},
        slices,
    )
    return counted.withColumn(
        "journey_no", F.col("conversions") + F.when(F.col("is_touch") == 1, 1).otherwise(0)
    )
