"""``marketing_performance`` derived from orders, line items and parts.

Grain: date x channel x campaign_type x creative_type.

Shape of the job at scale:

* line items meet parts on the part key (adaptive execution splits a hot part);
* they are then shuffled once, by order, as keys, two codes and three amounts; one sort of
  a partition marks a line of each (order, campaign, creative) and meets the orders, and
  no table of order cells is aggregated or shuffled again;
* orders learn whether their customer is returning before that join, while rows are
  few and narrow; first touches are unique, so a hot customer's orders can be split;
* a customer's orders of a channel that all fall on days of their own need no distinct
  count: each is one customer of its cells.  Only the others keep their customer in the
  sum over the grain, so the rest shrinks to the grain before it is shuffled;
* an order without a customer, or of an unlisted priority, keeps its revenue: it counts
  as neither a new nor a returning customer, or under channel NULL;
* distinct orders and customers are plain counts on the way: no COUNT(DISTINCT), no
  Expand;
* factors that depend only on the grain are applied after the last sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paidmedia.sources import schema
from paidmedia.sources.store import derived

# Order priority to channel.
CHANNEL_OF_PRIORITY = {
    "1-URGENT": "Google_Search",
    "2-HIGH": "Meta",
    "3-MEDIUM": "TikTok",
    "4-NOT SPECIFIED": "YouTube",
    "5-LOW": "Organic",
}
# Return flag to campaign, part type to creative.
CAMPAIGN_OF_FLAG = {"A": "Prospecting", "N": "Retargeting", "R": "Brand_Awareness"}
CREATIVE_OF_TYPE = {
    "PROMO": "Video_Drop_Test",
    "STANDARD": "UGC_Review",
    "ECONOMY": "Product_Showcase",
}
OTHER_CREATIVE = "Influencer_Collab"
# Impressions and clicks per unit, spend factor of a campaign.
IMPRESSIONS_PER_UNIT = 125
CLICKS_PER_UNIT = {"Google_Search": 8, "Meta": 3, "TikTok": 4, "YouTube": 1, "Organic": 2}
SPEND_OF_CAMPAIGN = {"Prospecting": "1.1", "Retargeting": "0.7", "Brand_Awareness": "1.4"}
BASE_YEAR = 1995

MONEY_SUM = "decimal(28,4)"


def choose(key: Column, values: dict, otherwise: Column | None = None) -> Column:
    out = None
    for k, v in values.items():
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out if otherwise is None else out.otherwise(otherwise)


def order_touches(orders: DataFrame, *extra: Column) -> DataFrame:
    """One row per order: key, customer, date and the channel it came through."""
    return orders.select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("date"),
        choose(F.col("o_orderpriority"), CHANNEL_OF_PRIORITY).alias("channel"),
        *extra,
    )


def first_touches(orders: DataFrame, *extra: Column) -> DataFrame:
    """First date of each known customer on each channel, and ``extra`` aggregates."""
    return (
        order_touches(orders)
        .filter(F.col("o_custkey").isNotNull())
        .groupBy("o_custkey", "channel")
        .agg(F.min("date").alias("first_date"), *extra)
    )


def may_share_a_day() -> Column:
    """Aggregate of a customer's orders: whether two of them may be of one date.

    Each date sets one of 64 bits.  As many bits as orders means as many dates; fewer bits
    may also be dates that are 64 days apart, which costs work and changes no result.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.unix_date("date"), F.lit(64)))
    return F.bit_count(F.bit_or(bit)) < F.count("date")


SUMS = ("units", "price_e2", "discount_e4")


def sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in SUMS]


def creatives(part: DataFrame) -> DataFrame:
    """Creative of each part."""
    return part.select(
        F.col("p_partkey").alias("l_partkey"),
        choose(F.col("p_type"), CREATIVE_OF_TYPE, F.lit(OTHER_CREATIVE)).alias("creative_type"),
    )


def code_of(value: Column, values: Sequence[str]) -> Column:
    """Place of a text in a list: shuffled and sorted instead of the text."""
    return choose(value, {v: F.lit(i).cast("tinyint") for i, v in enumerate(values)})


def text_of(code: Column, values: Sequence[str]) -> Column:
    return choose(code, dict(enumerate(values)))


def line_values(lineitem: DataFrame) -> DataFrame:
    """Order, part, campaign and the three amounts of each line."""
    # Prices are whole pennies and discounts whole hundredths: integer arithmetic per
    # row, and DECIMAL sums that no hot group can overflow.
    pennies = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    hundredths = F.rint(F.col("l_discount") * 100).cast("bigint")
    return lineitem.select(
        "l_orderkey",
        "l_partkey",
        choose(F.col("l_returnflag"), CAMPAIGN_OF_FLAG).alias("campaign_type"),
        F.col("l_quantity").cast("bigint").alias("units"),
        pennies.cast("decimal(14,0)").alias("price_e2"),
        (pennies * hundredths).cast("decimal(18,0)").alias("discount_e4"),
    )


def with_returning(rows: DataFrame, first: DataFrame, *extra: str) -> DataFrame:
    """``rows`` of a customer, channel and date, whether the customer came before, and
    ``extra`` columns of the customer's first touch."""
    return rows.alias("t").join(
        first.alias("f"),
        (F.col("t.o_custkey") == F.col("f.o_custkey"))
        & F.col("t.channel").eqNullSafe(F.col("f.channel")),
        "left",
    ).select(
        "t.*", (F.col("date") > F.col("first_date")).alias("returning"), *[f"f.{c}" for c in extra]
    )


def build_fact(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    # A line of a null order meets none, and would crowd one partition.
    lines = line_values(lineitem.where(F.col("l_orderkey").isNotNull())).select(
        "l_orderkey",
        "l_partkey",
        code_of(F.col("campaign_type"), schema.CAMPAIGN_TYPES).alias("campaign"),
        *SUMS,
    )
    parts = creatives(part).select(
        "l_partkey", code_of(F.col("creative_type"), schema.CREATIVE_TYPES).alias("creative")
    )
    coded = lines.join(parts, "l_partkey").drop("l_partkey").repartition("l_orderkey")
    # Partitions and order suit the join that follows: it neither shuffles nor sorts again.
    of_cell = Window.partitionBy("l_orderkey", "campaign", "creative").orderBy("l_orderkey")
    marked = coded.withColumn("cells", (F.row_number().over(of_cell) == 1).cast("bigint"))
    touches = with_returning(
        order_touches(orders.where(F.col("o_orderkey").isNotNull())),
        first_touches(orders, may_share_a_day().alias("shares")),
        "shares",
    ).select("o_orderkey", "date", "channel", "returning", F.when(F.col("shares"), F.col("o_custkey")).alias("o_custkey"))
    met = marked.join(touches, F.col("l_orderkey") == F.col("o_orderkey"))
    return fact_of(
        met.withColumns(
            {
                "campaign_type": text_of(F.col("campaign"), schema.CAMPAIGN_TYPES),
                "creative_type": text_of(F.col("creative"), schema.CREATIVE_TYPES),
            }
        )
    )


def fact_of(rows: DataFrame, *extra: str) -> DataFrame:
    """The fact of lines, or of order cells, that know their order's customer, date and channel
    and whether the customer is returning.

    ``cells`` is 1 on one row of each order, campaign and creative and 0 on its others.  A null
    customer who is new or returning stands for one whose day on the channel has no other order.
    ``extra`` names columns that the grain decides; they follow the fact's own.
    """
    per_customer = rows.groupBy("o_custkey", "returning", *schema.GRAIN, *extra).agg(
        F.sum("cells").alias("orders"), *sums()
    )
    customers = F.when(F.col("o_custkey").isNull(), F.col("orders")).otherwise(1)
    grain = per_customer.groupBy(*schema.GRAIN, *extra).agg(
        F.sum("orders").alias("orders"),
        F.sum(F.when(~F.col("returning"), customers).otherwise(0)).alias("new_customers"),
        F.sum(F.when(F.col("returning"), customers).otherwise(0)).alias("returning_customers"),
        *sums(),
    )
    return with_measures(grain, *extra)


def with_measures(grain: DataFrame, *extra: str) -> DataFrame:
    """The fact of orders, new and returning customers and the three amounts per grain."""
    years = (F.year("date") - BASE_YEAR).cast("decimal(4,0)")
    fixed = lambda n: F.lit(n).cast("decimal(4,0)")
    channel_rate = choose(
        F.col("channel"),
        {
            "Google_Search": fixed(4),
            "Meta": fixed(5),
            "TikTok": (fixed(10) - years).cast("decimal(4,0)"),
            "YouTube": (fixed(8) + years).cast("decimal(4,0)"),
            "Organic": fixed(0),
        },
    )
    campaign_rate = choose(F.col("campaign_type"), SPEND_OF_CAMPAIGN).cast("decimal(3,1)")
    price = (F.col("price_e2") * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY_SUM)
    discount = (F.col("discount_e4") * F.lit("0.0001").cast("decimal(5,4)")).cast(MONEY_SUM)
    revenue = F.round(price - discount, 2).cast(schema.MONEY)
    order_value = revenue.cast("double") / F.col("orders").cast("double")
    return grain.select(
        *schema.GRAIN,
        (F.col("units") * IMPRESSIONS_PER_UNIT).alias("impressions"),
        (F.col("units") * choose(F.col("channel"), CLICKS_PER_UNIT).cast("bigint")).alias("clicks"),
        F.round(discount * channel_rate * campaign_rate, 2)
        .cast(schema.MONEY)
        .alias("spend_gbp"),
        "orders",
        revenue.alias("revenue_gbp"),
        "new_customers",
        "returning_customers",
        F.round(order_value.cast("decimal(38,10)"), 2).cast(schema.MONEY).alias("avg_order_value_gbp"),
        *extra,
    )


def raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def laid_out(fact: DataFrame) -> DataFrame:
    """Range-partitioned by the whole grain, date first: row-group statistics prune date
    filters, and no date is too large for one partition."""
    return fact.repartitionByRange(*schema.GRAIN).sortWithinPartitions(*schema.GRAIN)


def fact_table(spark: SparkSession, folder: str) -> DataFrame:
    """The fact of a data folder, built once per application and then scanned."""

    def build() -> DataFrame:
        return laid_out(
            build_fact(
                raw(spark, folder, "orders"),
                raw(spark, folder, "lineitem"),
                raw(spark, folder, "part"),
            )
        )

    inputs = [f"{folder}/{t}.parquet" for t in ("orders", "lineitem", "part")]
    return derived(spark, f"fact:{folder}", inputs, build)


def register_fact_view(
    spark: SparkSession, folder: str, view: str = "marketing_performance"
) -> DataFrame:
    """Expose the fact to ``spark.sql`` under the table name reports are written against."""
    fact = fact_table(spark, folder)
    fact.createOrReplaceTempView(view)
    return fact
