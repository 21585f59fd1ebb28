"""Small parameter tables: channel weights, shares, economics, scenarios, journeys.

They are inline relations, so Catalyst knows their size exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from paidmedia.sources import schema

# Credit weight of each channel.
CHANNEL_WEIGHTS = [
    ("Meta", "0.358"),
    ("TikTok", "0.273"),
    ("YouTube", "0.177"),
    ("Google_Search", "0.192"),
]

# Share of its own revenue a channel keeps under last-click.
LASTCLICK_SHARES = [
    ("Meta", "0.82"),
    ("TikTok", "0.00"),
    ("YouTube", "0.00"),
    ("Google_Search", "1.00"),
]

# Channel, average order value, new customers per order.
CHANNEL_ECONOMICS = [
    ("Meta", "55", "0.55"),
    ("TikTok", "48", "0.70"),
    ("YouTube", "62", "0.45"),
    ("Google_Search", "58", "0.40"),
]

# Budget split in percent, and the budget it splits.
DEFAULT_ALLOCATION = [("Meta", "35"), ("TikTok", "20"), ("YouTube", "15"), ("Google_Search", "30")]
DEFAULT_BUDGET = 100000

# Journey path and its share of revenue.
JOURNEY_TEMPLATES = [
    (["TikTok", "Meta", "Google_Search"], "0.22"),
    (["Meta", "Google_Search"], "0.18"),
    (["YouTube", "Meta", "Google_Search"], "0.12"),
    (["TikTok", "Google_Search"], "0.10"),
    (["Meta", "Meta", "Google_Search"], "0.09"),
    (["YouTube", "Meta"], "0.07"),
    (["Google_Search"], "0.06"),
    (["Meta"], "0.05"),
    (["TikTok", "Meta"], "0.06"),
    (["YouTube", "Google_Search"], "0.05"),
]


def _literal(value) -> str:
    if isinstance(value, (list, tuple)):
        return f"array({', '.join(_literal(v) for v in value)})"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline(spark: SparkSession, columns: str, rows: Sequence[Sequence]) -> DataFrame:
    """Inline relation; ``columns`` is a DDL list such as ``channel string, weight double``."""
    named = [c.strip().split(" ", 1) for c in columns.split(";")]
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(n for n, _ in named)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in named)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")


def channels(spark: SparkSession, names: Sequence[str] = schema.PAID_CHANNELS) -> DataFrame:
    return inline(spark, "channel string", [(n,) for n in names])


def channel_weights(spark: SparkSession) -> DataFrame:
    return inline(spark, "channel string; weight decimal(4,3)", CHANNEL_WEIGHTS)


def lastclick_shares(spark: SparkSession) -> DataFrame:
    return inline(spark, "channel string; share decimal(4,2)", LASTCLICK_SHARES)


def channel_economics(spark: SparkSession) -> DataFrame:
    return inline(spark, "channel string; aov double; nc_ratio double", CHANNEL_ECONOMICS)


def scenarios(
    spark: SparkSession,
    allocation: Sequence[tuple] = DEFAULT_ALLOCATION,
    budget: float = DEFAULT_BUDGET,
    scenario_id: str = "default",
) -> DataFrame:
    return inline(
        spark,
        "scenario_id string; budget double; channel string; pct double",
        [(scenario_id, budget, channel, pct) for channel, pct in allocation],
    )


def journey_templates(
    spark: SparkSession, templates: Sequence[tuple] = JOURNEY_TEMPLATES
) -> DataFrame:
    return inline(
        spark,
        "journey_id int; path array<string>; share decimal(9,6)",
        [(i, path, share) for i, (path, share) in enumerate(templates, 1)],
    )
