"""Data checks: shape, types, missing values, summary statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidmedia.functions.exprs import EXACT, double, ratio, rounded
from paidmedia.functions.scans import same
from paidmedia.functions.selection import exact_quantiles

DESCRIBED = ["spend_gbp", "revenue_gbp", "ROAS", "CAC", "CTR", "Repeat_Rate"]


def date_bounds(fact: DataFrame) -> DataFrame:
    return fact.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: its type, the row count and how many values are missing."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    types = dict(df.dtypes)
    listed = ", ".join(
        f"{i + 1}, '{c}', '{types[c]}', _{i}" for i, c in enumerate(df.columns)
    )
    return counted.selectExpr(
        "_rows AS row_count",
        f"stack({len(df.columns)}, {listed}) AS (position, column_name, data_type, null_count)",
    ).select("position", "column_name", "data_type", "row_count", "null_count")


def profile_overview(fact: DataFrame) -> DataFrame:
    """Shape, date range and the sorted list of channels."""
    return fact.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(fact.columns)).cast("bigint").alias("column_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.array_join(F.array_sort(F.collect_set("channel")), ", ").alias("channels"),
    )


def describe_metrics(
    df: DataFrame, columns: Sequence[str] = DESCRIBED, slices: int | None = None
) -> DataFrame:
    """count, mean, sample deviation, minimum, exact quartiles and maximum per column.

    Sums of values and of their squares are DECIMAL, so they do not depend on order, and
    are added up before the shuffle; quartiles keep only the values that a sketch brackets.
    """
    listed = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {listed}) AS (metric, value)")
    # Six digits, so that the sum of squares of amounts to the billion fits.
    coarse = F.col("value").cast("decimal(16,6)")
    sums = [
        F.count("value").alias("count"),
        F.sum(F.col("value").cast(EXACT)).alias("sum"),
        F.sum((coarse * coarse).cast("decimal(32,12)")).cast("decimal(38,12)").alias("squares"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ]
    rest = double("squares") - double("sum") * double("sum") / F.col("count")
    spread = exact_quantiles(long, "metric", "value", {"p25": 0.25, "p50": 0.50, "p75": 0.75}, slices, sums)
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "metric string")
    return (
        every.alias("e")
        .join(spread.alias("s"), same("e", "s", ["metric"]), "left")
        .drop(F.col("s.metric"))
        .withColumn("mean", ratio("sum", "count"))
        .withColumn("std", F.when(F.col("count") > 1, F.sqrt(F.greatest(rest, F.lit(0.0)) / (F.col("count") - 1))))
        .withColumn("count", F.coalesce("count", F.lit(0)))
        .select(
            "metric",
            "count",
            *[rounded(c, 3).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")],
        )
    )
