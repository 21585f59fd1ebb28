"""Column expressions with one fixed meaning across all operators.

Money and ratios are summed as DECIMAL, so no result depends on the order in
which partitions arrive; DOUBLE appears only in the last projection.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORGANIC = "Organic"
GROSS_MARGIN = "0.45"

# Row ratios are averaged at this type: exact sums, ten digits after the point.
EXACT = "decimal(28,10)"


def paid(df: DataFrame, organic: str = ORGANIC) -> DataFrame:
    """Rows of paid channels; a NULL channel is dropped as well."""
    return df.filter(F.col("channel") != F.lit(organic))


def with_spend(df: DataFrame) -> DataFrame:
    return df.filter(F.col("spend_gbp") > 0)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def double(c: str | Column) -> Column:
    return col(c).cast("double")


def ratio(num: str | Column, den: str | Column, on_zero: float | None = None) -> Column:
    """num / den as DOUBLE.

    ``on_zero=None`` gives NULL where the denominator is zero; a number is
    returned wherever the denominator is not positive (zero or NULL).
    """
    quotient = F.try_divide(double(num), double(den))
    if on_zero is None:
        return quotient
    return F.when(col(den) > 0, quotient).otherwise(F.lit(float(on_zero)))


def rounded(c: str | Column, digits: int) -> Column:
    """Half away from zero, on the decimal value rather than its binary image."""
    return F.round(col(c).cast("decimal(38,10)"), digits).cast("double")


def rounded_even(c: str | Column, digits: int) -> Column:
    return F.bround(col(c).cast("decimal(38,10)"), digits).cast("double")


def _millionths(c: str | Column) -> Column:
    return (col(c).cast("decimal(30,6)") * 1_000_000).cast("decimal(30,0)")


def rounded_ratio(num: str | Column, den: str | Column, digits: int, times: int = 1) -> Column:
    """num * times / den as DOUBLE, rounded once, half away from zero.

    Both sides are whole millionths, so counts and amounts divide exactly and a quotient
    just below a tie stays below it.  NULL where the denominator is zero.
    """
    n, d = _millionths(num), _millionths(den)
    raised = F.abs(n) * F.lit(2 * times * 10**digits) + F.abs(d)
    divisor = F.nullif(F.abs(d) * 2, F.lit(0))
    # Without its remainder the division is exact; the div operator would stop at a long.
    whole = ((raised - raised % divisor) / divisor).cast("decimal(28,0)")
    signed = F.when((n < 0) != (d < 0), -whole).otherwise(whole)
    return (signed * F.lit(Decimal(1).scaleb(-digits))).cast("double")


def percent(num: str | Column, den: str | Column, digits: int) -> Column:
    return rounded_ratio(num, den, digits, 100)


def mean(c: str | Column) -> Column:
    """Aggregate: exact decimal sum over the count of non-NULL values."""
    return ratio(F.sum(col(c)), F.count(col(c)))


def margin(revenue: str | Column, spend: str | Column, gross_margin: str = GROSS_MARGIN) -> Column:
    """Contribution margin as DECIMAL."""
    return col(revenue) * F.lit(gross_margin).cast("decimal(3,2)") - col(spend)


def month_start(date: str | Column = "date") -> Column:
    return F.trunc(col(date), "month")


def month_index(date: str | Column) -> Column:
    return F.year(col(date)) * 12 + F.month(col(date))


def totals(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Sums of every measure by key.

    One shuffle with map-side combine; Catalyst prunes the sums a caller does
    not use, and the scan reads only the columns of those that remain.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("spend_gbp").alias("spend"),
        F.sum("orders").alias("orders"),
        F.sum("revenue_gbp").alias("revenue"),
        F.sum("new_customers").alias("new_customers"),
        F.sum("returning_customers").alias("returning_customers"),
    )
