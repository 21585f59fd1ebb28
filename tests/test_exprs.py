"""Rounded quotients against exact fractions."""

import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from paidmedia.functions.exprs import percent, rounded_ratio


def half_away(q: Fraction, digits: int) -> float:
    k = (2 * abs(q) * 10**digits + 1) // 2
    return float(Decimal(-k if q < 0 else k).scaleb(-digits)) + 0.0


@pytest.fixture(scope="module")
def quotients(spark):
    rng = random.Random(3)
    rows = [
        (Decimal("24699999999.99"), Decimal("200000000000.00")),  # just below 0.1235
        (Decimal("0.12"), Decimal("0.96")),  # a tie
        (Decimal("-0.12"), Decimal("0.96")),
        (Decimal("0.12"), Decimal("-0.96")),
        (Decimal("0.00"), Decimal("-3.00")),
        (Decimal("99999999999999.99"), Decimal("0.01")),
    ]
    for _ in range(200):
        den = rng.randrange(1, 10 ** rng.randrange(1, 16))
        rows.append((Decimal(rng.randrange(-den, 9 * den)).scaleb(-2), Decimal(den).scaleb(-2)))
    return spark.createDataFrame(rows, "num decimal(22,2), den decimal(22,2)"), rows


@pytest.mark.parametrize(("digits", "times"), [(0, 1), (2, 1), (3, 1), (1, 100), (3, 100)])
def test_quotients_are_rounded_once(quotients, digits, times):
    df, rows = quotients
    got = df.select("num", "den", rounded_ratio("num", "den", digits, times).alias("q")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["q"] == half_away(Fraction(r["num"]) / Fraction(r["den"]) * times, digits)


def test_without_code_generation_too(quotients, spark):
    df, _ = quotients
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    try:
        assert df.select(rounded_ratio("num", "den", 3)).first()[0] == 0.123
    finally:
        spark.conf.unset("spark.sql.codegen.wholeStage")


def test_counts_zero_and_null(spark):
    df = spark.createDataFrame([(1, 8), (1, 0), (None, 3), (3, None)], "num long, den long")
    assert [r[0] for r in df.select(percent("num", "den", 1)).collect()] == [12.5, None, None, None]
    amount = F.lit(Decimal("1.5"))
    assert df.select(rounded_ratio(amount, "den", 2)).first()[0] == 0.19
