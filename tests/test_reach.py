"""Distinct counts from merged bitmaps against sets in plain Python."""

import datetime
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from paidmedia.functions import distinct
from paidmedia.operators import reach

LEVELS = [("a", "b"), ("a",), ("b",), ()]


def expected(rows, level):
    out = {}
    for row in rows:
        cell = tuple(row[k] for k in level)
        ids = out.setdefault(cell, (set(), set()))
        for seen, name in zip(ids, ("x", "y"), strict=True):
            if row[name] is not None:
                seen.add(row[name])
    return {k: tuple(len(s) for s in v) for k, v in out.items()}


@pytest.mark.parametrize("span", [40, 200_000])
def test_every_level_equals_sets(spark, span):
    rng = random.Random(span)
    # A third of the rows in one cell; ids below zero, at bucket edges, null and repeated.
    rows = [
        {
            "a": "hot" if i % 3 == 0 else rng.choice(["p", "q", None]),
            "b": 1 if i % 3 == 0 else rng.choice([1, 2, None]),
            "x": rng.choice([None, rng.randrange(-span, span), 0, 1, 32768, 32769, -32768]),
            "y": rng.randrange(5),
        }
        for i in range(3000)
    ]
    rows += [{"a": "empty", "b": 7, "x": None, "y": None}]
    frame = spark.createDataFrame(rows, "a string, b int, x long, y int").repartition(5)
    got = distinct.distinct_by_level(frame, LEVELS, {"x": F.col("x"), "y": F.col("y")}).collect()
    for level in LEVELS:
        mine = [r for r in got if r["level"] == ",".join(level)]
        found = {tuple(r[k] for k in level): (r["x"], r["y"]) for r in mine}
        assert len(found) == len(mine)
        assert found == expected(rows, level)
        assert all(r[k] is None for r in mine for k in ("a", "b") if k not in level)


def test_coarse_levels_read_no_orders(spark):
    day = datetime.date(1996, 5, 4)
    orders = spark.createDataFrame(
        [(1, 5, day, "2-HIGH"), (2, 5, day, "5-LOW"), (3, None, day, "2-HIGH"), (4, 6, day, "odd")],
        "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string",
    )
    got = reach.reach_by_level(orders)
    plan = plan_of(got)
    # Every level comes from the written bitmaps: no row of the input is read again.
    assert "Scan ExistingRDD" not in plan and "Expand" not in plan and "bitmap_or_agg" in plan
    total = got.where(F.col("level") == "").first()
    assert (total["customers"], total["days"]) == (2, 1)
    channels = {r["channel"]: (r["customers"], r["days"]) for r in got.where(F.col("level") == "channel").collect()}
    assert channels == {"Meta": (1, 1), "Organic": (1, 1), None: (1, 1)}


def test_empty_input_and_unknown_key(spark):
    empty = spark.createDataFrame([], "a string, b int, x long")
    got = distinct.distinct_by_level(empty, LEVELS, {"x": F.col("x")}).collect()
    assert [(r["level"], r["x"]) for r in got] == [("", 0)]
    with pytest.raises(ValueError, match="first level"):
        distinct.distinct_by_level(empty, [("a",), ("b",)], {"x": F.col("x")})
