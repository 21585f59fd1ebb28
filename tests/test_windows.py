"""Interval joins, Bloom filters and the reports on them, with hot days, nulls and empty sides."""

import datetime
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from paidmedia.functions import bloom, intervals
from paidmedia.operators import windows
from paidmedia.sources.touchpoints import touchpoints

ORDERS = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice double"


def sides(seed, hot):
    """Intervals of up to 12 units and points of which a third may lie on one of them."""
    rng = random.Random(seed)
    low = [(i, rng.choice(["a", "b", None]), rng.randrange(-50, 50)) for i in range(60)]
    left = [(i, k, a, a + rng.randrange(0, 12)) for i, k, a in low] + [(99, "a", None, 5), (98, "a", 9, 3), (97, "zz", 0, 5)]
    right = [(i, rng.choice(["a", "b", None]), rng.randrange(-60, 70)) for i in range(300)]
    right += [(1000 + i, "a", 7) for i in range(150 if hot else 0)] + [(2000, "a", None)]
    return left, right


def frames(spark, left, right):
    return (
        spark.createDataFrame(left, "id long, k string, low long, high long"),
        spark.createDataFrame(right, "pid long, k string, at long").repartition(3),
    )


def inside(i, p):
    return None not in (i[1], i[2], p[1], p[2]) and i[1] == p[1] and i[2] <= p[2] <= i[3]


@pytest.mark.parametrize("width", [1, 10, 1000])
@pytest.mark.parametrize("hot_rows", [20, 1_000_000])
def test_pairs_and_totals_against_every_pair(spark, width, hot_rows):
    left, right = sides(width, True)
    a, b = frames(spark, left, right)
    args = (["k"], ("low", "high"), "at", width)
    pairs = intervals.interval_pairs(a, b, *args, hot_rows=hot_rows).select("i.id", "p.pid")
    assert sorted(map(tuple, pairs.collect())) == sorted((i[0], p[0]) for i in left for p in right if inside(i, p))
    totals = intervals.interval_totals(a, b, *args, [F.count("p.pid").alias("n"), F.sum("p.at").alias("s")], hot_rows=hot_rows)
    got = {r["id"]: (r["n"], r["s"]) for r in totals.collect()}
    for i in left:
        found = [p[2] for p in right if inside(i, p)]
        assert got[i[0]] == (len(found), sum(found) if found else None)
    assert len(got) == len(left)


def test_no_pair_of_rows_is_compared_without_a_key(spark):
    a, b = frames(spark, *sides(3, True))
    joined = intervals.interval_totals(a, b, ["k"], ("low", "high"), "at", 10, [F.count("p.pid").alias("n")], hot_rows=20)
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "k" in plan and "_bucket" in plan and "_part" in plan


def test_a_hot_bucket_is_split(spark):
    """A third of the points on one day: no (key, bucket, part) keeps more than about ``hot_rows``."""
    left, right = sides(4, True)
    a, b = frames(spark, left, right)
    _, dealt = intervals._dealt(a, b, ["k"], ("low", "high"), "at", 10, 20)
    sizes = [r["n"] for r in dealt.groupBy("k", "_bucket", "_part").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 40


@pytest.mark.parametrize("empty", ["left", "right", "both"])
def test_empty_sides(spark, empty):
    left, right = sides(1, False)
    a, b = frames(spark, [] if empty != "right" else left, [] if empty != "left" else right)
    got = intervals.interval_totals(a, b, ["k"], ("low", "high"), "at", 10, [F.count("p.pid").alias("n")]).collect()
    assert len(got) == (len(left) if empty == "right" else 0) and all(r["n"] == 0 for r in got)


def test_semi_join_is_exact_and_shuffles_less(spark):
    """One row in fifty has a partner; the filter drops nearly all others before the join."""
    rows = spark.range(50_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    build = spark.range(1000).select((F.col("id") * 50).alias("k"), F.lit(3).cast("long").alias("least"))
    words = bloom.words_for(1000)
    sieved = bloom.may_match(rows, bloom.bloom_filter(build, ["k"], words), ["k"], words)
    kept = {r["k"] for r in sieved.collect()}
    assert set(range(0, 50_000, 50)) <= kept
    assert len(kept) < 1000 + 0.15 * 49_000
    got = bloom.semi_join(rows, build, ["k"], F.col("d.v") > F.col("b.least"))
    assert sorted(r["k"] for r in got.collect()) == [k for k in range(0, 50_000, 50) if k % 7 > 3]
    plan = plan_of(got)
    assert "LeftSemi" in plan and "NestedLoop" not in plan


def test_a_full_filter_only_lets_more_through(spark):
    rows = spark.createDataFrame([(i if i % 5 else None,) for i in range(300)], "k long")
    build = spark.createDataFrame([(i if i % 3 else None,) for i in range(300)], "k long")
    got = bloom.semi_join(rows, build, ["k"], words=1)
    assert sorted(r["k"] for r in got.collect()) == [i for i in range(300) if i % 5 and i % 3]
    assert bloom.words_for(10**12) == bloom.MOST_WORDS and bloom.words_for(0) >= 64
    assert bloom.semi_join(rows, build.limit(0), ["k"]).count() == 0


def test_a_filter_travels_in_blocks_of_words(spark):
    """Before, each word was a row, so the driver built a million rows for 8 MB of words."""
    rows = spark.range(40_000).select(F.col("id").alias("k"))
    build = rows.where("k % 4 = 0")
    words = 4 * bloom.BLOCK
    blocks = bloom.bloom_filter(build, ["k"], words)
    assert [(r["_block"], len(r["_words"])) for r in blocks.orderBy("_block").collect()] == [(b, bloom.BLOCK) for b in range(4)]
    kept = {r["k"] for r in bloom.may_match(rows, blocks, ["k"], words).collect()}
    assert set(range(0, 40_000, 4)) <= kept and len(kept) < 10_000 + 0.15 * 30_000
    plan = plan_of(bloom.semi_join(rows, build, ["k"]))
    assert len([p for p in plan.split("\n\n") if ") BroadcastExchange" in p.split("\n")[0]]) == 1


def test_cohorts_keep_those_without_orders(spark, rows):
    day = datetime.datetime
    orders = spark.createDataFrame(
        [
            (1, 1, day(2000, 1, 5), "3-MEDIUM", 5.0), (2, 1, day(2000, 3, 31), "3-MEDIUM", 7.0), (3, 1, day(2000, 4, 2), "3-MEDIUM", 9.0),
            (4, None, day(2000, 1, 1), "3-MEDIUM", 1.0), (5, 2, day(2001, 1, 1), None, 2.0), (6, 3, day(2000, 1, 9), "3-MEDIUM", 4.0),
        ],
        ORDERS,
    )
    (got,) = rows(windows.cohort_orders_90d(orders))
    # 2000-01-01 and 90 days later, 2000-03-31, belong to the window.
    assert (got["new_customers"], got["orders_90d"], got["revenue_90d_gbp"]) == (2, 4, 17.0)
    assert got["revenue_per_new_customer"] == 8.5


def test_lookback_over_earlier_conversions(spark, rows):
    at = datetime.datetime(2024, 1, 10)
    day = datetime.timedelta(days=1)
    events = [
        (1, at - 8 * day, 7, "view", None, '{"k": 0}'), (2, at - 7 * day, 7, "click", None, '{"k": 1}'),
        (3, at - 2 * day, 7, "purchase", 5.0, None), (4, at - day, 7, "view", None, '{"k": 1}'), (5, at, 7, "purchase", 6.0, None),
        (6, at, 7, "view", None, '{"k": 2}'), (7, at, 8, "purchase", 1.0, None), (8, at, None, "purchase", 1.0, None),
    ]
    frame = spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    got = rows(windows.lookback_touches(touchpoints(frame)), "conversion_id")
    assert [got[5][c] for c in ("touches", "channels", "last_channel", "minutes_since_last")] == [2, "TikTok", "TikTok", 1440]
    assert [got[3][c] for c in ("touches", "channels", "last_channel")] == [2, "Meta + TikTok", "TikTok"]
    assert [got[7][c] for c in ("touches", "distinct_channels", "last_channel", "minutes_since_last")] == [0, 0, None, None]
    assert set(got) == {3, 5, 7}


def test_crossover_needs_an_earlier_day(spark, rows):
    day = datetime.datetime
    orders = spark.createDataFrame(
        [
            (1, 1, day(2000, 1, 5), "3-MEDIUM", 5.0), (2, 1, day(2000, 1, 5), "1-URGENT", 6.0), (3, 1, day(2000, 1, 6), "1-URGENT", 7.0),
            (4, 2, day(2000, 1, 6), "1-URGENT", 7.0), (5, None, day(2000, 1, 1), "3-MEDIUM", 1.0), (6, None, day(2000, 2, 1), "1-URGENT", 1.0),
        ],
        ORDERS,
    )
    assert rows(windows.crossover_orders(orders)) == [
        {"month": datetime.date(2000, 1, 1), "customers": 1, "orders": 1, "revenue_gbp": 7.0}
    ]
