"""Lattices against every subset, Shapley values against all orders, and the trie of paths."""

import itertools
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paidmedia.functions import subsets
from paidmedia.operators import coalitions, cooccurrence, journeys
from paidmedia.sources.touchpoints import numbered_touchpoints

TOUCHES = (
    "customer_id long, ts long, event_id long, channel string, revenue decimal(18,2), is_conversion long, is_touch long"
)


@pytest.mark.parametrize("bits", [1, 4, 7])
def test_subset_and_superset_sums(spark, bits):
    rng = random.Random(bits)
    rows = [(rng.randrange(1 << bits), rng.randrange(-5, 20)) for _ in range(40)]
    frame = spark.createDataFrame(rows, "mask long, n long")
    got = {r["mask"]: r["n"] for r in subsets.subset_sums(frame, "mask", bits, ["n"]).collect()}
    over = {r["mask"]: r["n"] for r in subsets.superset_sums(frame, "mask", bits, ["n"]).collect()}
    for m in range(1 << bits):
        inside = [n for k, n in rows if k & m == k]
        holding = [n for k, n in rows if k & m == m]
        assert got.get(m) == (sum(inside) if inside else None)
        assert over.get(m) == (sum(holding) if holding else None)


def test_masks_and_members(spark):
    names = ["a", "b", "c"]
    frame = spark.createDataFrame([(["c", "a"],), ([],), (None,), (["b", "x", None],)], "s array<string>")
    mask = subsets.mask_of(F.col("s"), names)
    got = frame.select(mask.alias("m"), subsets.members_of(mask, names).alias("s")).collect()
    assert [(r["m"], r["s"]) for r in got] == [(5, ["a", "c"]), (0, []), (0, []), (2, ["b"])]


def test_pairs_of_the_lattice_are_the_channel_pairs(make_fact, rows):
    rng = random.Random(5)
    fact = make_fact(
        *[
            {"date": f"2022-01-{d:02d}", "channel": c, "spend_gbp": rng.randrange(0, 50)}
            for d in range(1, 29)
            for c in ("Meta", "TikTok", "YouTube", "Google_Search", "Organic")
            if rng.random() < 0.6
        ]
    )
    sets = rows(coalitions.channel_sets(fact), "channel_set")
    pairs = rows(cooccurrence.channel_pairs(fact, min_pairs=0, details=True), "channel_pair")
    assert {k: v["days"] for k, v in sets.items() if v["size"] == 2} == {k: v["distinct_days"] for k, v in pairs.items()}
    # One row per date and channel here, so the sums agree as well.
    assert {k: v["combined_spend"] for k, v in sets.items() if v["size"] == 2} == {
        k: v["combined_spend"] for k, v in pairs.items()
    }
    days = {}
    for r in fact.collect():
        if r["spend_gbp"] > 0 and r["channel"] != "Organic":
            days.setdefault(r["date"], set()).add(r["channel"])
    for name, row in sets.items():
        members = set(name.split(" + "))
        n = sum(members <= d for d in days.values())
        expected = math.prod(sum(m in d for d in days.values()) / len(days) for m in members)
        assert row["days"] == n and row["lift"] == pytest.approx(n / len(days) / expected, abs=6e-5)
    assert {v["size"] for v in sets.values()} == {2, 3, 4}


def worth_of(spark, n, seed):
    rng = random.Random(seed)
    values = [0.0] + [rng.random() for _ in range((1 << n) - 1)]
    return values, spark.createDataFrame(list(enumerate(values)), "mask long, worth double")


def test_enumeration_is_the_mean_over_all_orders(spark):
    names = list("abcde")
    values, worth = worth_of(spark, 5, 1)
    want = dict.fromkeys(range(5), 0.0)
    for order in itertools.permutations(range(5)):
        mask = 0
        for k in order:
            want[k] += (values[mask | 1 << k] - values[mask]) / 120
            mask |= 1 << k
    got = {r["k"]: r["value"] for r in coalitions.shapley_conversion(worth, names).collect()}
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(values[-1])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sampled_values_lie_within_their_errors(spark, seed):
    """Eight players: 2,000 of 40,320 orders; errors shrink as more orders are drawn."""
    names = list("abcdefgh")
    _, worth = worth_of(spark, 8, seed)
    exact = {r["k"]: r["value"] for r in coalitions.shapley_conversion(worth, names).collect()}
    errors = []
    for n in (500, 2000):
        got = {r["k"]: r for r in coalitions.shapley_sampled(worth, names, n, seed).collect()}
        assert all(abs(r["estimate"] - exact[k]) <= 4 * r["standard_error"] for k, r in got.items())
        # Each order's gains add up to the worth of all.
        assert sum(r["estimate"] for r in got.values()) == pytest.approx(sum(exact.values()))
        errors.append(sum(r["standard_error"] for r in got.values()))
    assert errors[1] < 0.6 * errors[0]


def test_worth_counts_journeys_that_did_not_convert(spark):
    rows = [
        (1, 1, 1, "Meta", None, 0, 1), (1, 2, 2, None, Decimal(5), 1, 0), (1, 3, 3, "Meta", None, 0, 1), (1, 4, 4, "TikTok", None, 0, 1),
        (2, 1, 5, "TikTok", None, 0, 1), (3, 1, 6, None, Decimal(7), 1, 0),
    ]
    numbered = numbered_touchpoints(spark.createDataFrame(rows, TOUCHES))
    worth = {r["mask"]: r["worth"] for r in coalitions.conversion_worth(numbered).collect()}
    assert len(worth) == 32
    assert [worth[m] for m in (0, 1, 2, 3, 4)] == [0.0, 1.0, 0.0, pytest.approx(1 / 3), 0.0]


@pytest.mark.parametrize("slices", [1, 7])
def test_path_trie_against_plain_prefixes(spark, slices):
    """One customer holds half of the touches, in one journey that never converts."""
    rng = random.Random(9)
    rows, event = [], 0
    for customer in range(30):
        for at in range(100 if customer == 0 else rng.randrange(0, 9)):
            converts = customer and rng.random() < 0.25
            channel = None if converts else rng.choice(["Meta", "TikTok", "Unknown"])
            rows.append((customer, at, event, channel, Decimal(3) if converts else None, int(converts), int(not converts)))
            event += 1
    want = {}
    for customer in range(30):
        path, firsts = (), []
        mine = [r for r in rows if r[0] == customer]

        def close(converted, path, firsts):
            for d in range(1, len(path) + 1):
                node = want.setdefault(path[:d], [[], 0, 0, 0])
                node[0].append(firsts[d - 1])
                node[1] += converted
                node[2] += converted and d == len(path)
                node[3] += not converted and d == len(path)

        for r in mine:
            if r[5]:
                close(1, path, firsts)
                path, firsts = (), []
            else:
                path, firsts = (*path, r[3]), [*firsts, r[2]]
        close(0, path, firsts)
    numbered = numbered_touchpoints(spark.createDataFrame(rows, TOUCHES), slices)
    got = {r["node_id"]: r for r in journeys.path_trie(journeys.journey_prefixes(numbered, slices)).collect()}
    assert len(got) == len(want)
    for path, (events, converted, here, lost) in want.items():
        r = got[min(events)]
        parent = min(want[path[:-1]][0]) if len(path) > 1 else None
        assert (r["parent_id"], r["depth"], r["channel"]) == (parent, len(path), path[-1])
        assert (r["journeys"], r["conversions"], r["converted_here"], r["lost"]) == (len(events), converted, here, lost)
        assert r["revenue"] == 3.0 * converted
