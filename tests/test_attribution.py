from itertools import permutations

import pytest

from paidmedia.operators import attribution as a
from paidmedia.operators import enrich
from paidmedia.sources import dimensions, schema


@pytest.fixture
def fact(make_fact):
    return make_fact(
        {"channel": "Meta", "revenue_gbp": 300},
        {"channel": "Meta", "date": "2022-02-01", "revenue_gbp": 100},
        {"channel": "TikTok", "revenue_gbp": 200},
        {"channel": "YouTube", "revenue_gbp": 0},
        {"channel": "Google_Search", "revenue_gbp": 400},
        {"channel": "Organic", "revenue_gbp": 5000, "spend_gbp": 0},
        {"channel": None, "revenue_gbp": 70},
    )


def test_template_shares_known_by_hand(spark, rows):
    got = rows(a.journey_shares(dimensions.journey_templates(spark)), "channel")
    lc = {c: r["lastclick_share"] for c, r in got.items()}
    sv = {c: r["shapley_share"] for c, r in got.items()}
    assert lc == pytest.approx({"Google_Search": 0.82, "Meta": 0.18, "TikTok": 0, "YouTube": 0})
    assert sv == pytest.approx(
        {"Meta": 0.363333333333, "TikTok": 0.153333333333, "YouTube": 0.1,
         "Google_Search": 0.383333333333}
    )


def test_equal_split_is_the_shapley_value_of_the_templates(spark, rows):
    """Average marginal contribution over all orders of the four channels."""
    game = [(set(path), float(share)) for path, share in dimensions.JOURNEY_TEMPLATES]

    def worth(s):
        return sum(share for path, share in game if path <= s)

    value = dict.fromkeys(schema.PAID_CHANNELS, 0.0)
    orders = list(permutations(schema.PAID_CHANNELS))
    for order in orders:
        for i, c in enumerate(order):
            value[c] += (worth(set(order[: i + 1])) - worth(set(order[:i]))) / len(orders)
    got = rows(a.journey_shares(dimensions.journey_templates(spark)), "channel")
    assert {c: r["shapley_share"] for c, r in got.items()} == pytest.approx(value)


def test_equal_split_of_single_journeys(spark, rows):
    journeys = dimensions.journey_templates(
        spark, [(["Meta", "Meta", "TikTok"], "0.5"), (["YouTube"], "0.5")]
    )
    got = rows(a.equal_split(journeys), "journey_id", "channel")
    assert {k: r["weight"] for k, r in got.items()} == {
        (1, "Meta"): 0.5, (1, "TikTok"): 0.5, (2, "YouTube"): 1.0,
    }


def test_credits_sum_to_total_revenue(fact, rows):
    got = rows(a.journey_credits(fact), "channel")
    assert sum(r["lastclick_credit"] for r in got.values()) == pytest.approx(1000)
    assert sum(r["shapley_credit"] for r in got.values()) == pytest.approx(1000)
    assert got["YouTube"]["shapley_credit"] == pytest.approx(100)
    summary = rows(a.attribution_summary(fact), "channel")
    assert summary["TikTok"]["delta_pct"] == float("inf")
    assert summary["Google_Search"]["delta_pct"] == pytest.approx((383.33333 - 820) / 820 * 100)


def test_shares_are_rescaled_when_templates_do_not_sum_to_one(fact, spark, rows):
    journeys = dimensions.journey_templates(spark, [(["Meta"], "0.2"), (["TikTok", "Radio"], "0.2")])
    got = rows(a.journey_credits(fact, journeys), "channel")
    assert got["Meta"]["lastclick_credit"] == pytest.approx(1000)
    assert got["Meta"]["shapley_credit"] == pytest.approx(1000 * 0.2 / 0.3)


def test_row_attribution_sums_back_to_credits_with_revenue(fact, rows):
    credits = a.journey_credits(fact)
    attributed = rows(a.row_attribution(fact, credits))
    assert len(attributed) == 7
    by_channel = {}
    for r in attributed:
        by_channel[r["channel"]] = by_channel.get(r["channel"], 0) + r["revenue_shapley"]
    for c, r in rows(credits, "channel").items():
        # YouTube has a credit but no revenue to carry it.
        want = 0 if c == "YouTube" else r["shapley_credit"]
        assert by_channel[c] == pytest.approx(want)
    assert by_channel["Organic"] == by_channel[None] == 0.0
    assert all(
        r["shapley_vs_lc_delta_pct"] == 0 for r in attributed if r["revenue_lastclick"] == 0
    )


def test_weights_form_always_has_four_rows(make_fact, rows):
    got = rows(a.attribution_by_weights(make_fact({"channel": "Meta", "revenue_gbp": 100})), "channel")
    assert set(got) == set(schema.PAID_CHANNELS)
    assert got["Meta"]["last_click_revenue"] == pytest.approx(100)
    assert got["TikTok"]["shapley_revenue"] == pytest.approx(27.3)
    assert got["Google_Search"]["delta_pct"] == float("inf")
    shown = rows(a.delta_display(a.attribution_by_weights(make_fact({"channel": "Meta"}))), "channel")
    assert shown["TikTok"]["delta_label"] == "+inf%"
    assert shown["TikTok"]["delta_display"] == 500.0
    assert shown["Meta"]["delta_label"] == "-64%"
    assert not shown["Meta"]["gains_credit"]


def test_weights_form_of_nothing(make_fact, rows):
    got = rows(a.attribution_by_weights(make_fact({}).limit(0)))
    assert [r["last_click_revenue"] for r in got] == [0.0] * 4


def test_compare_labels_channels_without_last_click(fact, rows):
    compared = rows(a.attribution_compare(a.row_attribution(fact, a.journey_credits(fact))), "channel")
    assert compared["TikTok"]["delta_pct"] is None
    assert compared["TikTok"]["delta_label"] == "Last-Click = £0\n(fully undervalued)"
    assert compared["Meta"]["delta_label"] == "+102%"


def test_own_revenue_biases(make_fact, rows):
    fact = make_fact(
        {"channel": "Meta", "revenue_gbp": 100},
        {"channel": "Radio", "revenue_gbp": 100},
        {"channel": "TikTok", "revenue_gbp": 10},
        {"channel": "TikTok", "revenue_gbp": 990, "spend_gbp": 0},
        {"channel": "YouTube", "revenue_gbp": 10, "spend_gbp": 0},
    )
    got = rows(a.attribution_own_revenue(fact, details=True), "channel")
    assert set(got) == {"Meta", "Radio", "TikTok"}
    assert got["Meta"]["attribution_bias"] == "OVERVALUED by Last-Click"
    assert got["Radio"]["attribution_bias"] == "Neutral"
    assert got["TikTok"]["attribution_bias"] == "UNDERVALUED by Last-Click"
    assert got["TikTok"]["delta_gbp"] == 263.0
    assert got["TikTok"]["active_days"] == 1


def test_enriched_table_has_26_columns_and_zero_policies(make_fact, rows):
    fact = make_fact({"impressions": 0, "clicks": 0, "orders": 0, "new_customers": 0,
                      "returning_customers": 0, "spend_gbp": 0, "revenue_gbp": 10})
    table = enrich.enrich(fact)
    assert table.schema.fieldNames() == schema.ENRICHED.fieldNames()
    assert len(table.columns) == 26
    got = rows(table)[0]
    for c in ("CTR", "CPC", "CPO", "ROAS", "CAC", "Repeat_Rate"):
        assert got[c] == 0.0
    assert got["Contribution_Margin_Proxy"] == 4.5
    assert (got["year"], got["month"], got["quarter"], got["week_number"]) == (2022, 1, 1, 1)


def test_a_channel_with_two_credits_does_not_multiply_rows(spark, make_fact):
    credits = spark.createDataFrame(
        [("Meta", 300.0, 100.0, 50.0), ("Meta", 300.0, 20.0, 25.0)],
        "channel string, channel_revenue double, lastclick_credit double, shapley_credit double",
    )
    from paidmedia.operators import attribution

    got = attribution.row_attribution(make_fact({}, {"channel": "TikTok"}), credits).collect()
    assert sorted((r["channel"], r["revenue_lastclick"], r["revenue_shapley"]) for r in got) == [
        ("Meta", 120.0, 75.0), ("TikTok", 0.0, 0.0),
    ]
