from paidmedia.operators import performance as p


def test_zero_denominators_give_null(make_fact, rows):
    zero = dict(impressions=0, clicks=0, spend_gbp=0, orders=0, new_customers=0,
                returning_customers=0)
    got = rows(p.channel_performance(make_fact(zero)))[0]
    assert got["total_rows"] == 1
    for c in ("blended_ctr_pct", "blended_roas", "blended_cpo_gbp", "blended_cac_gbp"):
        assert got[c] is None
    funnel = rows(p.funnel_by_channel(make_fact(zero)))[0]
    assert funnel["pct_lost_at_click_stage"] is None
    assert funnel["bottleneck_diagnosis"] == "Funnel healthy"


def test_null_roas_comes_first_in_descending_order(make_fact):
    df = p.channel_performance(
        make_fact({"channel": "Meta"}, {"channel": "TikTok", "spend_gbp": 0})
    )
    assert [r["channel"] for r in df.collect()] == ["TikTok", "Meta"]


def test_paid_drops_organic_and_null_channel(make_fact, rows):
    fact = make_fact({}, {"channel": "Organic"}, {"channel": None})
    assert [r["channel"] for r in rows(p.channel_performance(fact))] == ["Meta"]
    assert len(rows(p.channel_totals(fact))) == 3


def test_shares_sum_to_hundred(make_fact, rows):
    fact = make_fact({"spend_gbp": 10}, {"channel": "TikTok", "spend_gbp": 30})
    got = rows(p.channel_share(fact), "channel")
    assert got["Meta"]["spend_share_pct"] == 25.0
    assert got["TikTok"]["spend_share_pct"] == 75.0
    assert sum(r["revenue_share_pct"] for r in got.values()) == 100.0


def test_loyalty_tiers_include_their_lower_bound(make_fact, rows):
    fact = make_fact(
        {"channel": "Meta", "new_customers": 550, "returning_customers": 450},
        {"channel": "TikTok", "new_customers": 700, "returning_customers": 300},
        {"channel": "YouTube", "new_customers": 701, "returning_customers": 299},
        {"channel": "Organic", "new_customers": 100, "returning_customers": 900},
    )
    got = rows(p.repeat_rate_by_channel(fact), "channel")
    assert {c: r["loyalty_tier"] for c, r in got.items()} == {
        "Meta": "High Loyalty",
        "TikTok": "Mid Loyalty",
        "YouTube": "Low Loyalty",
    }


def test_minimum_orders_is_exclusive(make_fact, rows):
    fact = make_fact({"orders": 50}, {"channel": "TikTok", "orders": 51})
    assert [r["channel"] for r in rows(p.repeat_rate_by_campaign(fact))] == ["TikTok"]


def test_funnel_diagnoses(make_fact, rows):
    fact = make_fact(
        {"channel": "Meta", "impressions": 10000, "clicks": 99},
        {"channel": "TikTok", "impressions": 10000, "clicks": 1000, "orders": 9},
        {"channel": "YouTube", "impressions": 10000, "clicks": 100, "orders": 1},
    )
    got = rows(p.funnel_by_channel(fact, details=True), "channel")
    assert got["Meta"]["bottleneck_diagnosis"].startswith("Creative/Targeting weak —")
    assert got["TikTok"]["bottleneck_diagnosis"].startswith("Landing page/product weak —")
    assert got["YouTube"]["bottleneck_diagnosis"] == "Funnel healthy"
    assert got["YouTube"]["order_to_new_customer_pct"] == 400.0


def test_funnel_long_ends_without_next_stage(make_fact, rows):
    got = rows(p.funnel_long(make_fact({})), "stage")
    assert got["impressions"]["next_stage_pct"] == 10.0
    assert got["new_customers"]["next_volume"] is None


def test_kpis_include_unpaid_channels_and_survive_empty_input(make_fact, rows):
    fact = make_fact({}, {"channel": "Organic", "spend_gbp": 0, "revenue_gbp": 100})
    got = rows(p.compute_kpis(fact))[0]
    assert got["blended_roas"] == 4.0
    assert got["repeat_rate"] == 60.0
    empty = rows(p.compute_kpis(fact.limit(0)))[0]
    assert empty == {
        "total_revenue": 0.0,
        "blended_roas": 0.0,
        "avg_cac": 0.0,
        "repeat_rate": 0.0,
        "total_spend": 0.0,
        "total_orders": 0,
    }


def test_mean_of_row_ratios_is_not_the_pooled_ratio(make_fact, rows):
    fact = make_fact(
        {"spend_gbp": 100, "revenue_gbp": 100},
        {"spend_gbp": 300, "revenue_gbp": 900, "new_customers": 0},
        {"spend_gbp": 0, "revenue_gbp": 50},
    )
    report = rows(p.summary_report(fact))[0]
    assert report["Avg_ROAS"] == 2.0
    assert report["Avg_CAC"] == 12.5
    assert rows(p.roas_by_channel(fact))[0]["ROAS"] == 2.5
    # With the row that has no spend, whose ratio counts as 0.
    assert rows(p.final_summary(fact))[0]["Blended_ROAS"] == 1.33


def test_final_summary_text(make_fact, rows):
    fact = make_fact({"spend_gbp": 1234567.89, "revenue_gbp": 2500000.5, "new_customers": 1000})
    got = rows(p.final_summary(fact))[0]
    assert got["Total_Spend_GBP"] == "£1,234,568"
    assert got["Total_Revenue_GBP"] == "£2,500,000"
    assert got["Avg_CAC_GBP"] == "£1234.57"
    assert got["Avg_Repeat_Rate"] == "1.0%"


def test_rounding_is_half_away_from_zero_on_the_printed_value(make_fact, rows):
    fact = make_fact({"spend_gbp": 200, "revenue_gbp": 201, "orders": 1600})
    got = rows(p.channel_performance(fact))[0]
    assert got["blended_roas"] == 1.005
    assert got["blended_cpo_gbp"] == 0.13
    assert rows(p.channel_share(fact))[0]["roas"] == 1.01


def test_result_does_not_depend_on_partitioning(spark):
    from conftest import DATA

    from paidmedia.sources.fact import fact_table

    fact = fact_table(spark, f"{DATA}/sf0.001")
    for operator in (p.summary_report, p.channel_performance, p.compute_kpis):
        whole = operator(fact.coalesce(1)).collect()
        assert operator(fact.repartition(13)).collect() == whole
