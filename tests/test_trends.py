import datetime

from paidmedia.operators import cohorts, trends


def month(m, day=1, **kw):
    return {"date": f"2022-{m:02d}-{day:02d}", **kw}


def test_rank_ties_share_a_rank_and_may_exceed_three_rows(make_fact, rows):
    fact = make_fact(
        month(1, channel="Meta", new_customers=9),
        month(1, channel="TikTok", new_customers=5),
        month(1, channel="YouTube", new_customers=3),
        month(1, channel="Google_Search", new_customers=3),
    )
    got = rows(trends.top_channels_monthly(fact), "channel")
    assert {c: r["rank_in_month"] for c, r in got.items()} == {
        "Meta": 1, "TikTok": 2, "YouTube": 3, "Google_Search": 3,
    }
    assert got["Meta"]["top_channel_flag"] == "TOP CHANNEL"
    assert got["TikTok"]["top_channel_flag"] == ""


def test_streaks_follow_the_calendar(make_fact, rows):
    wins = [1, 2, 3, 5, 6, 7, 8]
    fact = make_fact(
        *[month(m, channel="Meta", new_customers=9) for m in wins],
        *[month(m, channel="TikTok", new_customers=5) for m in range(1, 9)],
    )
    got = rows(trends.rank1_streaks(fact))
    assert [(r["streak_start"].month, r["streak_end"].month, r["months"]) for r in got] == [
        (1, 3, 3), (5, 8, 4),
    ]


def test_cac_flags_are_strict_and_lag_skips_missing_months(make_fact, rows):
    def cac(m, value, channel="Meta"):
        return month(m, channel=channel, spend_gbp=value, new_customers=1)

    fact = make_fact(
        cac(1, 100), cac(2, 120), cac(4, 102), cac(5, 122.41), cac(6, 104.04), cac(7, 50),
        cac(1, "10.05", "TikTok"), cac(2, "12.06", "TikTok"),
    )
    got = rows(trends.cac_monthly_trend(fact, details=True), "channel", "month_start")
    flag = {k[1].month: r["cac_flag"] for k, r in got.items() if k[0] == "Meta"}
    assert flag[1] == "Normal"
    assert flag[2] == "Normal"  # exactly +20%
    assert flag[4] == "Normal"  # exactly -15%, against February
    assert flag[5] == "ALERT: CAC spike >20%"
    assert flag[6] == "POSITIVE: CAC fell >15%"
    assert flag[7] == "POSITIVE: CAC fell >15%"
    # 12.06 over 10.05 is exactly +20%, whatever its binary image.
    assert got[("TikTok", datetime.date(2022, 2, 1))]["cac_flag"] == "Normal"
    april = got[("Meta", datetime.date(2022, 4, 1))]
    assert april["prev_month_cac"] == 120.0
    assert april["prev_month_new_customers"] == 1


def test_cac_leaves_out_rows_without_new_customers(make_fact, rows):
    fact = make_fact(month(1, spend_gbp=40, new_customers=4), month(1, spend_gbp=99, new_customers=0))
    assert rows(trends.cac_monthly_trend(fact))[0]["cac_gbp"] == 10.0


def test_rolling_mean_covers_three_rows(make_fact, rows):
    fact = make_fact(*[month(m, spend_gbp=v, new_customers=1) for m, v in
                       ((1, 10), (2, 20), (3, 60), (6, 70))])
    got = rows(trends.cac_rolling_3m(fact), "month_start")
    assert [r["rolling_3m_avg_cac"] for r in got.values()] == [10.0, 15.0, 30.0, 50.0]


def test_yoy_bands_are_strict(make_fact, rows):
    def year(y, revenue, channel="Meta"):
        return {"date": f"{y}-06-01", "channel": channel, "revenue_gbp": revenue}

    fact = make_fact(year(2020, 200), year(2021, 210), year(2022, 199.5), year(2023, 300),
                     year(2025, 150), year(2021, 210, "TikTok"))
    got = rows(trends.roas_yoy(fact), "channel", "year")
    trend = {k[1]: r["roas_trend"] for k, r in got.items() if k[0] == "Meta"}
    assert trend == {2020: "Baseline Year", 2021: "Stable", 2022: "Stable",
                     2023: "Improving (+)", 2025: "Declining (-)"}
    assert got[("Meta", 2025)]["prev_year_roas"] == 3.0
    assert got[("Meta", 2021)]["roas_rank_in_year"] == got[("TikTok", 2021)]["roas_rank_in_year"] == 1


def test_weeks_pair_calendar_year_with_iso_week(make_fact, rows):
    fact = make_fact({"date": "2022-01-01"}, {"date": "2024-12-30"}, {"date": "2022-03-01"})
    labels = {r["week_label"] for r in rows(trends.weekly_revenue(fact))}
    assert labels == {"2022-W52", "2024-W01", "2022-W09"}


def test_seasonal_lift(make_fact, rows):
    fact = make_fact(
        {"date": "2022-03-01", "revenue_gbp": 100},
        {"date": "2022-09-14", "revenue_gbp": 700},
        {"date": "2022-12-14", "revenue_gbp": 150},
    )
    got = rows(trends.seasonal_lift(fact))[0]
    assert got["peak_lift_pct"] == 50.0
    assert got["launch_weekly_revenue"] == 700.0


def test_monthly_revenue_is_labelled_by_month_end(make_fact, rows):
    got = rows(trends.monthly_revenue(make_fact({"date": "2024-02-03"})))[0]
    assert got["date"] == datetime.date(2024, 2, 29)
    assert got["month"] == "2024-02"


def test_cohorts_look_three_calendar_months_ahead_and_are_cut_at_the_end(make_fact, rows):
    fact = make_fact(
        *[month(m, revenue_gbp=10 ** (m - 1), new_customers=2, spend_gbp=4) for m in range(1, 7)],
        month(6, day=9, revenue_gbp=7, new_customers=0),
    )
    got = rows(cohorts.ltv_cohort_90d(fact), "cohort_month")
    value = {k.month: r["revenue_90d_gbp"] for k, r in got.items()}
    assert value == {1: 1110.0, 2: 11100.0, 3: 111007.0, 4: 110007.0, 5: 100007.0, 6: 0.0}
    june = got[datetime.date(2022, 6, 1)]
    assert june["returning_90d"] == 0
    assert june["ltv_cac_ratio"] == 0.0


def test_cohort_needs_new_customers_but_its_revenue_does_not(make_fact, rows):
    fact = make_fact(month(1, new_customers=1), month(2, new_customers=0, revenue_gbp=55))
    got = rows(cohorts.ltv_cohort_90d(fact))
    assert len(got) == 1
    assert got[0]["revenue_90d_gbp"] == 55.0


def test_customer_cohorts(spark, rows):
    def order(key, customer, date, priority, price):
        return key, customer, datetime.datetime.fromisoformat(date), priority, price

    orders = spark.createDataFrame(
        [
            order(2, 1, "2000-01-10", "2-HIGH", 10.0),
            order(1, 1, "2000-01-10", "3-MEDIUM", 20.0),  # same day, lower key: first
            order(3, 1, "2000-04-09", "5-LOW", 5.0),  # day 90
            order(4, 1, "2000-04-10", "5-LOW", 99.0),  # day 91
            order(5, 2, "2000-01-31", "3-MEDIUM", 7.0),
        ],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string, "
        "o_totalprice double",
    )
    got = rows(cohorts.customer_ltv_90d(orders))
    assert got == [
        {
            "cohort_month": datetime.date(2000, 1, 1),
            "channel": "TikTok",
            "customers": 2,
            "repeat_customers": 1,
            "orders_90d": 1,
            "revenue_90d_gbp": 5.0,
            "ltv_90d_per_customer": 2.5,
            "repeat_rate_90d_pct": 50.0,
        }
    ]


def test_orders_without_a_customer_are_no_cohort(spark, rows):
    """Three of them, on three days, would look like one loyal customer."""
    day = datetime.datetime
    orders = spark.createDataFrame(
        [(i, None, day(2000, 1, i), "3-MEDIUM", 5.0) for i in (1, 2, 3)]
        + [(4, 7, day(2000, 1, 4), "3-MEDIUM", 5.0), (5, 7, day(2000, 2, 4), "5-LOW", 6.0)],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_totalprice double",
    )
    (got,) = rows(cohorts.customer_ltv_90d(orders))
    assert (got["customers"], got["repeat_customers"], got["revenue_90d_gbp"]) == (1, 1, 6.0)
