import datetime
from collections import defaultdict
from decimal import Decimal

import pytest
from conftest import DATA, plan_of

from paidmedia import jobs
from paidmedia.operators import enrich, profile
from paidmedia.plans import catalog
from paidmedia.sources import dimensions, fact, files, schema, store


def test_fact_against_a_plain_replay_with_hot_keys(spark, rows):
    """One order, one part and one customer each hold a third of the rows."""
    day = datetime.datetime(1996, 5, 1)
    orders, lines = [], []
    for k in range(60):
        customer = 1 if k % 3 == 0 else k
        date = day + datetime.timedelta(days=k % 4)
        orders.append((k, customer, date, ["2-HIGH", "3-MEDIUM", "5-LOW"][k % 2 + (k == 7)]))
    for i in range(600):
        order = 3 if i % 3 == 0 else i % 60
        part = 9 if i % 3 == 1 else i % 5
        lines.append((order, part, float(i % 7 + 1), i * 1.25 + 1, (i % 11) / 100, "ANR"[i % 3]))
    parts = [(0, "PROMO"), (1, "STANDARD"), (2, "ECONOMY"), (3, None), (4, "SMALL"), (9, "PROMO")]
    frames = (
        spark.createDataFrame(
            orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"
        ),
        spark.createDataFrame(
            lines,
            "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, "
            "l_discount double, l_returnflag string",
        ),
        spark.createDataFrame(parts, "p_partkey long, p_type string"),
    )
    got = rows(fact.build_fact(*frames), *schema.GRAIN)

    first = {}
    for _, customer, date, priority in orders:
        key = customer, fact.CHANNEL_OF_PRIORITY[priority]
        first[key] = min(first.get(key, date), date)
    cells = defaultdict(lambda: {"orders": set(), "new": set(), "old": set(), "qty": 0,
                                 "revenue": Decimal(0)})
    by_key, types = {o[0]: o for o in orders}, dict(parts)
    for order, part, qty, price, disc, flag in lines:
        _, customer, date, priority = by_key[order]
        channel = fact.CHANNEL_OF_PRIORITY[priority]
        cell = cells[(date.date(), channel, fact.CAMPAIGN_OF_FLAG[flag],
                      fact.CREATIVE_OF_TYPE.get(types[part], fact.OTHER_CREATIVE))]
        cell["orders"].add(order)
        cell["new" if date == first[(customer, channel)] else "old"].add(customer)
        cell["qty"] += int(qty)
        cell["revenue"] += Decimal(str(price)) * (1 - Decimal(str(round(disc, 2))))
    assert set(got) == set(cells)
    for key, cell in cells.items():
        r = got[key]
        assert r["orders"] == len(cell["orders"])
        assert r["new_customers"] == len(cell["new"])
        assert r["returning_customers"] == len(cell["old"])
        assert r["impressions"] == cell["qty"] * 125
        # price has two digits in the raw table; the fixture has quarters only
        assert abs(r["revenue_gbp"] - cell["revenue"]) < Decimal("0.01")


def fact_inputs(spark, orders, lines, parts):
    return (
        spark.createDataFrame(
            orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"
        ),
        spark.createDataFrame(
            lines,
            "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, "
            "l_discount double, l_returnflag string",
        ),
        spark.createDataFrame(parts, "p_partkey long, p_type string"),
    )


def test_fact_counts_customers_with_several_orders_a_day_once(spark):
    """Orders of one customer on one day, 64 days apart, twice in the table, without key or customer."""
    day = datetime.datetime(1996, 5, 1)
    dates = [day + datetime.timedelta(days=d) for d in (0, 1, 64, 65, 128)] + [None]
    orders = [
        (k if k % 17 else None, k % 5 or None, dates[k % 6], ["2-HIGH", "5-LOW", None][k // 30 % 3])
        for k in range(90)
    ]
    orders += orders[3:9] + [(4, 1, dates[1], "2-HIGH")]
    lines = [(i % 83 or None, i % 4 or None, 2.0, 10.5, 0.04, "ANRX"[i // 83 % 4]) for i in range(500)]
    parts = [(1, "PROMO"), (2, "STANDARD"), (3, None), (3, None), (None, "PROMO")]
    frames = fact_inputs(spark, orders, lines, parts)

    first, cells = {}, defaultdict(lambda: [0, set(), set()])
    for _, customer, date, priority in orders:
        if customer is not None and date is not None:
            key = customer, priority
            first[key] = min(first.get(key, date), date)
    met = {
        (n, order[0], order[1:], fact.CAMPAIGN_OF_FLAG.get(line[5]), fact.CREATIVE_OF_TYPE.get(kind, fact.OTHER_CREATIVE))
        for n, order in enumerate(orders) for line in lines for part, kind in parts
        if None not in (order[0], part) and line[:2] == (order[0], part)
    }
    for _, _, (customer, date, priority), campaign, creative in met:
        cell = cells[date and date.date(), fact.CHANNEL_OF_PRIORITY.get(priority), campaign, creative]
        cell[0] += 1
        if customer is not None and date is not None:
            cell[2 if date > first[customer, priority] else 1].add(customer)
    got = {
        tuple(r[c] for c in schema.GRAIN): (r["orders"], r["new_customers"], r["returning_customers"])
        for r in fact.build_fact(*frames).collect()
    }
    assert got == {k: (n, len(new), len(old)) for k, (n, new, old) in cells.items()}


def test_lines_are_shuffled_by_order_once_and_shrink_to_the_grain(spark):
    """Before, order cells were shuffled by cell, by order and by customer."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [fact.raw(spark, f"{DATA}/sf0.001", t) for t in ("orders", "lineitem", "part")]
        plan = plan_of(fact.build_fact(*frames))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Arguments: hashpartitioning(l_orderkey") == 1


@pytest.mark.parametrize(
    "sf, expected",
    [
        ("0.001", (4772, 19032125, 542467, "92361987.78", "301270840.59", 4879, 2138, 2741)),
        ("0.01", (40158, 190516875, 5451646, "921210073.23", "3024008731.30", 48648, 20895, 27734)),
    ],
)
def test_fact_checksums(spark, sf, expected):
    from pyspark.sql import functions as F

    measures = ["impressions", "clicks", "spend_gbp", "revenue_gbp", "orders", "new_customers",
                "returning_customers"]
    got = fact.fact_table(spark, f"{DATA}/sf{sf}").agg(
        F.count("*"), *[F.sum(m) for m in measures]
    ).first()
    assert [str(v) for v in got] == [str(v) for v in expected]


def test_grain_is_unique(spark):
    table = fact.fact_table(spark, f"{DATA}/sf0.01")
    assert table.select(*schema.GRAIN).distinct().count() == table.count()


def test_filters_reach_the_scan(spark):
    table = files.apply_filters(fact.fact_table(spark, f"{DATA}/sf0.01"), **catalog.FILTER)
    plan = plan_of(table.groupBy("channel").sum("clicks"))
    assert "GreaterThanOrEqual(date" in plan and "In(channel" in plan
    assert "ReadSchema: struct<date:date,channel:string,campaign_type:string" in plan
    assert "revenue_gbp" not in plan


def test_filter_needs_a_choice(make_fact):
    with pytest.raises(ValueError):
        files.apply_filters(make_fact({}), "2022-01-01", "2022-02-01", [], ["x"], ["y"])


def test_filter_bounds_are_inclusive(make_fact):
    table = make_fact(*[{"date": f"2022-01-0{d}"} for d in (1, 2, 3, 4)])
    got = files.apply_filters(table, "2022-01-02", "2022-01-03", ["Meta"], ["Prospecting"],
                              ["UGC_Review"])
    assert got.count() == 2


def test_enriched_round_trip_prunes_partitions(spark, make_fact, tmp_path):
    table = enrich.enrich(make_fact(*[{"date": f"2022-{m:02d}-05"} for m in range(1, 13)]))
    files.write_enriched(table, str(tmp_path / "out"))
    back = files.load_enriched(spark, str(tmp_path / "out"))
    assert back.schema == schema.ENRICHED
    assert sorted(back.collect()) == sorted(table.collect())
    plan = plan_of(back.filter("year = 2022 AND month = 3"))
    assert "PartitionFilters: [isnotnull(year" in plan


def test_batch_jobs(spark, make_fact, tmp_path):
    raw = make_fact({}, {"channel": "TikTok"}, {"channel": "Organic", "spend_gbp": 0})
    files.write_csv(raw, str(tmp_path / "raw"))
    jobs.run_enrich(spark, str(tmp_path / "raw"), str(tmp_path / "clean"))
    jobs.run_enrich(spark, str(tmp_path / "raw"), str(tmp_path / "clean-csv"), "csv")
    want = sorted(enrich.enrich(raw).collect(), key=str)
    assert sorted(files.load_enriched(spark, str(tmp_path / "clean")).collect(), key=str) == want
    csv = files.load_csv(spark, str(tmp_path / "clean-csv"), schema.ENRICHED)
    assert sorted(csv.collect(), key=str) == want
    jobs.run_summary(spark, str(tmp_path / "clean"), str(tmp_path / "summary"))
    assert spark.read.option("header", True).csv(str(tmp_path / "summary")).count() == 2
    jobs.run_summary(spark, str(tmp_path / "clean-csv"), str(tmp_path / "summary-csv"), "csv")
    both = [sorted(spark.read.csv(str(tmp_path / d)).collect()) for d in ("summary", "summary-csv")]
    assert both[0] == both[1]


def test_bad_csv_fails_instead_of_losing_rows(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(",".join(schema.FACT.fieldNames()) + "\n2022-01-01,Meta,a,b,many,1,1,1,1,1,1,1\n")
    with pytest.raises(Exception):
        files.load_csv(spark, str(path)).collect()


def test_csv_columns_are_read_by_name(spark, make_fact, tmp_path):
    table = make_fact({"spend_gbp": 7, "revenue_gbp": 9}, {"channel": "TikTok"})
    names = list(reversed(table.columns))
    files.write_csv(table.withColumn("more", table["channel"]).select("more", *names), str(tmp_path / "a"))
    assert sorted(files.load_csv(spark, str(tmp_path / "a")).collect()) == sorted(table.collect())
    files.write_csv(table.drop("orders"), str(tmp_path / "b"))
    with pytest.raises(ValueError, match="orders"):
        files.load_csv(spark, str(tmp_path / "b"))


def test_csv_files_with_different_headers_fail(spark, make_fact, tmp_path):
    table = make_fact({"spend_gbp": 7, "revenue_gbp": 9})
    for i, names in enumerate((table.columns, list(reversed(table.columns)))):
        files.write_csv(table.select(*names).coalesce(1), str(tmp_path / "c"), mode="append")
    with pytest.raises(Exception):
        files.load_csv(spark, str(tmp_path / "c")).collect()


def test_orders_without_customer_or_known_priority_keep_their_revenue(spark, rows):
    day = datetime.datetime(1996, 5, 1)
    orders = [
        (1, None, day, "2-HIGH"), (2, None, day + datetime.timedelta(1), "2-HIGH"), (3, 7, day, "9-NEW"),
        (4, 7, day + datetime.timedelta(1), "9-NEW"), (5, 8, day, None),
    ]
    lines = [(k, 1, 1.0, 10.0, 0.0, "A") for k in range(1, 6)]
    got = rows(fact.build_fact(
        spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, "
                                     "l_discount double, l_returnflag string"),
        spark.createDataFrame([(1, "PROMO")], "p_partkey long, p_type string"),
    ))
    assert sum(r["orders"] for r in got) == 5
    assert sum(r["revenue_gbp"] for r in got) == Decimal("50.00")
    named = [r for r in got if r["channel"] == "Meta"]
    assert [(r["new_customers"], r["returning_customers"]) for r in named] == [(0, 0), (0, 0)]
    other = {r["date"]: r for r in got if r["channel"] is None}
    assert {(r["orders"], r["new_customers"], r["returning_customers"]) for r in other.values()} == {(2, 2, 0), (1, 0, 1)}


def test_shared_folder_comes_from_the_session(spark):
    assert store.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert store.new_path(spark, "x") != store.new_path(spark, "x")


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://somewhere:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        store.shared_folder(Session())


def test_derived_table_is_built_once_until_its_files_change(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(5).write.parquet(folder)
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(folder)

    def count():
        return store.derived(spark, "test:once", [folder], build).count()

    assert [count() for _ in range(3)] == [5, 5, 5]
    assert built == [1]
    spark.range(2).write.mode("append").parquet(folder)
    assert [count(), count()] == [7, 7]
    store.refresh(spark, "test:once")
    assert count() == 7
    assert len(built) == 3


def test_the_state_of_a_table_does_not_grow_with_its_files(spark, tmp_path):
    folder = str(tmp_path / "many")
    spark.range(40).repartition(20).write.parquet(folder)
    before = store.file_state(spark, [folder])
    assert len(before) == 1
    assert store.file_state(spark, [folder]) == before
    next(p for p in (tmp_path / "many").iterdir() if p.suffix == ".parquet").unlink()
    assert store.file_state(spark, [folder]) != before


def test_nothing_is_left_after_the_session(tmp_path):
    """A session of its own process: its folder is gone when it ends."""
    import os
    import subprocess
    import sys

    code = (
        "from pyspark.sql import SparkSession\n"
        "from paidmedia.sources import store\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', '{tmp_path}/shared').getOrCreate()\n"
        "assert store.materialise(s.range(3), 'x').count() == 3\n"
        "import glob\n"
        f"assert glob.glob('{tmp_path}/shared/paidmedia/*/x-*/part-*')\n"
        "s.stop()\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYTHONPATH": root}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    subprocess.run([sys.executable, "-c", code], env=env, check=True, timeout=120, cwd=tmp_path)
    import time

    for _ in range(50):
        if not list((tmp_path / "shared" / "paidmedia").glob("*")):
            break
        time.sleep(0.2)
    assert not list((tmp_path / "shared" / "paidmedia").glob("*"))


def test_fact_view_serves_sql(spark):
    fact.register_fact_view(spark, f"{DATA}/sf0.001")
    got = spark.sql("SELECT count(*) FROM marketing_performance WHERE channel <> 'Organic'").first()[0]
    assert 0 < got < 4772


def test_inline_quotes_text(spark):
    got = dimensions.inline(spark, "channel string; x int", [("O'Neil\\", 3)]).first()
    assert (got["channel"], got["x"]) == ("O'Neil\\", 3)


def test_profile_counts_missing_values(make_fact, rows):
    got = rows(profile.profile(make_fact({}, {"channel": None})), "column_name")
    assert got["channel"]["null_count"] == 1
    assert got["date"]["null_count"] == 0
    assert got["spend_gbp"]["data_type"] == "decimal(18,2)"
    assert {r["row_count"] for r in got.values()} == {2}


def test_describe_is_exact_and_sliced_alike(make_fact, rows):
    table = enrich.add_row_metrics(make_fact(*[{"spend_gbp": v} for v in (1, 2, 3, 10)]))
    got = rows(profile.describe_metrics(table), "metric")
    assert got["spend_gbp"] == {
        "metric": "spend_gbp", "count": 4, "mean": 4.0, "std": 4.082, "min": 1.0,
        "p25": 1.75, "p50": 2.5, "p75": 4.75, "max": 10.0,
    }
    assert rows(profile.describe_metrics(table, slices=3), "metric") == got


@pytest.mark.parametrize("name", ["channel_performance", "compute_kpis", "channel_pairs",
                                  "attribution_by_weights", "describe_metrics", "roas_yoy"])
def test_queries_survive_an_empty_fact(spark, make_fact, name, monkeypatch):
    empty = make_fact({}).limit(0)
    monkeypatch.setattr(catalog, "fact_table", lambda s, f: empty)
    catalog.queries()[name](spark, "unused").collect()
