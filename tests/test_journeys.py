"""Journeys against a plain Python replay of the event log, also with a hot customer."""

import datetime
import random
from collections import defaultdict
from itertools import combinations
from math import factorial

import pytest

from paidmedia.operators import journeys as j
from paidmedia.sources.touchpoints import EVENT_CHANNELS, numbered_touchpoints, touchpoints

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@pytest.fixture(scope="module")
def log():
    """One customer holds a third of the events; timestamps tie; some events are errors."""
    rng = random.Random(3)
    start = datetime.datetime(2024, 1, 1)
    out = []
    for i in range(1800):
        user = 1 if i % 3 == 0 else rng.randrange(2, 90)
        kind = rng.choice(["view", "click", "signup", "purchase", "error", "view"])
        at = start + datetime.timedelta(minutes=rng.randrange(400))
        out.append((i, at, user, kind, round(rng.random() * 100, 2), f'{{"k": {rng.randrange(99)}}}'))
    rng.shuffle(out)
    return out


def replay(log):
    touches, done, no = defaultdict(list), {}, defaultdict(int)
    for event, at, user, kind, value, props in sorted(log, key=lambda e: (e[2], e[1], e[0])):
        if kind == "error":
            continue
        if kind == "purchase":
            no[user] += 1
            if touches[user]:
                done[event] = (user, no[user], value, touches[user])
            touches[user] = []
        else:
            channel = EVENT_CHANNELS[int(props.split(":")[1].rstrip("}")) % 4]
            touches[user] = touches[user] + [(event, channel)]
    return done


@pytest.fixture(scope="module", params=[1, 9])
def numbered(spark, log, request):
    events = spark.createDataFrame(log, SCHEMA).repartition(3)
    return numbered_touchpoints(touchpoints(events), slices=request.param)


def test_journeys(numbered, log, rows):
    got = {
        r["conversion_id"]: (
            r["customer_id"], r["journey_no"], r["revenue"], r["touches"],
            r["first_channel"], r["last_channel"], r["channel_order"],
        )
        for r in rows(j.journey_report(j.build_journeys(numbered)))
    }
    want = {}
    for event, (user, no, value, touches) in replay(log).items():
        channels = [c for _, c in touches]
        path = " > ".join(dict.fromkeys(channels))
        want[event] = (user, no, value, len(touches), channels[0], channels[-1], path)
    assert got == want


def test_every_touch_is_kept_with_its_position(numbered, log, rows):
    journeys = j.build_journeys(numbered)
    got = {
        (r["conversion_id"], r["position"]): (r["event_id"], r["channel"], r["touches_to_last"])
        for r in rows(j.journey_touches(numbered, journeys))
    }
    want = {}
    for event, (_, _, _, touches) in replay(log).items():
        for i, (touch, channel) in enumerate(touches, 1):
            want[(event, i)] = (touch, channel, len(touches) - i)
    assert got == want


def test_credit_sums_to_revenue_and_equals_enumerated_shapley(numbered, log, rows):
    journeys = j.build_journeys(numbered).cache()
    done = replay(log).values()
    total = sum(v for _, _, v, _ in done)
    credit = rows(j.journey_credit(journeys), "channel")
    assert sum(r["last_click_revenue"] for r in credit.values()) == pytest.approx(total)
    assert sum(r["shapley_revenue"] for r in credit.values()) == pytest.approx(total)

    game = [({c for _, c in t}, v) for _, _, v, t in done]

    def worth(s):
        return sum(v for path, v in game if path <= set(s))

    n = len(EVENT_CHANNELS)
    for channel in EVENT_CHANNELS:
        others = [c for c in EVENT_CHANNELS if c != channel]
        value = sum(
            factorial(k) * factorial(n - k - 1) / factorial(n) * (worth((*s, channel)) - worth(s))
            for k in range(n)
            for s in combinations(others, k)
        )
        assert credit[channel]["shapley_revenue"] == pytest.approx(value)
    exact = rows(j.shapley_exact(journeys), "channel")
    for channel in EVENT_CHANNELS:
        assert exact[channel]["shapley_value"] == pytest.approx(
            credit[channel]["shapley_revenue"], abs=1e-3
        )
    journeys.unpersist()


def test_channels_without_credit_stay(spark, rows):
    at = datetime.datetime(2024, 1, 1)
    log = [
        (1, at, 5, "view", 0.0, '{"k": 0}'),
        (2, at + datetime.timedelta(1), 5, "purchase", 8.0, "{}"),
        (3, at + datetime.timedelta(2), 5, "purchase", 9.0, "{}"),  # no touch: no journey
        (4, at + datetime.timedelta(3), 5, "view", 0.0, '{"k": 1}'),  # no conversion
    ]
    journeys = j.build_journeys(numbered_touchpoints(touchpoints(spark.createDataFrame(log, SCHEMA))))
    got = rows(j.journey_credit(journeys), "channel")
    assert got["Meta"]["last_click_revenue"] == 8.0
    assert got["TikTok"]["journeys"] == 0
    assert got["TikTok"]["delta_pct"] is None
    assert [r["channel_order"] for r in rows(j.channel_order_frequency(journeys))] == ["Meta"]
    assert [r["weight"] for r in rows(j.equal_split_weights(journeys))] == [1.0]


def test_whole_paths(numbered, log, rows):
    """Repeated touches and their order tell paths apart."""
    journeys = j.build_journeys(numbered)
    touches = j.journey_touches(numbered, journeys)
    want = defaultdict(list)
    for event, (_, _, value, steps) in replay(log).items():
        want[tuple(c for _, c in steps)].append((event, value))
    got = rows(j.path_frequency(journeys, touches), "example_conversion_id")
    assert {min(e for e, _ in v) for v in want.values()} == set(got)
    steps = defaultdict(dict)
    for r in rows(j.path_steps(journeys, touches)):
        steps[r["example_conversion_id"]][r["position"]] = r["channel"]
    for path, members in want.items():
        r = got[min(e for e, _ in members)]
        assert (r["journeys"], r["touches"]) == (len(members), len(path))
        assert (r["first_channel"], r["last_channel"]) == (path[0], path[-1])
        assert r["revenue"] == pytest.approx(sum(v for _, v in members))
        assert tuple(c for _, c in sorted(steps[r["example_conversion_id"]].items())) == path


@pytest.mark.parametrize("codegen", ["CODEGEN_ONLY", "NO_CODEGEN"])
@pytest.mark.parametrize("props", ["not json", "{}", None, '{"k": "x"}', '{"k": 99999999999}'])
def test_unreadable_props_leave_the_channel_unknown(spark, rows, props, codegen, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    log = [
        (1, at, 5, "view", 0.0, '{"k": 2}'),
        (2, at + datetime.timedelta(1), 5, "view", 0.0, props),
        (3, at + datetime.timedelta(2), 5, "purchase", 8.0, "{}"),
        (4, at, None, "view", 0.0, '{"k": 1}'),
        (5, at + datetime.timedelta(1), None, "purchase", 9.0, "{}"),
    ]
    path = str(tmp_path / "events")
    spark.createDataFrame(log, SCHEMA).write.parquet(path)
    spark.conf.set("spark.sql.codegen.factoryMode", codegen)
    spark.conf.set("spark.sql.codegen.wholeStage", codegen == "CODEGEN_ONLY")
    try:
        numbered = numbered_touchpoints(touchpoints(spark.read.parquet(path)))
        journeys = j.build_journeys(numbered)
        got = rows(j.journey_report(journeys))
        # Events without a customer are nobody's journey.
        assert [r["conversion_id"] for r in got] == [3]
        assert got[0]["touches"] == 2
        assert (got[0]["channel_order"], got[0]["last_channel"]) == ("YouTube > Unknown", "Unknown")
        credit = rows(j.journey_credit(journeys), "channel")
        assert credit["Unknown"]["last_click_revenue"] == 8.0
        assert sum(r["shapley_revenue"] for r in credit.values()) == pytest.approx(8.0)
        assert [r["channel"] for r in rows(j.journey_touches(numbered, journeys))] is not None
    finally:
        spark.conf.unset("spark.sql.codegen.factoryMode")
        spark.conf.unset("spark.sql.codegen.wholeStage")
