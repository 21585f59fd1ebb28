"""The sliced form of ordered computations equals the plain one and brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paidmedia.functions import scans

ONE, SLICED = {"slices": 1}, {"slices": 7}


@pytest.fixture(scope="module")
def data(spark):
    """One key holds a third of the rows, values tie often, one key is NULL."""
    rng = random.Random(7)
    keys = ["hot"] * 400 + [f"k{i % 40}" for i in range(700)] + [None] * 100
    return [(k, rng.randrange(30), i, rng.randrange(5)) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "k string, v int, id long, x long").repartition(5)


@pytest.mark.parametrize("how", [ONE, SLICED], ids=["one slice", "sliced"])
def test_running_totals(frame, data, how):
    got = {
        r["id"]: (r["sx"], r["sid"])
        for r in scans.running_totals(
            frame, ["k"], ["v", "id"], {"sx": "x", "sid": "id"}, **how
        ).collect()
    }
    want, sums = {}, defaultdict(lambda: [0, 0])
    for k, v, i, x in sorted(data, key=lambda r: (str(r[0]), r[1], r[2])):
        sums[k][0] += x
        sums[k][1] += i
        want[i] = tuple(sums[k])
    assert got == want


@pytest.mark.parametrize("how", [ONE, SLICED], ids=["one slice", "sliced"])
@pytest.mark.parametrize("buckets", [4, 7, 64])
def test_bucketed(frame, data, how, buckets):
    got = {
        r["id"]: r["b"]
        for r in scans.bucketed(frame, buckets, ["k"], ["v", "id"], "b", **how).collect()
    }
    groups = defaultdict(list)
    for k, v, i, x in data:
        groups[k].append((v, i))
    want = {}
    for members in groups.values():
        for b, part in enumerate(np.array_split(sorted(members), buckets), 1):
            want.update({int(i): b for _, i in part})
    assert got == want


def test_running_totals_of_null_values_are_those_of_a_window(spark):
    """A sum is NULL until the first value and keeps its value over NULLs."""
    from pyspark.sql import Window

    rng = random.Random(1)
    rows = [("hot" if i % 3 else "k", i, None if i < 20 or 40 < i < 70 else rng.randrange(9)) for i in range(100)]
    rows += [("none", i, None) for i in range(100, 130)]
    table = spark.createDataFrame(rows, "k string, id long, x long").repartition(3)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r["id"]: r["s"] for r in table.withColumn("s", F.sum("x").over(w)).collect()}
    got = scans.running_totals(table, ["k"], ["id"], {"s": "x"}, slices=7).collect()
    assert {r["id"]: r["s"] for r in got} == want


def test_bucket_sizes_differ_by_at_most_one(frame):
    sizes = (
        scans.bucketed(frame, 4, ["k"], ["v", "id"], "b", **SLICED)
        .groupBy("k", "b")
        .count()
        .groupBy("k")
        .agg((F.max("count") - F.min("count")).alias("gap"))
    )
    assert sizes.agg(F.max("gap")).first()[0] <= 1


@pytest.mark.parametrize("how", [ONE, SLICED], ids=["one slice", "sliced"])
def test_quantiles(frame, data, how):
    p = {"low": 0.0, "q1": 0.25, "median": 0.5, "q9": 0.9, "high": 1.0}
    got = {r["k"]: r for r in scans.quantiles(scans.value_counts(frame, "k", "v"), "k", "v", p, **how).collect()}
    groups = defaultdict(list)
    for k, v, _, _ in data:
        groups[k].append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, q in p.items():
            assert got[k][name] == pytest.approx(np.quantile(values, q))


def test_slices_really_split_the_hot_group(spark, frame, monkeypatch):
    """No slice holds the hot group whole."""
    seen = []
    real = scans.materialise
    monkeypatch.setattr(scans, "materialise", lambda df, n: seen.append(real(df, n)) or seen[-1])
    scans.running_totals(frame, ["k"], ["v", "id"], {"sx": "x"}, **SLICED).count()
    per_slice = seen[0].filter("k = 'hot'").groupBy("_slice").count().collect()
    assert len(per_slice) > 1
    assert max(r["count"] for r in per_slice) < 400


def test_empty_input(spark):
    empty = spark.createDataFrame([], "k string, v int, id long, x long")
    assert scans.running_totals(empty, ["k"], ["v"], {"s": "x"}).count() == 0
    assert scans.bucketed(empty, 4, ["k"], ["v"], "b").count() == 0
    assert scans.quantiles(scans.value_counts(empty, "k", "v"), "k", "v", {"m": 0.5}).count() == 0
