"""Sketch-guided order statistics against sorts, with hot groups, ties and sketches that miss."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paidmedia.functions import selection


@pytest.fixture(scope="module")
def data():
    """One key holds a third of the rows, values tie often, one key is null, some values are."""
    rng = random.Random(11)
    keys = ["hot"] * 3000 + [f"k{i % 30}" for i in range(5000)] + [None] * 900 + ["one"]
    return [(k, rng.choice([rng.randrange(40), rng.random() * 40, None]), i) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame([(k, None if v is None else float(v), i) for k, v, i in data], "k string, v double, id long").repartition(5)


def groups_of(data, nulls):
    out = defaultdict(list)
    for k, v, i in data:
        if v is not None or nulls:
            out[k].append((-np.inf if v is None else float(v), i))
    return {k: sorted(g) for k, g in out.items()}


@pytest.mark.parametrize("accuracy", [20, 300, 10_000])
@pytest.mark.parametrize("slices", [None, 5])
def test_quantiles(frame, data, accuracy, slices, monkeypatch):
    """A coarse sketch leaves wide brackets, a fine one narrow ones; the result is the same."""
    monkeypatch.setattr(selection, "ACCURACY", accuracy)
    monkeypatch.setattr(selection, "SMALL", 2 * accuracy // 20)
    p = {"low": 0.0, "q1": 0.25, "median": 0.5, "q9": 0.9, "high": 1.0}
    got = {r["k"]: r for r in selection.exact_quantiles(frame, "k", "v", p, slices).collect()}
    want = groups_of(data, False)
    assert set(got) == set(want)
    for k, rows in want.items():
        for name, q in p.items():
            assert got[k][name] == pytest.approx(np.quantile([v for v, _ in rows], q))


@pytest.mark.parametrize("buckets", [2, 4, 7, 64])
def test_buckets(frame, data, buckets):
    got = {r["id"]: r["b"] for r in selection.bucketed(frame, buckets, ["k"], ["v", "id"], "b").collect()}
    want = {}
    for rows in groups_of(data, True).values():
        for b, part in enumerate(np.array_split(rows, buckets), 1):
            want.update({int(i): b for _, i in part})
    assert got == want


def test_a_sketch_that_misses_costs_no_exactness(frame, data, monkeypatch):
    """Brackets put elsewhere: all rows are ranked instead."""
    real = selection._brackets
    monkeypatch.setattr(selection, "SMALL", 0)

    def elsewhere(*args):
        return real(*args).withColumn("_low", F.transform("_low", lambda v: v * 0 - 2)).withColumn(
            "_high", F.transform("_high", lambda v: v * 0 - 1)
        )

    monkeypatch.setattr(selection, "_brackets", elsewhere)
    got = {r["k"]: r["m"] for r in selection.exact_quantiles(frame, "k", "v", {"m": 0.5}).collect()}
    assert got == {k: pytest.approx(np.median([v for v, _ in g])) for k, g in groups_of(data, False).items()}


def test_only_the_brackets_are_kept(spark, monkeypatch):
    """Of 200,000 distinct values a few hundred are ranked."""
    kept = []
    real = selection._ranked
    monkeypatch.setattr(selection, "_ranked", lambda cells, *a: kept.append(cells.count()) or real(cells, *a))
    frame = spark.range(200_000).select(F.lit("a").alias("k"), (F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    got = selection.exact_quantiles(frame, "k", "v", {"p": 0.25, "q": 0.5}).first()
    values = sorted(i * 7919 % 200_003 for i in range(200_000))
    assert got["p"] == pytest.approx(np.quantile(values, 0.25)) and got["q"] == pytest.approx(np.quantile(values, 0.5))
    assert kept[0] < 2000


def test_empty(spark):
    empty = spark.createDataFrame([], "k string, v double, id long")
    assert selection.exact_quantiles(empty, "k", "v", {"m": 0.5}).count() == 0
    assert selection.bucketed(empty, 4, ["k"], ["v", "id"], "b").count() == 0
