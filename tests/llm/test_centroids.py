"""Clusters against plain integer arithmetic, edge cases, and tables against differences."""

import hashlib
import math

import numpy as np
import parity
import pytest
from conftest import DATA

from paidmedia.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k=16, rounds=3, dims=64):
    """{position: (cluster, distance)}, cluster inertias, inertia and digests, in Python integers."""
    good = [
        (i, vec_id, [math.floor(64 * x) for x in v])
        for i, (vec_id, v) in enumerate(rows)
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]

    def key(row):
        name = f"1:{'' if row[1] is None else row[1]}"
        return hashlib.sha256(name.encode()).hexdigest(), row[2]

    centres = [v for _, _, v in sorted(good, key=key)[:k]]

    def assign():
        out = {}
        for i, _, v in good:
            out[i] = min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))
        return out

    for _ in range(rounds):
        near = assign()
        for n in range(len(centres)):
            mine = [v for i, _, v in good if near[i][1] == n]
            if mine:
                centres[n] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    near = assign()
    inertia = sum(d for d, _ in near.values())
    out = []
    for i, vec_id, _ in good:
        d, n = near[i]
        own = sum(e for e, m in near.values() if m == n)
        sha = hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()
        out.append((vec_id, n, d, own, inertia, sha))
    return out


def same(got, want):
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_tables_give_the_squared_distances():
    rng = np.random.default_rng(1)
    rows, centres = rng.integers(-90, 90, (200, 64)), rng.integers(-90, 90, (16, 64))
    want = ((rows[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (centroids.distances(rows, centres) == want).all()


def test_query_over_the_whole_table(spark):
    folder = f"{DATA}/sf0.001"
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    same(queries.op11_centroids(spark, folder).collect(), brute(rows))


def test_clustered_rows_with_copies(spark):
    """A third of the rows are one vector, ids repeat, and distances tie."""
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(20, 64))
    rows = [(i, (centre[i % 20] + rng.normal(size=64) / 9).tolist()) for i in range(200)]
    rows += [(1000 + i % 60, centre[3].tolist()) for i in range(100)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    same(centroids.cluster(table).collect(), brute(rows))


def test_rows_that_take_no_part(spark):
    one = [0.5] * 64
    rows = [
        (1, one), (2, None), (3, one[:63]), (4, [*one, 1.0]), (5, [*one[:63], None]), (6, [*one[:63], float("nan")]),
        (7, [*one[:63], float("inf")]), (8, [0.0] * 64), (None, [-0.01] * 64), (1, one), (9, []), (None, one),
    ]
    table = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA + ", cluster string, n int")
    got = centroids.cluster(table).collect()
    same(got, brute(rows))
    assert len(got) == 5


def test_too_large_for_exact_distances(spark):
    """Such a vector is returned, but without a cluster, and moves no centroid."""
    usual = [(i, [i / 10] * 64) for i in range(30)]
    table = spark.createDataFrame([*usual, (99, [1e30] * 64), (98, [-1e308] * 64)], SCHEMA)
    got = {r["vec_id"]: tuple(r) for r in centroids.cluster(table).collect()}
    for i in (98, 99):
        assert got.pop(i) == (i, None, None, None, None, None)
    same(got.values(), brute(usual))


def test_large_but_exact(spark):
    rows = [(i, [(-1) ** (i + d) * (2_000_000.0 - i) for d in range(64)]) for i in range(40)]
    got = centroids.cluster(spark.createDataFrame(rows, SCHEMA)).collect()
    want = [(*r[:3], *[x if x < 1 << 63 else None for x in r[3:5]], r[5]) for r in brute(rows)]
    same(got, want)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_rows_than_centroids(spark, n):
    rows = [(i, [float(i)] * 64) for i in range(n)]
    same(centroids.cluster(spark.createDataFrame(rows, SCHEMA)).collect(), brute(rows))


def test_query_against_sql(spark):
    folder = f"{DATA}/sf0.01"
    df = queries.op11_centroids(spark, folder)
    assert parity.compare(df, parity.connect(folder), queries.oracle_sql()["op11_centroids"]) is None
