"""Exact shard sizes, gapless slots and the hypergeometric law."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paidmedia.llm import queries, sharding
from conftest import DATA, plan_of


def test_draw_follows_the_hypergeometric_law(spark):
    total, good, drawn, n = 60, 24, 18, 20_000
    u = (F.col("id") + 0.5) / n  # the quantile function, so counts are the law itself
    lits = [F.lit(x).cast("long") for x in (total, good, drawn)]
    got = spark.range(n).select(sharding.hypergeometric(*lits, u).alias("x")).groupBy("x").count().collect()
    from math import comb

    law = {k: comb(good, k) * comb(total - good, drawn - k) / comb(total, drawn) for k in range(drawn + 1)}
    for r in got:
        assert abs(r["count"] / n - law[r["x"]]) < 2 / n + 1e-9


@pytest.mark.parametrize("total, good, drawn", [(5, 0, 3), (5, 5, 3), (5, 2, 0), (5, 2, 5), (1, 1, 1), (0, 0, 0)])
def test_draw_at_the_edges(spark, total, good, drawn):
    lits = [F.lit(x).cast("long") for x in (total, good, drawn)]
    got = spark.range(20).select(sharding.hypergeometric(*lits, F.col("id") / 20.0).alias("x")).collect()
    assert {r["x"] for r in got} == {min(good, drawn) if total in (good, drawn) else 0}


@pytest.mark.parametrize("n_blocks", [1, 2, 16, 17, 40])
def test_matrix_keeps_both_margins(spark, n_blocks):
    rng = np.random.default_rng(n_blocks)
    sizes = rng.integers(0, 60, n_blocks)
    sizes[-1] += 1
    blocks = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes)], "block long, n long")
    shards = sharding.near_equal(int(sizes.sum()), 7)
    got = {r["block"]: r["counts"] for r in sharding.communication_matrix(blocks, shards, 3).collect()}
    assert set(got) == set(range(n_blocks))
    matrix = np.array([got[i] for i in range(n_blocks)])
    assert (matrix >= 0).all()
    assert matrix.sum(1).tolist() == sizes.tolist()
    assert matrix.sum(0).tolist() == shards


def test_matrix_spread_is_that_of_a_uniform_shuffle(spark):
    blocks = spark.createDataFrame([(i, 30) for i in range(20)], "block long, n long")
    cells = []
    for seed in range(6):
        rows = sharding.communication_matrix(blocks, [150] * 4, seed).collect()
        cells += [c for r in rows for c in r["counts"]]
    var = 30 * 0.25 * 0.75 * (600 - 30) / 599
    assert np.mean(cells) == pytest.approx(7.5)
    assert np.var(cells) == pytest.approx(var, rel=0.25)


def check(rows, n, shards):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


@pytest.mark.parametrize("n, parts", [(1000, 7), (3, 2), (41, 41), (1, 1)])
def test_sizes_and_slots(spark, n, parts):
    docs = spark.range(n).repartition(parts).withColumns({"block": F.lit("b"), "shard": F.lit("old")})
    got = sharding.shuffle_into_shards(docs, 40)
    assert got.columns == ["id", "block", "shard", "slot"]
    rows = got.collect()
    assert sorted(r["id"] for r in rows) == list(range(n))
    check(rows, n, 40)


def test_columns_named_like_inner_ones(spark):
    taken = ["_at", "_block", "_ends", "_bucket", "_before", "_within", "row"]
    docs = spark.range(90).withColumns({n: F.col("id") + i for i, n in enumerate(taken)})
    got = sharding.shuffle_into_shards(docs, 4)
    assert got.columns == ["id", *taken, "shard", "slot"]
    rows = got.collect()
    check(rows, 90, 4)
    assert all(r[n] == r["id"] + i for r in rows for i, n in enumerate(taken))


def test_every_place_is_equally_likely(spark):
    docs = spark.range(40).repartition(3).cache()
    hits = np.zeros(4)
    for seed in range(10):
        for r in sharding.shuffle_into_shards(docs, 4, seed).where("id < 10").collect():
            hits[r["shard"]] += 1
    expected = 10 * 10 / 4
    assert ((hits - expected) ** 2 / expected).sum() < 16  # chi-square with 3 degrees, p 0.001


def test_buckets_of_a_large_shard(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    check(sharding.shuffle_into_shards(spark.range(900).repartition(4), 3).collect(), 900, 3)


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, None)] * 50 + [(1, "a")] * 50, "doc_id long, text string")
    rows = sharding.shuffle_into_shards(docs, 8).collect()
    check(rows, 100, 8)
    assert sum(r["doc_id"] is None for r in rows) == 50
    assert sharding.shuffle_into_shards(docs.limit(0), 8).count() == 0


def test_query_on_whole_table(spark):
    import zlib

    folder = f"{DATA}/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    df = queries.op2_sharding(spark, folder)
    rows = df.collect()
    check(rows, len(docs), 40)
    for r in rows:
        data = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 16, zlib.crc32(data), "rows")
        assert r["grown_shard"] is None
    assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df)
