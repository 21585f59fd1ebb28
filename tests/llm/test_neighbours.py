"""Recall and exactness against brute force."""

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from paidmedia.llm import neighbours, queries

SCHEMA = "vec_id long, embedding array<float>, part string"


def brute(rows, k, every):
    """(query row, ranked (distance, id, row)) of every query."""
    out = []
    for i, (a, v) in enumerate(rows):
        if a % every == 0:
            d = [(float(np.sqrt(((np.float64(v) - np.float64(w)) ** 2).sum())), b, j) for j, (b, w) in enumerate(rows) if j != i]
            out.append((a, sorted(d)[:k]))
    return out


def clusters(n, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (12, 16))
    return [(i, (centres[i % 12] + rng.normal(0, 0.4, 16)).astype(np.float32).tolist()) for i in range(n)]


def search(spark, rows, every=10, k=10):
    frame = spark.createDataFrame([(i, v, "clash") for i, v in rows], SCHEMA).repartition(4)
    index = neighbours.Index(frame)
    return index.search(index.rows.where(F.col("vec_id") % every == 0), k).collect()


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    hits = total = 0
    for q, best in want:
        ranked = sorted(found.get(q, []))
        assert [r for r, _, _ in ranked] == list(range(1, len(ranked) + 1))
        assert [(s, v) for _, s, v in ranked] == sorted((s, v) for _, s, v in ranked)
        hits += len({v for _, _, v in ranked} & {b for _, b, _ in best})
        total += len(best)
    return hits / total


def test_recall_over_parts(spark):
    rows = clusters(3000)
    got = search(spark, rows)
    assert len(got) == 300 * 10
    assert recall(got, brute(rows, 10, 10)) >= 0.9
    vectors = dict(rows)
    for r in got:
        v, w = (np.float64(vectors[i]) for i in (r["query_id"], r["vec_id"]))
        assert r["score"] == pytest.approx(float(np.sqrt(((v - w) ** 2).sum())), rel=1e-12)


def test_parts_are_balanced_and_cut_few_edges():
    points = np.array([v for _, v in clusters(1024)])
    near = neighbours.neighbour_graph(points, 10)
    part = neighbours.partition(points, near, 2)
    assert np.bincount(part).tolist() == [256] * 4
    assert (part[near] == part[:, None]).mean() > 0.7  # a random cut keeps a quarter


def test_recall_where_the_parts_tell_little(spark):
    """Vectors without clusters: many parts have to be visited, and they are."""
    rng = np.random.default_rng(7)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 1, (4000, 32)).astype(np.float32))]
    assert recall(search(spark, rows, every=40), brute(rows, 10, 40)) >= 0.9


def test_blocks_of_a_hot_part_give_the_same(spark, monkeypatch):
    rows = clusters(400, 3) + [(1000 + i, [1.0] * 16) for i in range(200)]
    whole = search(spark, rows)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    assert sorted(search(spark, rows)) == sorted(whole)
    for q, best in brute(rows, 10, 10):
        if q >= 1000:  # ties go to smaller ids
            got = sorted((r["rank"], r["vec_id"]) for r in whole if r["query_id"] == q)
            assert [v for _, v in got] == [b for _, b, _ in best]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 11, 12])
def test_few_candidates(spark, n):
    rows = clusters(n)
    got = search(spark, rows, every=1)
    assert len(got) == n * min(10, max(0, n - 1))


def test_unusable_vectors_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (10, [1.0, 2.0]), (10, [1.0, 2.0]), (20, None), (30, [0.0, 0.0]), (40, [1.0, None]),
        (50, [nan, 1.0]), (60, [inf, 1.0]), (70, []), (None, [1.0, 1.0]), (3, [4.0, 6.0]), (80, [1.0, 2.0, 3.0]),
    ]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in search(spark, rows))
    assert got == sorted(
        [(0, 1, 10, 0.0), (0, 2, 10, 0.0), (0, 3, 3, 5.0)] + 2 * [(10, 1, 0, 0.0), (10, 2, 10, 0.0), (10, 3, 3, 5.0)]
    )


def test_vectors_of_other_lengths_meet_their_like(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(2)
    rows = clusters(900) + [(2000 + i, rng.normal(0, 1, 5).tolist()) for i in range(150)] + [(3000, [1.0, 2.0])]
    got = search(spark, rows)
    by_length = {n: [r for r in rows if len(r[1]) == n] for n in (16, 5, 2)}
    assert recall([r for r in got if r["query_id"] < 900], brute(by_length[16], 10, 10)) >= 0.9
    odd = [r for r in got if 2000 <= r["query_id"] < 3000]
    assert len(odd) == 15 * 10 and recall(odd, brute(by_length[5], 10, 10)) == 1.0
    assert not [r for r in got if r["query_id"] == 3000 or r["vec_id"] == 3000]


def test_query_on_whole_table(spark):
    folder = f"{DATA}/sf0.1"
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = queries.op7_neighbours(spark, folder).collect()
    vectors = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    hits = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((vectors - vectors[ids == q]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, d))][:10])
        hits += len(best & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits >= 0.9 * 10 * (ids % 100 == 0).sum()
