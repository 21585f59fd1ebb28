"""Approximate nearest neighbours over learned partitions.

A bounded sample of the vectors gets an exact neighbour graph, which recursive bisection
cuts into parts of equal size with few edges between them.  A small softmax classifier
learns to tell a vector's part; it assigns every vector of the table to a part and routes
each query to its most probable parts, where exact distances rank all vectors.  How many parts a query visits is
measured, not assumed: a quarter of the sample is kept from the fit, and the number is the
smallest that finds ``RECALL`` of its true neighbours in the sample.  Neighbours in the
whole table are closer than in a sample, so the recall there is at least about the same.

The sample, the classifier and the part sizes are bounded.  Vectors and queries meet in a
shuffle on (part, block of vectors, block of queries): a part is cut into blocks of at
most ``BLOCK_ROWS`` vectors and ``BLOCK_QUERIES`` queries, so a part that holds a third of
all rows is many tasks, and each block returns its best few per query.

Distances are Euclidean, in double precision on the original vectors.  Ties go to the
smaller id.  Vectors that are null, zero, or hold null or non-finite components, and rows
with a null id, take no part.  Distances are between vectors of one length: those of another
length than most of the sample have no classifier, so each such length is one part, cut into
blocks like any other, and its queries are compared with all of it.
A query is a row: of repeated rows each is a query and a candidate of the others.  Routing
goes on until the parts hold more than k vectors, so a query with fewer candidates than k
gets them all.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.llm.common import freeze

SAMPLE_ROWS = 4096
PART_ROWS = 256
GRAPH_NEIGHBOURS = 10
#: Share of the true neighbours that the visited parts have to hold.
RECALL = 0.95
BLOCK_ROWS, BLOCK_QUERIES = 20_000, 2_000
SEED = 5


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def neighbour_graph(points: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest other points of each point."""
    k = min(k, len(points) - 1)
    out = np.empty((len(points), k), int)
    for at in range(0, len(points), 512):
        d = squared(points[at : at + 512], points)
        d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
        out[at : at + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def bisect(points: np.ndarray, near: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Side (bool) of each member: halves of equal size with few graph edges between them."""
    place = np.full(len(points), -1)
    place[members] = np.arange(len(members))
    local = place[near[members]]
    inside = local >= 0
    rows = np.repeat(np.arange(len(members)), inside.sum(1))
    cols = local[inside]
    degree = np.bincount(rows, minlength=len(members)) + np.bincount(cols, minlength=len(members)) + 1e-9
    # Start along the widest direction, then smooth over the graph.
    centred = points[members] - points[members].mean(0)
    axis = np.linalg.svd(centred, full_matrices=False)[2][0] if len(members) > 1 else centred[0]
    value = centred @ axis
    for _ in range(60):
        spread = np.bincount(rows, value[cols], len(members)) + np.bincount(cols, value[rows], len(members))
        value = 0.5 * value + 0.5 * spread / degree
        value -= np.average(value, weights=degree)
        value /= np.abs(value).max() + 1e-12
    side = np.zeros(len(members), bool)
    side[np.argsort(value, kind="stable")[len(members) // 2 :]] = True
    # Swap pairs that both gain edges, best first; sizes stay equal.
    for _ in range(10):
        sign = np.where(side, 1.0, -1.0)
        pull = np.bincount(rows, sign[cols], len(members)) + np.bincount(cols, sign[rows], len(members))
        gain = -pull * sign
        left = np.flatnonzero(~side)
        right = np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left])], right[np.argsort(-gain[right])]
        n = min(len(left), len(right))
        good = (gain[left[:n]] > 0) & (gain[right[:n]] > 0)
        n = max(1, int(good.sum()) // 2) if good.any() else 0
        if not n:
            break
        side[left[:n]], side[right[:n]] = True, False
    return side


def partition(points: np.ndarray, near: np.ndarray, depth: int) -> np.ndarray:
    """Part number of each point: 2**depth parts of equal size."""
    part = np.zeros(len(points), int)
    for level in range(depth):
        for p in range(1 << level):
            members = np.flatnonzero(part == p)
            if len(members):
                part[members] = p + (bisect(points, near, members).astype(int) << level)
    return part


class Router:
    """A softmax classifier with one hidden layer over standardised vectors."""

    def __init__(self, points: np.ndarray, targets: np.ndarray, hidden: int = 64, epochs: int = 60) -> None:
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = points.mean(0), points.std(0) + 1e-9
        x = (points - self.mean) / self.scale
        n_in, n_out = x.shape[1], targets.shape[1]
        self.w = [
            rng.normal(0, 1 / np.sqrt(n_in), (n_in, hidden)), np.zeros(hidden),
            rng.normal(0, 1 / np.sqrt(hidden), (hidden, n_out)), np.zeros(n_out),
        ]
        moment = [(np.zeros_like(w), np.zeros_like(w)) for w in self.w]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 128):
                rows = order[at : at + 128]
                h = np.maximum(x[rows] @ self.w[0] + self.w[1], 0)
                p = self._softmax(h @ self.w[2] + self.w[3])
                d = (p - targets[rows]) / len(rows)
                back = (d @ self.w[2].T) * (h > 0)
                step += 1
                for i, g in enumerate((x[rows].T @ back, back.sum(0), h.T @ d, d.sum(0))):
                    a, b = moment[i]
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    self.w[i] -= 0.003 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def probabilities(self, points: np.ndarray) -> np.ndarray:
        h = np.maximum((points - self.mean) / self.scale @ self.w[0] + self.w[1], 0)
        return self._softmax(h @ self.w[2] + self.w[3])


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``length`` components."""
    return column.flatten().to_numpy(False).astype(np.float64).reshape(-1, length)


def of_length(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(lengths of all rows, matrix of the rows whose length is ``length``)."""
    lengths = column.value_lengths().to_numpy(False)
    return lengths, matrix(column.filter(pa.array(lengths == length)), length)


class Index:
    """Every usable vector with its part, and the classifier that routes to parts.

    ``sample_rows`` bounds what the graph, its parts and the classifier are fitted on;
    all rows are indexed.
    """

    def __init__(
        self, vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", sample_rows: int = SAMPLE_ROWS
    ) -> None:
        spark = vectors.sparkSession
        rows = vectors.select(
            F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")
        ).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
        picked = rows.orderBy(F.xxhash64(F.lit(SEED), "vec_id"), "vec_id").limit(sample_rows).collect()
        lengths = [len(r["v"]) for r in picked]
        self.length = max(set(lengths), key=lengths.count) if lengths else 0
        points = np.array([r["v"] for r in picked if len(r["v"]) == self.length], float)
        self.router = self._fit(points)
        shared = spark.sparkContext.broadcast(self.router)
        length = self.length

        @F.arrow_udf("int")
        def part_of(column: pa.Array) -> pa.Array:
            lengths, points = of_length(column, length)
            # Parts below zero hold the vectors of other lengths.
            out = np.where(lengths == length, 0, -lengths).astype(np.int32)
            if shared.value is not None and len(points):
                out[lengths == length] = shared.value.probabilities(points).argmax(1)
            return pa.array(out)

        # Vectors are the index: a row stays a fixed few hundred bytes.
        self.rows = freeze(
            rows.withColumn("part", part_of("v")).withColumn("row", F.monotonically_increasing_id())
        )
        found = self.rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per part
        self.sizes = {r["part"]: r["n"] for r in found}

    def _fit(self, points: np.ndarray) -> Router | None:
        """The classifier; ``probes`` becomes the number of parts that a query visits."""
        self.probes = 1
        depth = max(0, int(np.log2(max(1, len(points) / PART_ROWS))))
        if not depth:
            return None
        # The sample is in the order of a hash, so its first quarter is any quarter.
        kept = len(points) // 4
        learned = points[kept:]
        near = neighbour_graph(learned, GRAPH_NEIGHBOURS)
        part = partition(learned, near, depth)
        # A vector's target is where it and its neighbours are.
        own = np.eye(1 << depth)[part]
        router = Router(learned, 0.5 * own + 0.5 * own[near].mean(1))
        p = router.probabilities(points)
        true = neighbour_graph(points, GRAPH_NEIGHBOURS)[:kept]
        visit = np.argsort(np.argsort(-p[:kept], axis=1, kind="stable"), axis=1, kind="stable")
        turn = np.take_along_axis(visit, p.argmax(1)[true], axis=1)
        found = np.cumsum(np.bincount(turn.ravel(), minlength=1 << depth)) / turn.size
        self.probes = int(np.argmax(found >= RECALL)) + 1
        return router

    def search(self, queries: DataFrame, k: int, probes: int | None = None) -> DataFrame:
        """(query_id, rank, vec_id, score) for queries taken from ``rows`` (columns vec_id, v, row)."""
        shared = self.rows.sparkSession.sparkContext.broadcast((self.router, self.sizes))
        probes = probes or self.probes
        length = self.length

        @F.arrow_udf("array<int>")
        def routes(column: pa.Array) -> pa.Array:
            router, sizes = shared.value
            lengths, points = of_length(column, length)
            if router is None or not len(points):
                order = np.zeros((len(points), 1), int)
            else:
                order = np.argsort(-router.probabilities(points), axis=1, kind="stable")
            ranked = iter(order.tolist())
            out = []
            for n in lengths.tolist():
                if n != length:
                    out.append([-n])
                    continue
                row = next(ranked)
                taken, seen = [], 0
                for p in row:
                    # On past the usual number while the parts hold no more than k vectors.
                    if len(taken) >= probes and seen > k:
                        break
                    if p in sizes:
                        taken.append(p)
                        seen += sizes[p]
                out.append(taken)
            return pa.array(out, pa.list_(pa.int32()))

        routed = queries.select(
            F.col("vec_id").alias("query_id"), F.col("row").alias("query_row"), F.col("v").alias("q"), F.explode(routes("v")).alias("asked_part")
        )
        routed = freeze(routed).withColumn("part", F.col("asked_part") + 0).drop("asked_part")
        asked = {r["part"]: r["n"] for r in routed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
        blocks = self.rows.sparkSession.createDataFrame(
            [
                (p, max(1, -(-n // BLOCK_ROWS)), max(1, -(-asked.get(p, 0) // BLOCK_QUERIES)))
                for p, n in self.sizes.items()
            ],
            "part int, row_blocks int, query_blocks int",
        )

        def spread(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
            """Each row in its own block, once for every block of the other side."""
            mine = F.pmod(F.xxhash64(F.lit(SEED), F.col(key)), F.col(own)).cast("int")
            others = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
            return df.join(F.broadcast(blocks), "part").select(
                *df.columns, mine.alias(own.replace("blocks", "block")), others.alias(other.replace("blocks", "block"))
            )

        candidates = spread(self.rows.where(F.col("part").isin(*asked)), "row", "row_blocks", "query_blocks")
        asking = spread(routed, "query_row", "query_blocks", "row_blocks")

        def rank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame(columns=["query_id", "query_row", "vec_id", "row", "score"])
            points = np.stack(right["v"].to_numpy())
            ids, rows = right["vec_id"].to_numpy(), right["row"].to_numpy()
            out = []
            for q_id, q_row, v in zip(left["query_id"], left["query_row"], left["q"], strict=True):
                d = points - np.asarray(v)
                d = np.sqrt(np.einsum("ij,ij->i", d, d))
                d[rows == q_row] = np.inf
                last = min(k, len(d)) - 1
                best = np.flatnonzero(d <= np.partition(d, last)[last])
                best = best[np.lexsort((rows[best], ids[best], d[best]))][:k]
                best = best[rows[best] != q_row]
                out.append((np.full(len(best), q_id), np.full(len(best), q_row), ids[best], rows[best], d[best]))
            names = ["query_id", "query_row", "vec_id", "row", "score"]
            return pd.DataFrame({n: np.concatenate(c) for n, c in zip(names, zip(*out, strict=True), strict=True)})

        keys = ["part", "row_block", "query_block"]
        found = (
            asking.groupBy(*keys)
            .cogroup(candidates.groupBy(*keys))
            .applyInPandas(rank, "query_id long, query_row long, vec_id long, row long, score double")
        )
        order = Window.partitionBy("query_row").orderBy("score", "vec_id", "row")
        return (
            found.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score")
        )
