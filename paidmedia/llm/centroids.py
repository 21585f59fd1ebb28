"""Centroid clustering of integer vectors by scalar lookup tables.

A component x becomes the integer floor(64 * x).  In every round a task takes a batch of
vectors and tabulates, for each dimension and each integer that occurs in it, the squared
difference to every centroid; a vector's distances are then rows gathered from the tables
and summed.  The table of a dimension has at most as many rows as the batch, so memory is
bounded whatever the range of the integers.  All arithmetic is exact in 64-bit integers.

A round leaves the tasks as one count and one sum per dimension for each centroid, summed
by Spark before its shuffle; the driver sees one row per centroid.  Nothing is written:
every round reads the vectors again, so a lost executor costs its running tasks.

Vectors that are null, of another number of components, or hold a null or non-finite one
are left out.  A kept vector with an integer beyond 2**27 in size, whose distances may
not fit 64 bits, is returned with null cluster, distance, inertia and digest and moves no
centroid.  Repeated rows are vectors of their own; a null id is the empty text in the
seed's hash.  Equal hashes, which repeated ids have, go by the smaller vector.  With fewer
vectors than centroids each is a centroid; an empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 16
ROUNDS = 3
SEED = 1
DIMENSIONS = 64
SCALE = 64
#: Integers up to this size keep the sum of 64 squared differences within 64 bits.
LARGEST = 1 << 27


def usable(vector: Column, dimensions: int) -> Column:
    """True for an array of that many components, each of them finite."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & ~bad, F.lit(False))


def kept(vectors: DataFrame, vec_id: str, vector: str, dimensions: int) -> DataFrame:
    """(vec_id, vector): the usable rows, components as double."""
    return vectors.where(usable(F.col(vector), dimensions)).select(
        F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )


def integers(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of floor(64 * x), and which of them are small enough for exact distances."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    with np.errstate(over="ignore"):
        scaled = np.floor(x * SCALE)
    small = (np.abs(scaled) <= LARGEST).all(axis=1)
    return np.where(small[:, None], scaled, 0).astype(np.int64), small


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each centre, by one lookup table per dimension."""
    total = np.zeros((len(rows), len(centres)), np.int64)
    for d in range(rows.shape[1]):
        occurring, at = np.unique(rows[:, d], return_inverse=True)
        table = (occurring[:, None] - centres[None, :, d]) ** 2
        total += table[at]
    return total


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, the smaller number in ties, and its distance."""
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    each = distances(rows, centres)
    cluster = each.argmin(axis=1)
    return cluster, each[np.arange(len(rows)), cluster]


def seeds(vectors: DataFrame, k: int, seed: int, dimensions: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes: ``k`` rows at the driver."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    limit = F.lit(float(LARGEST))
    fits = ~F.exists("vector", lambda v: F.abs(F.floor(v * SCALE).cast("double")) > limit)
    first = (
        vectors.where(fits)
        .select(
            F.sha2(named.cast("binary"), 256).alias("hash"),
            F.transform("vector", lambda v: F.floor(v * SCALE)).alias("integers"),
        )
        .orderBy("hash", "integers")
        .limit(k)
        .collect()
    )
    return np.array([r["integers"] for r in first], np.int64).reshape(-1, dimensions)


def totals(vectors: DataFrame, centres: np.ndarray, dimensions: int) -> list[tuple[int, int, list[int]]]:
    """Per cluster its count, its summed distance and its componentwise sums, as exact integers."""
    known = vectors.sparkSession.sparkContext.broadcast(centres)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, small = integers(batch.column(0), dimensions)
            rows = rows[small]
            cluster, distance = nearest(rows, known.value)
            # A batch's sums stay within 64 bits; across batches Spark sums decimals.
            order = np.argsort(cluster, kind="stable")
            used, starts = np.unique(cluster[order], return_index=True)
            if not len(used):
                continue
            sums = np.add.reduceat(rows[order], starts, axis=0)
            # A distance has up to 62 bits, so high and low halves are summed apart.
            high = np.add.reduceat(distance[order] >> 31, starts)
            low = np.add.reduceat(distance[order] & ((1 << 31) - 1), starts)
            count = np.diff(np.append(starts, len(cluster)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(count), pa.array(high), pa.array(low),
                 pa.array(list(sums), pa.list_(pa.int64()))],
                names=["cluster", "n", "high", "low", "sums"],
            )

    partial = vectors.select("vector").mapInArrow(
        assign, "cluster int, n bigint, high bigint, low bigint, sums array<bigint>"
    )
    wide = "decimal(38,0)"
    summed = partial.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("high").cast(wide)) * F.lit(1 << 31) + F.sum(F.col("low").cast(wide))).cast(wide).alias("distance"),
        F.array(*[F.sum(F.col("sums")[d].cast(wide)) for d in range(dimensions)]).alias("sums"),
    )
    out = [(0, 0, [0] * dimensions) for _ in centres]
    for r in summed.collect():  # one row per centroid
        out[r["cluster"]] = (r["n"], int(r["distance"]), [int(s) for s in r["sums"]])
    return out


def moved(centres: np.ndarray, found: list[tuple[int, int, list[int]]]) -> np.ndarray:
    """Centres at the exact floor of their vectors' means; one without vectors stays."""
    return np.array(
        [[s // n for s in sums] if n else list(c) for c, (n, _, sums) in zip(centres.tolist(), found, strict=True)],
        np.int64,
    ).reshape(centres.shape)


def digest(centre: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centre.tolist())).encode()).hexdigest()


SCHEMA = "vec_id bigint, cluster int, distance bigint"
FITS = (1 << 63) - 1


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per kept vector.

    ``distance`` is the squared distance to the vector's centroid, ``cluster_inertia`` and
    ``inertia`` its sum over the cluster and over all vectors (null beyond 64 bits), and
    ``centroid_sha256`` the hash of the final centroid's components joined by commas.
    """
    spark = vectors.sparkSession
    rows = kept(vectors, vec_id, vector, dimensions)
    centres = seeds(rows, k, seed, dimensions)
    for _ in range(rounds if len(centres) else 0):
        centres = moved(centres, totals(rows, centres, dimensions))
    final = totals(rows, centres, dimensions) if len(centres) else []
    known = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints, small = integers(batch.column(1), dimensions)
            where, distance = np.zeros(len(ints), np.int32), np.zeros(len(ints), np.int64)
            if small.any():
                where[small], distance[small] = nearest(ints[small], known.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(where, mask=~small), pa.array(distance, mask=~small)],
                names=["vec_id", "cluster", "distance"],
            )

    def long_or_null(n: int) -> int | None:
        return n if n <= FITS else None

    inertia = long_or_null(sum(d for _, d, _ in final))
    per_cluster = spark.createDataFrame(
        [(c, long_or_null(final[c][1]), inertia, digest(centre)) for c, centre in enumerate(centres)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    assigned = rows.withColumn("vec_id", F.col("vec_id").cast("long")).mapInArrow(assign, SCHEMA)
    # One row per centroid.
    return assigned.join(F.broadcast(per_cluster), "cluster", "left").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
