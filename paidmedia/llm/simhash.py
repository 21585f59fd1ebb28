"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is cut into 16 segments of 4 bits, and each segment gives the number of
its set bits.  Flipping one bit moves one count by one, so the Manhattan distance of two
such vectors is a lower bound of the Hamming distance.  The vectors are points of an
integer grid; two points at a distance of 2r or less have a grid cell within r of both.
Every distinct fingerprint enters the cells within r of its own, an equi-join on the
cell finds the candidates, and the join condition verifies the exact bit distance.

Equal fingerprints are one row before anything is joined, so a group of copies of any
size costs one row; a fingerprint has at most 64 + 64*63/2 neighbours within two bits.
A cell that many fingerprints share is a skewed join key, which adaptive execution splits.

Nulls: a null text has no words, hence fingerprint zero.  A null id never becomes a
component's id (a component of null ids alone has id null).  Repeated rows stay rows.
An empty table gives an empty result.  Other columns are not touched.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from paidmedia.llm.common import ASCII_LOWER, binary, free_name, freeze

SEED = 42


def simhash_bytes(text: bytes | None, shingle: int) -> int:
    """The fingerprint of a text as a signed 64-bit integer."""
    words = (text or b"").translate(ASCII_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    starts = list(accumulate(map(len, words), lambda at, n: at + n + 1, initial=0))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[s : e - 1], SEED) for s, e in zip(starts, starts[width:], strict=False)),
        np.uint64,
        len(words) - width + 1,
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        octets = hashes[at : at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view(np.int64)[0])


def fingerprint(text: str | Column, shingle: int = 3) -> Column:
    """Column: bit i is set if it is set in over half of the shingles' XXH64 values."""

    @F.arrow_udf(LongType())
    def of_batch(column: pa.Array) -> pa.Array:
        return pa.array([simhash_bytes(t, shingle) for t in binary(column)], pa.int64())

    return of_batch(text)


def segment_counts(bits: Column) -> Column:
    """The 16 counts of set bits, each in four bits of one long."""
    ones = [F.shiftrightunsigned(bits, k).bitwiseAND(F.lit(0x1111111111111111)) for k in range(4)]
    return ones[0] + ones[1] + ones[2] + ones[3]


def nearby_cells(point: Column, radius: int) -> Column:
    """Array of the grid cells within ``radius`` of a point by Manhattan distance."""

    def step(p: Column) -> Column:
        around = [p]
        for segment in range(16):
            count = F.shiftrightunsigned(p, 4 * segment).bitwiseAND(F.lit(15))
            unit = F.lit(1 << (4 * segment))
            around += [F.when(count < 4, p + unit), F.when(count > 0, p - unit)]
        return F.array_compact(F.array(*around))

    cells = F.array(point)
    for _ in range(radius):
        cells = F.array_distinct(F.flatten(F.transform(cells, step)))
    return cells


def links(distinct: DataFrame, bits: str, max_bits: int) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints that differ in ``max_bits`` or fewer bits."""
    cells = distinct.select(
        F.col(bits).alias("bits"),
        F.explode(nearby_cells(segment_counts(F.col(bits)), (max_bits + 1) // 2)).alias("cell"),
    )
    a, b = cells.alias("a"), cells.alias("b")
    near = (
        (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.bits") < F.col("b.bits"))
        & (F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits"))) <= max_bits)
    )
    return a.join(b, near).select(F.col("a.bits").alias("a"), F.col("b.bits").alias("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); nodes of a component share a root.

    Each round gives every node a new random rank, maps it to the lowest in its closed
    neighbourhood and contracts the edges along that map, which leaves a constant
    fraction of the nodes; so there are about log(n) rounds however long a chain is.
    Each round's map is a narrow table; the maps are composed at the end.
    """
    edges = freeze(edges.select("a", "b"))
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        seed = F.lit(len(rounds))

        def ranked(node: str, seed: Column = seed) -> Column:
            return F.struct(F.xxhash64(seed, F.col(node)).alias("rank"), F.col(node).alias("node"))

        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min(ranked("b")).alias("lowest"))
        step = freeze(
            lowest.select(
                F.col("a").alias("node"), F.least(ranked("a"), F.col("lowest"))["node"].alias("root")
            )
        )
        rounds.append(step)
        to_a = step.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        to_b = step.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        edges = freeze(
            edges.join(to_a, "a")
            .join(to_b, "b")
            .where("root_a <> root_b")
            .select(
                F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")
            )
            .distinct()
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[0]
    for step in rounds[1:]:
        onward = step.select(F.col("node").alias("root"), F.col("root").alias("onward"))
        found = found.join(onward, "root", "left").select(
            "node", F.coalesce("onward", "root").alias("root")
        )
    return found


def fingerprint_classes(prints: DataFrame, bits: str, doc_id: str, max_bits: int) -> DataFrame:
    """(bits, group, component_id) of each distinct fingerprint of a frozen table of fingerprints.

    ``group`` is a fingerprint of the component, the same for all its members.
    """
    distinct = freeze(
        prints.groupBy(F.col(bits).alias("bits")).agg(F.min(doc_id).alias("first_id"))
    )
    roots = freeze(connected(links(distinct, "bits", max_bits)))
    member = distinct.join(roots, distinct["bits"] == roots["node"]).select("bits", "root", "first_id")
    least = member.groupBy("root").agg(F.min("first_id").alias("least_id"))
    linked = member.join(least, "root").select(F.col("bits").alias("linked"), "root", "least_id")
    return distinct.join(linked, distinct["bits"] == linked["linked"], "left").select(
        "bits",
        F.coalesce("root", "bits").alias("group"),
        F.when(F.col("linked").isNull(), F.col("first_id"))
        .otherwise(F.col("least_id"))
        .alias("component_id"),
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: its id, fingerprint in hex and component.

    Two rows are linked if their fingerprints differ in ``max_bits`` or fewer bits;
    ``component_id`` is the smallest id that links reach, the row's own included.
    """
    prints = freeze(
        docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("bits"))
    )
    classes = fingerprint_classes(prints, "bits", "doc_id", max_bits)
    return prints.join(classes, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id.

    Rows of one id with different texts are told apart by the hash of the text, and of
    equal rows one stays.  A null id stays only where the whole component has null ids.
    """
    mark = free_name(docs, "text_hash")
    key = F.xxhash64(F.col(text))
    prints = freeze(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            key.alias("text_hash"),
            fingerprint(F.col(text), shingle).alias("bits"),
        )
    )
    classes = fingerprint_classes(prints, "bits", "doc_id", max_bits)
    # Equal rows are one before they meet their class, however many there are.
    apart = prints.groupBy("doc_id", "text_hash", "bits").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "n"))
    kept_id, kept_hash, kept_n = (free_name(docs, c) for c in ("kept_id", "kept_hash", "kept_n"))
    chosen = freeze(
        apart.join(classes, "bits")
        .groupBy("group")
        .agg(first.alias("first"))
        .select(
            F.col("first.doc_id").alias(kept_id),
            F.col("first.text_hash").alias(kept_hash),
            F.col("first.n").alias(kept_n),
        )
    )
    rows = docs.withColumn(mark, key)

    def of(few: DataFrame) -> DataFrame:
        met = rows[doc_id].eqNullSafe(few[kept_id]) & (rows[mark] == few[kept_hash])
        return rows.join(few, met, "left_semi")

    # Texts are shuffled once, to meet the rows chosen; only those that stand several times
    # with one id are shuffled again.
    single = of(chosen.where(F.col(kept_n) == 1))
    several = of(chosen.where(F.col(kept_n) > 1)).dropDuplicates([doc_id, mark])
    return single.unionByName(several).drop(mark)
