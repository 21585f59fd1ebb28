"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows of each input block go to each shard is drawn first, from the law that a
uniform permutation of all rows would give: the multivariate hypergeometric one.  Rows
are permuted within their block, dealt out by the block's counts, and permuted again
within their shard.  Every arrangement with the given shard sizes is equally likely, and
the sizes are exact, although no global sort takes place.

The matrix (blocks x shards) is drawn as a tree: a node's counts are divided among up to
``FAN_OUT`` children, so the draws of a level run in parallel.  A count is drawn by
inversion over the hypergeometric weights within twelve standard deviations of the mean,
where all but 1e-30 of the mass lies; weights follow from each other by one ratio.

All of it is DataFrame functions.  Blocks are the input's partitions, which the scan
keeps even, and a shard is permuted in buckets of bounded size, so a hot key or a few
shards never put many rows in one task.

Nulls take part like other values.  Repeated rows are rows of their own.  Rows fewer than
shards leave some shards empty; an empty table gives an empty result.  New columns
replace those of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.llm.common import free_name, freeze, uniform

FAN_OUT = 16
#: Rows that one task numbers at most, on average.
BUCKET_ROWS = 1 << 19


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` items out of ``total`` are among the ``good`` ones, by inversion at u."""
    least = F.greatest(F.lit(0).cast("long"), drawn - (total - good))
    most = F.least(good, drawn)
    share = good.cast("double") / F.greatest(total, F.lit(1))
    mean = drawn * share
    spread = F.sqrt(
        mean * (1 - share) * (total - drawn) / F.greatest(total - 1, F.lit(1))
    )
    low = F.greatest(least, F.floor(mean - 12 * spread - 12).cast("long"))
    high = F.least(most, F.ceil(mean + 12 * spread + 12).cast("long"))
    places = F.sequence(low, high)

    def onward(weight: Column, k: Column) -> Column:
        up = (good - k).cast("double") * (drawn - k)
        return weight * up / ((k + 1).cast("double") * (total - good - drawn + k + 1))

    mass = F.aggregate(
        places,
        F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")),
        lambda s, k: F.struct(onward(s["w"], k).alias("w"), (s["sum"] + s["w"]).alias("sum")),
        lambda s: s["sum"],
    )
    below = F.aggregate(
        places,
        F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n"), (u * mass).alias("at")),
        lambda s, k: F.struct(
            onward(s["w"], k).alias("w"),
            (s["sum"] + s["w"]).alias("sum"),
            (s["n"] + (s["sum"] + s["w"] < s["at"]).cast("long")).alias("n"),
            s["at"].alias("at"),
        ),
        lambda s: s["n"],
    )
    return F.least(low + below, high)


def drawn_counts(counts: Column, drawn: Column, *key: Column) -> Column:
    """Array: how many of ``drawn`` rows fall to each shard that has ``counts`` places left."""
    zero = F.lit(0).cast("long")
    everything = F.aggregate(counts, zero, lambda s, c: s + c)
    return F.aggregate(
        F.transform(counts, lambda c, i: F.struct(c.alias("good"), i.alias("i"))),
        F.struct(
            everything.alias("total"), drawn.alias("left"), F.array().cast("array<bigint>").alias("out")
        ),
        lambda s, c: _take(s, c["good"], hypergeometric(s["total"], c["good"], s["left"], uniform(*key, c["i"]))),
        lambda s: s["out"],
    )


def _take(state: Column, good: Column, x: Column) -> Column:
    # One array holds the draw, so that it is computed once.
    return F.element_at(
        F.transform(
            F.array(x),
            lambda n: F.struct(
                (state["total"] - good).alias("total"),
                (state["left"] - n).alias("left"),
                F.concat(state["out"], F.array(n)).alias("out"),
            ),
        ),
        1,
    )


def communication_matrix(blocks: DataFrame, shard_sizes: list[int], seed: int) -> DataFrame:
    """(block, counts): how many rows of a block go to each shard.

    ``blocks`` has (block, n) with block numbers from 0; the sizes of blocks and of
    shards have the same sum.
    """
    spark = blocks.sparkSession
    n_blocks = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    levels = max(1, math.ceil(math.log(n_blocks, FAN_OUT) - 1e-9)) if n_blocks > 1 else 0
    matrix = spark.range(1).select(
        F.col("id").alias("node"), F.array(*[F.lit(n).cast("long") for n in shard_sizes]).alias("counts")
    )
    for level in range(1, levels + 1):
        below = FAN_OUT ** (levels - level)
        children = (
            blocks.groupBy(F.floor(F.col("block") / below).cast("long").alias("child"))
            .agg(F.sum("n").cast("long").alias("n"))
            .groupBy(F.floor(F.col("child") / FAN_OUT).cast("long").alias("node"))
            # FAN_OUT children at most.
            .agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("children"))
        )
        empty = F.array().cast("array<struct<child:bigint,counts:array<bigint>>>")
        dealt = F.aggregate(
            "children",
            F.struct(F.col("counts").alias("rest"), empty.alias("out")),
            lambda s, c: F.element_at(
                F.transform(
                    F.array(drawn_counts(s["rest"], c["n"], F.lit(seed), F.lit(level), c["child"])),  # noqa: B023
                    lambda a: F.struct(
                        F.zip_with(s["rest"], a, lambda x, y: x - y).alias("rest"),
                        F.concat(
                            s["out"], F.array(F.struct(c["child"].alias("child"), a.alias("counts")))
                        ).alias("out"),
                    ),
                ),
                1,
            ),
            lambda s: s["out"],
        )
        matrix = (
            matrix.join(children, "node")
            .select(F.explode(dealt).alias("c"))
            .select(F.col("c.child").alias("node"), F.col("c.counts").alias("counts"))
        )
    return matrix.select(F.col("node").alias("block"), "counts")


def near_equal(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """``docs`` with shard (0 to ``shards`` - 1) and slot, the row's place in its shard.

    Shard sizes differ by one at most.  The given columns are written once, so that a
    row keeps its block and number; pass ids and digests, or texts if shards need them.
    """
    docs = docs.drop("shard", "slot")
    names = ("block", "row", "_at", "_block", "_ends", "_bucket", "_before", "_within")
    block, row, at, of_block, ends_of, bucket_of, before, within = (free_name(docs, n) for n in names)
    rows = freeze(
        docs.withColumns({block: F.spark_partition_id().cast("long"), row: F.monotonically_increasing_id()})
    )
    blocks = freeze(rows.groupBy(F.col(block).alias("block")).agg(F.count(F.lit(1)).alias("n")))
    total = blocks.agg(F.sum("n")).first()[0] or 0
    matrix = communication_matrix(blocks, near_equal(total, shards), seed)
    first = F.lit(0).cast("long")
    ends = freeze(
        matrix.select(
            F.col("block").alias(of_block),
            F.transform(
                "counts",
                lambda c, i: F.aggregate(F.slice("counts", F.lit(1), i + 1), first, lambda s, x: s + x),
            ).alias(ends_of),
        )
    )

    def permuted(stage: int, *by: str) -> Column:
        order = F.xxhash64(F.lit(seed), F.lit(stage), F.col(row))
        return F.row_number().over(Window.partitionBy(*by).orderBy(order, row)).cast("long") - 1

    local = rows.withColumn(at, permuted(-1, block))
    placed = (
        local.join(ends, local[block] == ends[of_block])
        .withColumn("shard", F.size(F.filter(ends_of, lambda end: end <= F.col(at))))
        .drop(at, of_block, ends_of)
    )
    bits = max(0, math.ceil(math.log2(max(1, total / shards / BUCKET_ROWS))))
    order = F.xxhash64(F.lit(seed), F.lit(-2), F.col(row))
    bucket = F.shiftrightunsigned(order, 64 - bits) if bits else F.lit(0).cast("long")
    placed = placed.withColumn(bucket_of, bucket)
    earlier = Window.partitionBy("shard").orderBy(bucket_of).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", bucket_of)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", bucket_of, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(before))
    )
    return (
        placed.withColumn(within, permuted(-2, "shard", bucket_of))
        .join(offsets, ["shard", bucket_of])
        .withColumn("slot", (F.col(before) + F.col(within)).cast("long"))
        .select(*docs.columns, "shard", "slot")
    )
