"""The fact kept up to date as files are added to its inputs.

A kept fact is a folder of generations; each update writes one and touches no other:

* ``cells``: order cells of the new lines, partitioned by period; lines that wait for their
  order or part lie under the period ``pending`` and are tried again by the next update;
* ``first``: first dates of the new orders by customer and channel; the least over all
  generations is the first touch;
* ``fact``: the periods that the update changed, written whole;
* ``inputs``: the files that the kept fact covers.

An update reads the new files, the key columns of orders that its lines may belong to, the
kept first touches, and the cells of the periods it changes; old lines are never read again.
A period changes if it gets a line or an order of it, or if a late order moves a customer's
first touch forward, so that the old first date is no longer the customer's first.

``commits/<n>`` lists, for each period, the generation that holds it.  It is written last and
counts once it is complete, so readers see an update whole or not at all, and a failed one
leaves folders that nobody reads.  One writer at a time.  Order and part keys are unique.

The fact is built in full, into a new generation, where increments cannot be exact: on the
first update, after a file was removed or replaced, when an added order or part has a key seen
before, or when ``period`` differs from that of the last commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paidmedia.functions.bloom import semi_join
from paidmedia.functions.joins import shuffled
from paidmedia.sources import schema
from paidmedia.sources.fact import (
    code_of,
    creatives,
    first_touches,
    line_values,
    order_touches,
    sums,
    text_of,
    with_measures,
    with_returning,
)
from paidmedia.sources.store import _hadoop, materialise

INPUTS = ("orders", "lineitem", "part")
MONTHS = "yyyy-MM"
DAYS = "yyyy-MM-dd"
#: Where cells wait for their order or part, and where orders without a date belong.
PENDING = "pending"
UNDATED = "undated"


class Update(NamedTuple):
    #: Number of the commit that is current now.
    commit: int
    #: Whether everything was built anew.
    full: bool
    #: Periods written, in order.
    periods: list[str]


class _Commit(NamedTuple):
    number: int
    unit: str | None
    #: Generations whose cells and first touches count, the newest last.
    generations: list[str]
    #: Generation that holds each period of the fact.
    held: dict[str, str]


def input_files(spark: SparkSession, folder: str) -> DataFrame:
    """(input, path, modificationTime, length) of every input file; no content is read."""
    found = None
    for name in INPUTS:
        listed = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(f"{folder}/{name}.parquet")
            .select(F.lit(name).alias("input"), "path", "modificationTime", "length")
        )
        found = listed if found is None else found.unionByName(listed)
    return found


def _last_commit(spark: SparkSession, path: str) -> _Commit:
    where, files = _hadoop(spark, f"{path}/commits/*/_SUCCESS")
    numbers = [int(s.getPath().getParent().getName()) for s in files.globStatus(where) or []]
    if not numbers:
        return _Commit(0, None, [], {})
    number = max(numbers)
    # As many rows as the calendar has periods and the fact has updates since a full build.
    rows = spark.read.parquet(f"{path}/commits/{number}").orderBy("place").collect()
    return _Commit(
        number,
        next(r["name"] for r in rows if r["kind"] == "unit"),
        [r["generation"] for r in rows if r["kind"] == "cells"],
        {r["name"]: r["generation"] for r in rows if r["kind"] == "fact"},
    )


def _next_number(spark: SparkSession, path: str) -> int:
    """After every commit, those that failed half-way included."""
    where, files = _hadoop(spark, f"{path}/commits/*")
    return 1 + max((int(s.getPath().getName()) for s in files.globStatus(where) or []), default=0)


def _write_commit(spark: SparkSession, path: str, commit: _Commit) -> None:
    rows = [("unit", commit.unit, None)]
    rows += [("cells", None, g) for g in commit.generations]
    rows += [("fact", name, g) for name, g in sorted(commit.held.items())]
    numbered = [(place, *row) for place, row in enumerate(rows)]
    spark.createDataFrame(numbered, "place int, kind string, name string, generation string").coalesce(
        1
    ).write.parquet(f"{path}/commits/{commit.number}")


def _period(date: Column, unit: str) -> Column:
    return F.coalesce(F.date_format(date, unit), F.lit(UNDATED))


def _kept(spark: SparkSession, path: str, table: str, kind: str, generations: Sequence[str]) -> DataFrame:
    """A kept table, of the given generations."""
    return (
        spark.read.schema(kind)
        .option("basePath", f"{path}/{table}")
        .parquet(*[f"{path}/{table}/generation={g}" for g in generations])
        .drop("generation")
    )


_CELLS = (
    "l_orderkey long, l_partkey long, o_orderkey long, o_custkey long, date date, channel string, "
    "campaign_type string, creative_type string, units long, price_e2 decimal(24,0), "
    "discount_e4 decimal(28,0), generation string, period string"
)
_FIRST = "o_custkey long, channel string, first_date date, generation string"


#: Columns that are shuffled as codes.
_LISTED = {"campaign_type": schema.CAMPAIGN_TYPES, "creative_type": schema.CREATIVE_TYPES}


def _codes(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: code_of(F.col(c), _LISTED[c]) for c in rows.columns if c in _LISTED})


def _cells(lines: DataFrame, waiting: DataFrame | None, parts: DataFrame, orders: DataFrame, unit: str, full: bool):
    """Cells of the new lines and of those that waited, each under its period or ``pending``.

    A line of a null order or part never finds one and is no cell.  Campaign and creative are
    codes, which ``_texts`` turns back.
    """
    new = line_values(lines).where(F.col("l_orderkey").isNotNull() & F.col("l_partkey").isNotNull())
    if waiting is not None:
        new = new.unionByName(waiting.where(F.col("creative_type").isNull()).select(*new.columns))
    joined = _codes(new).join(shuffled(_codes(creatives(parts))), "l_partkey", "left")
    known = joined.where(F.col("creative_type").isNotNull()).drop("l_partkey")
    if waiting is not None:
        tried = _codes(waiting.where(F.col("creative_type").isNotNull()))
        known = known.unionByName(tried.select(*known.columns))
    # One shuffle by order serves the sums and the join with orders.
    per_order = known.repartition("l_orderkey").groupBy("l_orderkey", "campaign_type", "creative_type").agg(*sums())
    touches = order_touches(orders)
    if not full:
        # Few of all orders get new lines: the others go before the shuffle.
        per_order = materialise(per_order, "order-cells")
        wanted = per_order.select(F.col("l_orderkey").alias("o_orderkey"))
        touches = semi_join(touches, wanted, ["o_orderkey"])
    met = per_order.join(shuffled(touches), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    no_part = (
        joined.where(F.col("creative_type").isNull())
        .groupBy("l_orderkey", "l_partkey", "campaign_type")
        .agg(*sums())
    )
    placed = F.when(F.col("o_orderkey").isNull(), F.lit(PENDING)).otherwise(_period(F.col("date"), unit))
    rows = met.withColumn("period", placed).unionByName(
        no_part.withColumn("period", F.lit(PENDING)), allowMissingColumns=True
    )
    return rows


def _texts(rows: DataFrame) -> DataFrame:
    """Cells as they are kept."""
    kinds = dict(field.split() for field in _CELLS.split(", "))
    texts = rows.withColumns({c: text_of(F.col(c), values) for c, values in _LISTED.items()})
    return texts.select(*[F.col(c).cast(kinds[c]).alias(c) for c in kinds if c != "generation"])


#: Bits of a mask of campaigns and creatives: a creative's place within that of its campaign,
#: and a last campaign for null.
_WIDTH = len(schema.CREATIVE_TYPES)
_BITS = _WIDTH * (len(schema.CAMPAIGN_TYPES) + 1)


def _masks(rows: DataFrame, *keys: str) -> DataFrame:
    """The campaigns and creatives of each key, as a mask."""
    return rows.groupBy(*keys).agg(F.bit_or("mask").alias("mask"))


def _unmasked(rows: DataFrame, *extra: str) -> DataFrame:
    """A row for each campaign and creative of a mask."""
    places = F.filter(F.sequence(F.lit(0), F.lit(_BITS - 1)), lambda k: F.getbit(F.col("mask"), k) == 1)
    each = rows.select("period", "date", "channel", *extra, F.explode(places).alias("place"))
    campaign, creative = F.floor(F.col("place") / _WIDTH), F.col("place") % _WIDTH
    return each.select(
        "period",
        "date",
        "channel",
        *extra,
        text_of(campaign, schema.CAMPAIGN_TYPES).alias("campaign_type"),
        text_of(creative, schema.CREATIVE_TYPES).alias("creative_type"),
    )


def _fact(cells: DataFrame, first: DataFrame, repeated: bool) -> DataFrame:
    """The fact of kept cells and its period; ``repeated`` where an order's cell may lie in
    several generations, which count once.

    Amounts need neither order nor customer and shrink to the grain where they are read.  What
    is distinct travels as one mask of campaigns and creatives: per order where cells repeat,
    and per customer, channel and date, before it meets the first touches.
    """
    grain = ["period", *schema.GRAIN]
    amounts = cells.groupBy(*grain).agg(F.count(F.lit(1)).alias("orders"), *sums())
    coded = _codes(cells)
    place = F.coalesce(F.col("campaign_type"), F.lit(len(schema.CAMPAIGN_TYPES))) * _WIDTH + F.col("creative_type")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))
    masked = coded.select("o_orderkey", "o_custkey", "date", "channel", "period", bit.alias("mask"))
    found = [amounts]
    if repeated:
        masked = _masks(masked, "o_orderkey", "o_custkey", "date", "channel", "period")
        found = [
            amounts.drop("orders"),
            _unmasked(masked).groupBy(*grain).agg(F.count(F.lit(1)).alias("orders")),
        ]
    known = masked.where(F.col("o_custkey").isNotNull() & F.col("date").isNotNull())
    days = _masks(known, "o_custkey", "date", "channel", "period")
    found.append(
        _unmasked(with_returning(days, shuffled(first)), "returning")
        .groupBy(*grain)
        .agg(
            F.count_if(~F.col("returning")).alias("new_customers"),
            F.count_if(F.col("returning")).alias("returning_customers"),
        )
    )
    counts = ["orders", "new_customers", "returning_customers"]
    rows = found[0]
    for other in found[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    whole = rows.groupBy(*grain).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts], *sums())
    return with_measures(whole, "period")


def _repeats(whole: DataFrame, added: DataFrame, key: str) -> bool:
    """Whether a key of ``added`` occurs twice in ``whole``, which includes ``added``."""
    alike = semi_join(whole.select(key), added.select(key), [key])
    return not alike.groupBy(key).count().where("count > 1").isEmpty()


def update_fact(spark: SparkSession, folder: str, path: str, period: str = MONTHS, full: bool = False) -> Update:
    """Bring the fact kept at ``path`` up to date with the inputs in ``folder``.

    ``period`` is the date pattern of the unit that is written whole (``MONTHS``, ``DAYS``).
    ``full`` builds everything anew, which also merges the generations of many updates.
    Nothing is written if no file changed.
    """
    last = _last_commit(spark, path)
    whole = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in INPUTS}
    found = materialise(input_files(spark, folder), "inputs")
    full = full or last.unit != period
    added = dict(whole)
    if not full:
        covered = spark.read.parquet(f"{path}/inputs/generation={last.generations[-1]}")
        full = not covered.join(found, found.columns, "left_anti").isEmpty()
    if not full:
        # Names of the files added since the last update, which the scan of them needs anyhow.
        fresh = found.join(covered, found.columns, "left_anti").select("input", "path").collect()
        if not fresh:
            return Update(last.number, False, [])
        for name in INPUTS:
            paths = [r["path"] for r in fresh if r["input"] == name]
            reader = spark.read.schema(whole[name].schema)
            added[name] = reader.parquet(*paths) if paths else whole[name].where(F.lit(False))
        full = _repeats(whole["orders"], added["orders"], "o_orderkey") or _repeats(
            whole["part"], added["part"], "p_partkey"
        )
    if full:
        added = whole

    generation = uuid.uuid4().hex
    older = [] if full else last.generations
    generations = [*older, generation]
    waiting = None
    if older:
        waiting = _kept(spark, path, "cells", _CELLS, older[-1:]).where(F.col("period") == PENDING)
    cells = _cells(added["lineitem"], waiting, whole["part"], whole["orders"], period, full)
    _texts(cells.hint("rebalance", "period")).write.partitionBy("period").parquet(
        f"{path}/cells/generation={generation}"
    )
    new_first = first_touches(added["orders"])
    new_first.write.parquet(f"{path}/first/generation={generation}")
    found.write.parquet(f"{path}/inputs/generation={generation}")

    # Periods are as many as the calendar has: their names may come to the driver.
    fresh_cells = _kept(spark, path, "cells", _CELLS, [generation])
    changed = fresh_cells.select("period").distinct()
    if older:
        now = _kept(spark, path, "first", _FIRST, [generation])
        before = semi_join(_kept(spark, path, "first", _FIRST, older), now, ["o_custkey"])
        both = before.withColumn("old", F.lit(True)).unionByName(now.withColumn("old", F.lit(False)))
        earliest = both.groupBy("o_custkey", "channel").agg(
            F.min(F.when(F.col("old"), F.col("first_date"))).alias("was"),
            F.min(F.when(~F.col("old"), F.col("first_date"))).alias("is"),
        )
        moved = earliest.where(F.col("is") < F.col("was"))
        changed = changed.union(moved.select(_period(F.col("was"), period))).distinct()
    names = sorted(r["period"] for r in changed.collect() if r["period"] != PENDING)

    first = (
        _kept(spark, path, "first", _FIRST, generations)
        .groupBy("o_custkey", "channel")
        .agg(F.min("first_date").alias("first_date"))
    )
    cells = _kept(spark, path, "cells", _CELLS, generations).where(F.col("period").isin(names))
    # An order that got lines in several updates is one cell again.
    _fact(cells, first, bool(older)).hint("rebalance", "period").sortWithinPartitions(
        "period", *schema.GRAIN
    ).write.partitionBy("period").parquet(f"{path}/fact/generation={generation}")

    # A first touch may have moved in a period whose orders have no line: it has no rows.
    filled = [
        r["period"]
        for r in spark.read.schema("period string")
        .parquet(f"{path}/fact/generation={generation}")
        .distinct()
        .collect()
    ]
    held = ({} if full else last.held) | dict.fromkeys(filled, generation)
    number = _next_number(spark, path)
    _write_commit(spark, path, _Commit(number, period, generations, held))
    return Update(number, full, names)


def kept_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact at ``path`` as of its last complete update."""
    last = _last_commit(spark, path)
    if not last.number:
        raise FileNotFoundError(f"no complete update in {path}")
    reader = spark.read.schema(schema.FACT)
    if not last.held:
        return spark.createDataFrame([], schema.FACT)
    return reader.parquet(*[f"{path}/fact/generation={g}/period={p}" for p, g in sorted(last.held.items())])
