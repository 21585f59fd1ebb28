"""A kept fact equals a full build after every update, and writes only what changed."""

import datetime
import shutil

import pytest
from conftest import DATA, plan_of

from paidmedia.sources import fact, increment, schema
from paidmedia.sources.store import materialise

ORDERS = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"
LINES = (
    "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, "
    "l_discount double, l_returnflag string"
)
PARTS = "p_partkey long, p_type string"


def order(key, customer, month, day, priority="2-HIGH"):
    return key, customer, month and datetime.datetime(1996, month, day), priority


def line(key, part=1, quantity=2.0, flag="A"):
    return key, part, quantity, 10.5, 0.04, flag


class Kept:
    def __init__(self, spark, tmp_path, period=increment.MONTHS):
        self.spark, self.folder, self.path, self.period = spark, str(tmp_path / "in"), str(tmp_path / "kept"), period

    def add(self, orders=(), lines=(), parts=()):
        for name, rows, kind in (("orders", orders, ORDERS), ("lineitem", lines, LINES), ("part", parts, PARTS)):
            self.spark.createDataFrame(list(rows), kind).coalesce(1).write.mode("append").parquet(
                f"{self.folder}/{name}.parquet"
            )

    def update(self, **options):
        return increment.update_fact(self.spark, self.folder, self.path, self.period, **options)

    def check(self):
        whole = fact.build_fact(*(fact.raw(self.spark, self.folder, t) for t in ("orders", "lineitem", "part")))
        got = sorted(map(str, increment.kept_fact(self.spark, self.path).collect()))
        assert got == sorted(map(str, whole.select(*schema.FACT.fieldNames()).collect()))
        return got


@pytest.fixture
def kept(spark, tmp_path):
    table = Kept(spark, tmp_path)
    table.add(
        [order(1, 7, 1, 5), order(2, 7, 2, 5), order(3, 8, 3, 9), order(4, None, 3, 9, None), order(5, 9, 4, 1)],
        [line(1), line(1, flag="N"), line(2), line(3), line(4), line(99), line(3, part=50), line(None), line(3, part=None)],
        [(1, "PROMO"), (2, None)],
    )
    assert table.update() == (1, True, ["1996-01", "1996-02", "1996-03"])
    table.check()
    return table


def test_new_orders_write_their_period_only(kept):
    kept.add([order(10, 8, 5, 2), order(11, 20, 5, 3)], [line(10), line(11), line(11)])
    assert kept.update() == (2, False, ["1996-05"])
    assert len(kept.check()) == 7
    assert kept.update() == (2, False, [])


def test_lines_of_old_orders_join_the_cells_kept(kept):
    kept.add(lines=[line(1), line(2, flag="R"), line(2, quantity=5.0)])
    assert kept.update() == (2, False, ["1996-01", "1996-02"])
    kept.check()


def test_late_orders_move_first_touches(kept):
    """Customer 7 came in January; an order of last December of the same channel comes late."""
    kept.add([(12, 7, datetime.datetime(1995, 12, 30), "2-HIGH")], [line(12)])
    assert kept.update() == (2, False, ["1995-12", "1996-01"])
    kept.check()
    kept.add([(13, 8, datetime.datetime(1995, 12, 30), "3-MEDIUM")], [line(13)])
    assert kept.update().periods == ["1995-12"]
    kept.check()


def test_a_first_touch_without_lines_moves_too(kept):
    kept.add([order(14, 9, 1, 2)])
    # Order 5 of customer 9 has no line, so its period has no rows; no other changes.
    assert kept.update() == (2, False, ["1996-04"])
    kept.check()
    kept.add(lines=[line(5)])
    assert kept.update().periods == ["1996-04"]
    kept.check()


def test_lines_wait_for_their_order_and_part(kept):
    kept.add([order(99, 30, 6, 1)])
    assert kept.update().periods == ["1996-06"]
    kept.check()
    kept.add([order(98, 30, None, 1)], [line(98)], [(50, "ECONOMY")])
    assert kept.update().periods == ["1996-03", increment.UNDATED]
    kept.check()


def test_a_key_seen_before_and_a_removed_file_rebuild(kept, tmp_path):
    kept.add([order(1, 7, 7, 5)])
    assert kept.update().full
    kept.check()
    for part in (tmp_path / "in" / "lineitem.parquet").glob("part-*"):
        gone = part
    shutil.copy(gone, f"{gone}.copy")
    gone.unlink()
    assert kept.update().full
    kept.check()


def test_days_and_a_failed_update(spark, tmp_path):
    kept = Kept(spark, tmp_path, increment.DAYS)
    kept.add([order(1, 7, 1, 5), order(2, 7, 1, 6)], [line(1), line(2)], [(1, "PROMO")])
    assert kept.update().periods == ["1996-01-05", "1996-01-06"]
    kept.add([order(3, 8, 1, 6)], [line(3)])
    # What an update that died before its commit leaves behind is not read.
    shutil.copytree(next((tmp_path / "kept" / "fact").iterdir()), tmp_path / "kept" / "fact" / "generation=dead")
    shutil.copytree(next((tmp_path / "kept" / "cells").iterdir()), tmp_path / "kept" / "cells" / "generation=dead")
    (tmp_path / "kept" / "commits" / "2" / "_temporary").mkdir(parents=True)
    assert kept.update() == (3, False, ["1996-01-06"])
    kept.check()
    kept.period = increment.MONTHS
    assert kept.update() == (4, True, ["1996-01"])
    kept.check()


def test_empty_inputs(spark, tmp_path):
    kept = Kept(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        increment.kept_fact(spark, kept.path)
    kept.add()
    assert kept.update().periods == []
    assert kept.check() == []


def test_a_hot_customer_and_whole_tables(spark, tmp_path):
    """The given tables in three parts of mixed dates; a third of the orders gets one customer."""
    from pyspark.sql import functions as F

    kept = Kept(spark, tmp_path)
    orders = fact.raw(spark, f"{DATA}/sf0.001", "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey"))
    )
    lines = fact.raw(spark, f"{DATA}/sf0.001", "lineitem")
    fact.raw(spark, f"{DATA}/sf0.001", "part").write.parquet(f"{kept.folder}/part.parquet")
    for third in range(3):
        orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == third).write.mode("append").parquet(
            f"{kept.folder}/orders.parquet"
        )
        # Lines come apart from their orders.
        lines.where(F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == third).write.mode(
            "append"
        ).parquet(f"{kept.folder}/lineitem.parquet")
        assert kept.update().full == (third == 0)
        kept.check()


def test_orders_of_a_day_whose_cells_come_in_several_updates(kept):
    """Two orders of a customer on one day, one without date, lines without campaign, one cell in three parts."""
    kept.add(
        [order(20, 30, 6, 1), order(21, 30, 6, 1), order(22, 30, None, 1), order(23, None, 6, 1), order(24, 30, 8, 4)],
        [line(20), line(21), line(21, part=2), line(22), line(23), line(20, flag="X"), line(24)],
    )
    assert kept.update().periods == ["1996-06", "1996-08", "undated"]
    kept.check()
    for _ in range(2):
        kept.add(lines=[line(20), line(21), line(20, flag="X"), line(22), line(23), line(24, flag="N")])
        kept.update()
        kept.check()


def test_amounts_meet_neither_customers_nor_orders_in_a_shuffle(spark):
    """Before, every cell was shuffled with its amounts by cell, by customer and by both."""
    cells = spark.createDataFrame([], increment._CELLS.replace(", generation string", ""))
    first = spark.createDataFrame([], increment._FIRST)
    plan = plan_of(increment._fact(cells, first, True))
    shuffled = [p for p in plan.split("\n\n") if ") Exchange" in p.split("\n")[0]]
    assert len(shuffled) >= 5
    assert not [p for p in shuffled if "price_e2" in p and ("o_custkey" in p or "o_orderkey" in p)]


def test_only_filters_are_broadcast(kept):
    """Before, parts, orders, keys and first touches went through the driver where their files were small."""
    orders, lines, parts = (fact.raw(kept.spark, kept.folder, t) for t in ("orders", "lineitem", "part"))

    def broadcasts(df):
        return [p for p in plan_of(df).split("\n\n") if ") BroadcastExchange" in p.split("\n")[0]]

    assert not broadcasts(increment._cells(lines, None, parts, orders, increment.MONTHS, True))
    (filtering,) = broadcasts(increment._cells(lines, None, parts, orders, increment.MONTHS, False))
    assert "_words" in filtering
    cells = increment._cells(lines, None, parts, orders, increment.MONTHS, True)
    cells = materialise(increment._texts(cells), "cells")
    first = materialise(fact.first_touches(orders), "first")
    assert not broadcasts(increment._fact(cells, first, True))
