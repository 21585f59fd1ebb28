"""Z-order: keys against plain interleaving, and the files a filter on one column can skip."""

import datetime
import glob

import pyarrow.parquet as pq
import pytest
from conftest import DATA, plan_of
from pyspark.sql import functions as F

from paidmedia.plans import catalog
from paidmedia.sources import fact, files, layout, schema


def test_key_takes_bits_in_turn(spark):
    ranks = [(a, b, c) for a in range(8) for b in range(4) for c in range(2)]
    rows = spark.createDataFrame(ranks, "a long, b long, c long")
    key = layout.interleaved([(F.col("a"), 3), (F.col("b"), 2), (F.col("c"), 1)])
    for r in rows.withColumn("key", key).collect():
        a, b = f"{r['a']:03b}", f"{r['b']:02b}"
        assert f"{r['key']:06b}" == a[0] + b[0] + str(r["c"]) + a[1] + b[1] + a[2]
    with pytest.raises(ValueError):
        layout.interleaved([(F.col("a"), 32), (F.col("b"), 32)])


def test_ranks_rise_with_the_value(spark):
    values = [None, "", "Meta", "Neu", "Organic", "TikTok", "Zeta"]
    rows = spark.createDataFrame([(v,) for v in values], "channel string")
    got = [r[0] for r in rows.select(layout.domain_rank("channel", layout.DOMAINS["channel"])).collect()]
    assert got == [0, 0, 1, 3, 3, 4, 6]
    numbers = spark.createDataFrame([(None,), (-5,), (1,), (2,), (9,)], "x int")
    got = [r[0] for r in numbers.select(layout.quantile_rank(F.col("x"), [1, 2, 2])).collect()]
    assert got == [0, 0, 0, 1, 3]


def groups_read(path, column, value):
    """Row groups whose statistics cannot rule the value out, and all row groups."""
    read = total = 0
    for name in glob.glob(f"{path}/part-*.parquet"):
        meta = pq.ParquetFile(name).metadata
        place = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(place).statistics
            total += 1
            read += stats.min <= value <= stats.max
    return read, total


def test_each_column_alone_prunes(spark, tmp_path):
    table = fact.fact_table(spark, f"{DATA}/sf0.01")
    by_date, by_z = str(tmp_path / "date"), str(tmp_path / "z")
    table.repartitionByRange(256, *schema.GRAIN).sortWithinPartitions(*schema.GRAIN).write.parquet(by_date)
    layout.z_ordered(table, 256).write.parquet(by_z)
    for column, value in (
        ("channel", "TikTok"),
        ("campaign_type", "Prospecting"),
        ("creative_type", "UGC_Review"),
        ("date", datetime.date(1997, 3, 3)),
    ):
        read, total = groups_read(by_z, column, value)
        assert total >= 240 and read <= total * 0.55, (column, read, total)
        if column != "date":
            assert groups_read(by_date, column, value)[0] == groups_read(by_date, column, value)[1]
    assert groups_read(by_z, "channel", "TikTok")[0] <= 256 * 0.35
    kept = spark.read.schema(table.schema).parquet(by_z)
    assert kept.exceptAll(table).isEmpty() and table.exceptAll(kept).isEmpty()


def test_nulls_unknown_values_and_an_empty_table(spark, make_fact, tmp_path):
    table = make_fact({}, {}, {"channel": None}, {"channel": "Radio", "creative_type": None})
    assert layout.z_ordered(table, 3).exceptAll(table).isEmpty()
    assert layout.z_ordered(table, 3).count() == 4
    assert layout.z_ordered(table.where("false")).count() == 0


def test_filter_reaches_the_scan(spark):
    plan = plan_of(catalog.queries()["load_fact_z_ordered"](spark, f"{DATA}/sf0.001"))
    assert "EqualTo(channel,TikTok)" in plan and "Exchange" not in plan
