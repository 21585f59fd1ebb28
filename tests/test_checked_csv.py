"""Bad rows of a CSV are set aside with their reasons; the good ones load as they are."""

import datetime
import os
from decimal import Decimal

import pytest
from pyspark.sql.types import DateType, DecimalType, LongType, StringType, StructField, StructType

from paidmedia.sources import files

COLUMNS = StructType(
    [
        StructField("day", DateType()),
        StructField("name", StringType()),
        StructField("n", LongType()),
        StructField("money", DecimalType(6, 2)),
    ]
)
HEADER = "name,day,extra,n,money"


def write(folder, **named):
    for name, lines in named.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as out:
            out.write("\n".join([HEADER, *lines]) + "\n")
    return str(folder)


def test_reasons_lines_and_counts(spark, tmp_path):
    path = write(
        tmp_path,
        one=[
            "a,2024-01-02,x,5,1.50",
            "b,2024-13-02,x,5,1.50",
            "h,2024-01-02 noon,x,5,1.50",
            '"c, d",2024-01-03,,7,',
            "e,2024-01-04,x,five,12345.00",
            "f,2024-01-05,x,5",
            "",
        ],
        two=["g,2024-01-06,x,5,1.5,more", ",,,,", "a,2024-01-02,x,5,1.50"],
    )
    checked = files.load_csv_checked(spark, path, COLUMNS)
    good = sorted(map(tuple, checked.good.collect()), key=str)
    day = datetime.date
    assert good == sorted(
        [
            (day(2024, 1, 2), "a", 5, Decimal("1.50")),
            (day(2024, 1, 2), "a", 5, Decimal("1.50")),
            (day(2024, 1, 3), "c, d", 7, None),
            (None, None, None, None),
        ],
        key=str,
    )
    bad = {(os.path.basename(r["file"]), r["line"]): r["reason"] for r in checked.bad.collect()}
    assert bad == {
        ("one.csv", "b,2024-13-02,x,5,1.50"): "day: no date",
        ("one.csv", "h,2024-01-02 noon,x,5,1.50"): "day: no date",
        ("one.csv", "e,2024-01-04,x,five,12345.00"): "n: no bigint; money: no decimal(6,2)",
        ("one.csv", "f,2024-01-05,x,5"): "number of fields",
        ("two.csv", "g,2024-01-06,x,5,1.5,more"): "number of fields",
    }
    counts = {os.path.basename(r["file"]): (r["good_rows"], r["bad_rows"]) for r in checked.counts.collect()}
    assert counts == {"one.csv": (2, 4), "two.csv": (2, 1)}


def test_good_rows_do_not_depend_on_the_columns_selected(spark, tmp_path):
    path = write(tmp_path, one=["a,2024-01-02,x,5,1.50", "b,2024-01-02,x,5,much", "c,2024-01-02,x,5"])
    good = files.load_csv_checked(spark, path, COLUMNS).good
    assert [r["name"] for r in good.select("name").collect()] == ["a"]
    assert good.select("day").count() == good.count() == 1


def test_a_clean_file_loads_like_load_csv(spark, tmp_path):
    path = write(tmp_path, one=["a,2024-01-02,x,5,1.50", "b,2024-01-03,,-6,0"], two=["c,2024-01-04,,,"])
    checked = files.load_csv_checked(spark, path, COLUMNS)
    plain = files.load_csv(spark, path, COLUMNS)
    assert checked.good.schema == plain.schema
    assert sorted(checked.good.collect()) == sorted(plain.collect())
    assert checked.bad.count() == 0


def test_a_column_named_like_the_corrupt_one(spark, tmp_path):
    with open(tmp_path / "one.csv", "w") as out:
        out.write(f"{HEADER},_corrupt_line\na,2024-01-02,x,5,1.50,\nb,2024-01-02,x,5,1.50\n")
    checked = files.load_csv_checked(spark, str(tmp_path), COLUMNS)
    assert [r["name"] for r in checked.good.collect()] == ["a"]
    assert [r["reason"] for r in checked.bad.collect()] == ["number of fields"]


def test_missing_column_and_empty_file(spark, tmp_path):
    path = write(tmp_path, one=[])
    checked = files.load_csv_checked(spark, path, COLUMNS)
    assert checked.good.count() == checked.bad.count() == checked.counts.count() == 0
    with pytest.raises(ValueError, match="no column other"):
        files.load_csv_checked(spark, path, StructType([StructField("other", LongType())]))
