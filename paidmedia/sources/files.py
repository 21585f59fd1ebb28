"""Readers and writers of the fact table in its raw and enriched forms."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from paidmedia.sources import schema


def _header(spark: SparkSession, path: str, columns: StructType) -> list[str]:
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in columns.fieldNames() if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return header


def load_csv(spark: SparkSession, path: str, columns: StructType = schema.FACT) -> DataFrame:
    """CSV with a header, read by name; types are declared, never inferred.

    Columns may come in any order, and others are ignored.  A missing column is an error,
    and so is a file whose header differs from that of the first.
    """
    header = _header(spark, path, columns)
    kinds = {f.name: f for f in columns.fields}
    found = StructType([kinds.get(c, StructField(c, StringType(), True)) for c in header])
    return (
        spark.read.schema(found)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
        .select(*columns.fieldNames())
    )


class CheckedCsv(NamedTuple):
    #: The rows that every declared column could be read from.
    good: DataFrame
    #: (file, line, reason) of the others.
    bad: DataFrame
    #: (file, good_rows, bad_rows) of every file with rows.
    counts: DataFrame


def load_csv_checked(spark: SparkSession, path: str, columns: StructType = schema.FACT) -> CheckedCsv:
    """Like ``load_csv``, but bad rows are set aside with their reasons and stop nothing.

    A row is bad if its number of fields is not the header's, or a declared column holds
    text that is no value of its type; an empty field is null.  All declared columns are
    judged whichever of them are selected later, so every use sees the same good rows.
    ``line`` is the record as read, or its fields written again where only a type was wrong.
    A missing column or a file with another header is an error, as in ``load_csv``.
    """
    header = _header(spark, path, columns)
    corrupt = "_corrupt_line"
    while corrupt in header:
        corrupt = f"_{corrupt}"
    fields = StructType([StructField(c, StringType(), True) for c in [*header, corrupt]])
    lines = (
        spark.read.schema(fields)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        # With pruned columns the reader would not count a record's fields.
        .option("columnPruning", False)
        .csv(path)
    )
    cut = F.col(corrupt).isNotNull()

    def value(field: StructField) -> Column:
        text = F.col(f"`{field.name}`")
        # A cast would read a date off the front of a longer text.
        return F.try_to_date(text, "yyyy-MM-dd") if field.dataType == DateType() else text.try_cast(field.dataType)

    read = {f.name: value(f) for f in columns.fields}
    wrong = [
        F.when(
            ~cut & F.col(f"`{f.name}`").isNotNull() & read[f.name].isNull(),
            F.lit(f"{f.name}: no {f.dataType.simpleString()}"),
        )
        for f in columns.fields
    ]
    reason = F.concat_ws("; ", F.when(cut, F.lit("number of fields")), *wrong)
    line = F.coalesce(F.col(corrupt), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in header])))
    file = F.col("_metadata.file_path").alias("file")
    return CheckedCsv(
        lines.where(reason == "").select(*[c.alias(name) for name, c in read.items()]),
        lines.where(reason != "").select(file, line.alias("line"), reason.alias("reason")),
        lines.select(file, reason.alias("reason"))
        .groupBy("file")
        .agg(
            F.count_if(F.col("reason") == "").alias("good_rows"),
            F.count_if(F.col("reason") != "").alias("bad_rows"),
        ),
    )


def load_parquet(spark: SparkSession, path: str, columns: StructType = schema.FACT) -> DataFrame:
    return spark.read.schema(columns).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_enriched(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet partitioned by year and month, so that date filters prune directories.

    Rows are rebalanced by month first: one writer per directory where months are
    small, and several where adaptive execution finds a month too large for one.
    """
    (
        df.hint("rebalance", "year", "month")
        .write.mode(mode)
        .partitionBy("year", "month")
        .parquet(path)
    )


def load_enriched(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.schema(schema.ENRICHED).parquet(path)
    return read.select(*schema.ENRICHED.fieldNames())


def apply_filters(
    fact: DataFrame,
    start_date: str,
    end_date: str,
    channels: Sequence[str],
    campaign_types: Sequence[str],
    creative_types: Sequence[str],
) -> DataFrame:
    """Inclusive date range and three membership tests, all pushed to the scan."""
    for name, chosen in (
        ("channels", channels),
        ("campaign_types", campaign_types),
        ("creative_types", creative_types),
    ):
        if not chosen:
            raise ValueError(f"select at least one of {name}")
    return fact.filter(
        F.col("date").between(F.lit(start_date).cast("date"), F.lit(end_date).cast("date"))
        & F.col("channel").isin(list(channels))
        & F.col("campaign_type").isin(list(campaign_types))
        & F.col("creative_type").isin(list(creative_types))
    )
