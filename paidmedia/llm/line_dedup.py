"""Boilerplate lines by their frequency within a site.

For each host, the pages that contain a line are divided by the host's pages; a line
above the boilerplate ratio is dropped from every page of that host.  One scan explodes
the distinct line hashes of each page (two 64-bit hashes, so that different lines do not
meet), with one extra row per page that counts the host's pages; counts are combined
before the shuffle, so a hot host or line sends few rows.

A host's boilerplate has at most (lines per page / ratio) lines.  It is joined to the
pages as one array per host: broadcast if the measured size of all arrays is below
``BROADCAST_BYTES``, else by a join that adaptive execution can split at a hot host.

Lines are compared without spaces, tabs and carriage returns at their ends.  Blank lines
always stay.  A null text stays null and is no page of its host; rows with a null host
stay as they are.  A page of boilerplate alone becomes an empty text.  Repeated rows are
pages of their own.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidmedia.llm.common import free_name, freeze

RATIO = 0.1
MIN_PAGES = 3
BROADCAST_BYTES = 32 << 20


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def line_key(line: Column) -> Column:
    bare = trimmed(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b"))


def boilerplate(
    docs: DataFrame, host: str, text: str, ratio: float, min_pages: int
) -> DataFrame:
    """(host, keys): the hashes of each host's boilerplate lines."""
    named = F.filter(lines_of(F.col(text)), lambda line: trimmed(line) != "")
    none = F.lit(None).cast("struct<a:bigint,b:bigint>")
    keys = F.concat(F.array(none), F.array_distinct(F.transform(named, line_key)))
    counts = freeze(
        docs.where(F.col(text).isNotNull() & F.col(host).isNotNull())
        .select(F.col(host).alias("host"), F.explode(keys).alias("key"))
        .groupBy("host", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") >= min_pages) | F.col("key").isNull())
    )
    pages = counts.where("key is null").select("host", F.col("n").alias("pages"))
    return (
        counts.where("key is not null")
        .join(pages, "host")
        .where(F.col("n") > F.lit(ratio) * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("key").alias("keys"))
    )


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and n_lines and n_dropped.

    A line is boilerplate on a host where ``min_pages`` pages or more, and more than
    ``ratio`` of its pages, contain it.  n_lines is null for a null text.
    """
    docs = docs.drop("n_lines", "n_dropped")
    found = freeze(boilerplate(docs, host, text, ratio, min_pages))
    n_keys = found.agg(F.sum(F.size("keys") + 4)).first()[0] or 0
    at, keys = free_name(docs, "bp_host"), free_name(docs, "bp_keys")
    small = found.select(F.col("host").alias(at), F.col("keys").alias(keys))
    if n_keys * 32 <= BROADCAST_BYTES:
        small = F.broadcast(small)
    lines = lines_of(F.col(text))
    kept = F.filter(lines, lambda line: (trimmed(line) == "") | ~F.array_contains(F.col(keys), line_key(line)))
    joined = docs.join(small, docs[host] == F.col(at), "left")
    has = F.col(keys).isNotNull() & F.col(text).isNotNull()
    cut = free_name(joined, "bp_kept")
    return (
        joined.withColumn(cut, F.when(has, kept))
        .withColumn("n_lines", F.when(F.col(text).isNotNull(), F.size(lines)))
        .withColumn("n_dropped", F.when(has, F.size(lines) - F.size(cut)).otherwise(F.lit(0)))
        .withColumn(text, F.when(F.col("n_dropped") > 0, F.array_join(cut, "\n")).otherwise(F.col(text)))
        .select(*docs.columns, "n_lines", "n_dropped")
    )
