"""Joins with tables that grow with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of an equi-join that is shuffled and never broadcast.

    Spark takes a table for as large as its compressed files, cut to the columns read, and
    broadcasts it below a limit.  Millions of rows of a key and a code are below the default
    limit, and many times as large in the driver's memory, which builds them.
    """
    return df.hint("merge")
