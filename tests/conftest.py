from __future__ import annotations

import datetime
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from paidmedia.sources import schema  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("paidmedia-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_fact(spark):
    """A fact DataFrame from partial rows; measures default to harmless values."""

    def make(*rows: dict):
        base = {
            "date": "2022-01-03",
            "channel": "Meta",
            "campaign_type": "Prospecting",
            "creative_type": "UGC_Review",
            "impressions": 1000,
            "clicks": 100,
            "spend_gbp": 100,
            "orders": 10,
            "revenue_gbp": 300,
            "new_customers": 4,
            "returning_customers": 6,
            "avg_order_value_gbp": 30,
        }
        out = []
        for row in rows:
            full = {**base, **row}
            full["date"] = datetime.date.fromisoformat(full["date"])
            for c in ("spend_gbp", "revenue_gbp", "avg_order_value_gbp"):
                full[c] = Decimal(str(full[c]))
            out.append(tuple(full[c] for c in schema.FACT.fieldNames()))
        return spark.createDataFrame(out, schema.FACT)

    return make


@pytest.fixture
def rows():
    """Collected rows as dictionaries, keyed by the given columns."""

    def collect(df, *keys):
        got = [r.asDict() for r in df.collect()]
        if not keys:
            return got
        return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in got}

    return collect


def plan_of(df) -> str:
    """The formatted physical plan, which does not shorten filters and schemas."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
