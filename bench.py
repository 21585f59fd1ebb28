"""Time every registered query and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores and
``BENCH_RUNS`` the timed runs per query after one warm-up (the median counts).
``build_fact`` and ``build_journeys_table`` time the two derived tables from the raw
files as a session builds them, partitioned, sorted and written; the other queries scan
those tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paidmedia.plans import catalog  # noqa: E402
from paidmedia.sources.fact import fact_table  # noqa: E402
from paidmedia.sources.store import refresh  # noqa: E402


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("paidmedia-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)

    def fact(spark, folder):
        refresh(spark, f"fact:{folder}")
        return fact_table(spark, folder)

    def journeys(spark, folder):
        refresh(spark, f"numbered:{folder}")
        refresh(spark, f"journeys:{folder}")
        return catalog.journey_table(spark, folder)

    timed = {"build_fact": fact, "build_journeys_table": journeys, **catalog.queries()}
    seconds = {}
    for name, query in timed.items():
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 4)
    print(
        json.dumps(
            {
                "metric": "sum of median warm seconds over all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
