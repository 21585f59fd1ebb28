"""Boilerplate against counting by hand, and against SQL on whole tables."""

from collections import Counter, defaultdict

import parity
import pytest
from conftest import DATA, plan_of

from paidmedia.llm import line_dedup, queries


def brute(rows, ratio, min_pages):
    pages, seen = Counter(), defaultdict(Counter)
    for host, text in rows:
        if host is not None and text is not None:
            pages[host] += 1
            seen[host].update({line.strip(" \t\r") for line in text.split("\n")} - {""})
    out = []
    for host, text in rows:
        if text is None:
            out.append((host, None, None, 0))
            continue
        gone = {x for x, n in seen[host].items() if n >= min_pages and n > ratio * pages[host]} if host else set()
        lines = text.split("\n")
        kept = [line for line in lines if line.strip(" \t\r") not in gone]
        out.append((host, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    """A hot host, a common line, repeated rows, empty and long texts."""
    out = []
    for i in range(200):
        host = "hot" if i % 3 == 0 else f"h{i % 7}"
        lines = [f"line {i % 11}", f"only {i}", "", "  menu \r" if i % 2 else "menu", "menu"]
        out.append((host, "\n".join(lines[: i % 6])))
    out += [("hot", None), (None, "menu\nx"), ("new", "menu"), ("hot", ""), ("hot", "\n\n"), ("hot", "y\n" * 20_000)]
    out += [("copy", "all\nthe same")] * 30
    return out


@pytest.mark.parametrize("broadcast", [line_dedup.BROADCAST_BYTES, 0], ids=["broadcast", "join"])
@pytest.mark.parametrize("ratio, min_pages", [(0.1, 3), (0.5, 1), (0.0, 1000)])
def test_same_as_brute_force(spark, rows, ratio, min_pages, broadcast, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", broadcast)
    docs = spark.createDataFrame([(h, t, 5) for h, t in rows], "source string, text string, bp_keys int").repartition(4)
    got = line_dedup.drop_boilerplate(docs, ratio=ratio, min_pages=min_pages)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert Counter((r[0], r[1], r[3], r[4]) for r in got.collect()) == brute(rows, ratio, min_pages)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "source string, text string")
    assert line_dedup.drop_boilerplate(docs).count() == 0


def test_query_same_as_sql(spark):
    folder = f"{DATA}/sf0.01"
    df = queries.op9_line_dedup(spark, folder)
    assert "Python" not in plan_of(df) and "Arrow" not in plan_of(df)
    assert parity.compare(df, parity.connect(folder), queries.oracle_sql()["op9_line_dedup"]) is None
