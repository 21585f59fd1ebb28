"""The trie and the join against a scan of all rules."""

import random

import parity
import pytest
from conftest import DATA

from paidmedia.llm import queries, url_filter

SCHEMA = "page_id long, url string, host string, verdict long"


def locate(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    for c in "?#":
        rest = rest.split(c, 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest


def brute(url, rules, otherwise):
    host, path = locate(url)
    fits = [
        (len(h.split(".")) if h else 0, len(p), v, f"{h}{p}")
        for h, p, v in rules
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, _, verdict, rule = max(fits, default=(0, 0, otherwise, None), key=lambda f: f[:3])
    return host, path, rule, verdict


@pytest.fixture(scope="module")
def urls():
    rng = random.Random(4)
    labels, segments = ["a", "b", "example", "www", "de"], ["en", "es", "1", "12", "x y", ""]
    out = [None, "", "no url", "http://", "https://A.Example.ORG", "ftp://x://y/z", "://a.b/en/1\n2", "http://org/es/"]
    for _ in range(300):
        host = ".".join(rng.choices(labels, k=rng.randrange(1, 4)) + [rng.choice(["org", "COM", "net"])])
        path = "/".join([""] + rng.choices(segments, k=rng.randrange(0, 4)))
        out.append(f"http://{host}{path}{rng.choice(['', '?q=/es/', '#/en/1', '/?'])}")
    return out


RULES = [
    url_filter.RULES,
    [("org", "/", "allow"), ("example.org", "/e", "block"), ("example.org", "/en/", "allow"), ("org", "/en/1", "block"),
     ("a.com", "", "block"), ("com", "/en/1", "allow"), ("com", "/en/1", "block"), ("", "/es", "block"), (None, "/", "block")],
    [],
]


@pytest.mark.parametrize("rules", RULES, ids=["registered", "nested", "none"])
@pytest.mark.parametrize("joined", [False, True], ids=["trie", "join"])
def test_same_as_scanning_the_rules(spark, urls, rules, joined, monkeypatch):
    if joined:
        monkeypatch.setattr(url_filter, "MAX_RULES", -1)
    pages = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(urls * 2)], SCHEMA)
    got = {r["page_id"]: r for r in url_filter.judge(pages, rules, otherwise="block").collect()}
    known = [r for r in rules if None not in r]
    assert len(got) == 2 * len(urls)
    for i, u in enumerate(urls * 2):
        r = got[i]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(u, known, "block"), u


@pytest.mark.parametrize("joined", [False, True], ids=["trie", "join"])
def test_columns_named_like_inner_ones(spark, joined, monkeypatch):
    if joined:
        monkeypatch.setattr(url_filter, "MAX_RULES", -1)
    taken = ["_judged", "judged", "j_host", "j_path", "j_rule", "j_verdict"]
    pages = spark.createDataFrame(
        [(1, "https://a.org/x", *taken), (2, None, *taken)],
        "page_id long, url string, " + ", ".join(f"{n} string" for n in taken),
    )
    got = url_filter.judge(pages, url_filter.RULES).orderBy("page_id")
    assert got.columns == ["page_id", "url", *taken, "host", "path", "rule", "verdict"]
    first, second = got.collect()
    assert (first["host"], first["rule"], first["verdict"]) == ("a.org", "org/", "allow")
    assert (second["host"], second["rule"], second["verdict"]) == ("", None, "allow")
    assert [first[n] for n in taken] == taken


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(pages, url_filter.RULES).count() == 0


def test_query_same_as_sql(spark):
    folder = f"{DATA}/sf0.01"
    sql = queries.oracle_sql()["op3_url_filter"]
    assert parity.compare(queries.op3_url_filter(spark, folder), parity.connect(folder), sql) is None


def test_only_ascii_letters_of_hosts_are_lowered(spark):
    rules = [("ÄB.de", "/", "block")]
    pages = spark.createDataFrame([(1, "http://ÄB.de/x", "", 0), (2, "http://äb.de/x", "", 0)], SCHEMA)
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    for judged in (url_filter.judge(pages, rules), url_filter.judge_by_join(pages, listed)):
        assert {r["page_id"]: r["verdict"] for r in judged.collect()} == {1: "block", 2: "allow"}
