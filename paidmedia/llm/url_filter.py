"""Allow and block rules for urls: a trie over reversed host labels and path segments.

The rules are read once into a trie: host labels from the last to the first, then the
path's segments.  A rule may end inside a segment; it then sits at the segment's parent
as an open end.  The trie is broadcast, one walk down it judges a url, and the deepest
rule met decides: more host labels first, then the longer path.  Of an allow and a block
rule with the same host and path, block decides.

The trie is broadcast only up to ``MAX_RULES`` rules of ``MAX_RULE_CHARS`` characters.
Larger sets go through ``judge_by_join``, an equi-join on the same trie nodes.

Nulls: a null url, or one without ``://``, has an empty host and path and no rule.  Rules
with a null part are ignored.  Repeated rows stay rows; an empty table gives an empty
result; other columns of the urls stay, and new columns replace those of the same name.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidmedia.llm.common import free_name

MAX_RULES = 200_000
MAX_RULE_CHARS = 2_000

#: (host, path, verdict) of the registered query.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


class Node:
    """A place in the trie: labels or segments below it, open ends, and the rule that ends here."""

    __slots__ = ("below", "ends", "paths", "rule")

    def __init__(self) -> None:
        self.below: dict[str, Node] = {}
        self.ends: list[tuple[str, tuple[str, str]]] = []
        self.paths: Node | None = None
        self.rule: tuple[str, str] | None = None


def split_path(path: str) -> tuple[list[str], str]:
    """Whole segments, each with the slash that ends it, and the open rest."""
    *whole, rest = path.split("/")
    return [f"{s}/" for s in whole], rest


def build_trie(rules: list[tuple[str, str, str]]) -> Node:
    root = Node()
    # Block comes last, so that it overwrites an allow rule of the same place.
    for host, path, verdict in sorted(rules, key=lambda r: r[2]):
        node = root
        for label in reversed(host.split(".")) if host else ():
            node = node.below.setdefault(label, Node())
        if node.paths is None:
            node.paths = Node()
        node = node.paths
        whole, rest = split_path(path)
        for segment in whole:
            node = node.below.setdefault(segment, Node())
        found = (f"{host}{path}", verdict)
        if rest:
            node.ends = [e for e in node.ends if e[0] != rest] + [(rest, found)]
            node.ends.sort(key=lambda e: len(e[0]))
        else:
            node.rule = found
    return root


def longest(trie: Node, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the deepest rule that fits."""
    best, node = None, trie
    segments, rest = split_path(path)
    chain = [trie]
    for label in reversed(host.split(".")) if host else ():
        node = node.below.get(label)
        if node is None:
            break
        chain.append(node)
    for node in reversed(chain):
        if node.paths is None:
            continue
        at, depth = node.paths, 0
        while True:
            if at.rule is not None:
                best = at.rule
            here = segments[depth] if depth < len(segments) else rest
            for end, found in at.ends:
                if here.startswith(end):
                    best = found
            at = at.below.get(segments[depth]) if depth < len(segments) else None
            depth += 1
            if at is None:
                break
        if best is not None:
            return best
    return None


def fits_broadcast(rules: list[tuple[str, str, str]]) -> bool:
    return len(rules) <= MAX_RULES and all(len(h) + len(p) <= MAX_RULE_CHARS for h, p, _ in rules)


def ascii_lower(host: str) -> str:
    """A-Z to a-z as in the hosts of urls; other letters stay."""
    return host.translate(str.maketrans(UPPER, LOWER))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    url: str = "url",
    otherwise: str = "allow",
) -> DataFrame:
    """``pages`` with host, path, rule (``host/path`` text or null) and verdict.

    ``rules`` are (host, path, "allow" or "block").  ``otherwise`` is the verdict where
    no rule fits.  Rule lists beyond the broadcast bound are joined instead.
    """
    rules = [(ascii_lower(h), p, v) for h, p, v in rules if None not in (h, p, v)]
    if not fits_broadcast(rules):
        spark = pages.sparkSession
        listed = spark.createDataFrame(rules, "host string, path string, verdict string")
        return judge_by_join(pages, listed, url, otherwise)
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.arrow_udf("struct<rule string, verdict string>")
    def verdicts(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        found = [
            longest(trie.value, h, p) or (None, otherwise)
            for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True)
        ]
        return pa.array(
            [{"rule": r, "verdict": v} for r, v in found],
            pa.struct([("rule", pa.string()), ("verdict", pa.string())]),
        )

    mark = free_name(pages, "judged")
    judged = F.col(mark)
    return (
        pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
        .withColumn(mark, verdicts("host", "path"))
        .withColumns({"rule": judged["rule"], "verdict": judged["verdict"]})
        .drop(mark)
    )


def judge_by_join(
    pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow"
) -> DataFrame:
    """The same as ``judge`` for any number of rules (columns host, path, verdict).

    Each distinct (host, path) emits the trie nodes on its way, its host suffixes times
    its directories, and meets the rules of a node in an equi-join; the open end of a rule
    is compared in the join condition, and one aggregate keeps the longest.
    """
    located = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    j_host, j_path, j_rule, j_verdict = (free_name(pages, n) for n in ("j_host", "j_path", "j_rule", "j_verdict"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )
    parts = F.split("path", "/")
    folders = F.transform(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda i: F.array_join(F.concat(F.slice(parts, F.lit(1), i), F.array(F.lit(""))), "/"),
    )
    places = (
        located.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(F.array_distinct(F.concat(suffixes, F.array(F.lit(""))))).alias("at"))
        .select("host", "path", "at", F.explode(folders).alias("folder"))
        .withColumn("rest", F.substring(F.col("path"), F.length("folder") + 1, F.length("path")))
    )
    own = rules.dropna(subset=["host", "path", "verdict"]).select(
        F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")
    ).withColumn("r_folder", F.regexp_extract("r_path", r"(?s)^(.*/)?", 0))
    fits = (
        (F.col("at") == F.col("r_host"))
        & (F.col("folder") == F.col("r_folder"))
        & F.col("rest").startswith(F.substring(F.col("r_path"), F.length("r_folder") + 1, F.length("r_path")))
    )
    depth = F.when(F.col("r_host") == "", 0).otherwise(F.size(F.split("r_host", r"\.")))
    best = (
        places.join(own, fits)
        .groupBy(F.col("host").alias(j_host), F.col("path").alias(j_path))
        .agg(
            F.max(
                F.struct(depth.alias("depth"), F.length("r_path").alias("chars"), "r_verdict", "r_host", "r_path")
            ).alias("best")
        )
        .select(
            j_host,
            j_path,
            F.concat("best.r_host", "best.r_path").alias(j_rule),
            F.col("best.r_verdict").alias(j_verdict),
        )
    )
    joined = located.join(
        best, (located["host"] == best[j_host]) & (located["path"] == best[j_path]), "left"
    )
    return joined.withColumns(
        {"rule": F.col(j_rule), "verdict": F.coalesce(j_verdict, F.lit(otherwise))}
    ).drop(j_host, j_path, j_rule, j_verdict)
