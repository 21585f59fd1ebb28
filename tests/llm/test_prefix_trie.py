"""Tries against plain prefixes, with small blocks, many slices, copies and hot conversations."""

import hashlib
import random
import zlib

import parity
import pytest
from conftest import DATA

from paidmedia.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn int, role string, text string"


def brute(rows):
    """Sorted result rows, from every prefix of every rebuilt conversation."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, x) for *_, r, x in sorted(t)] for c, t in own.items()}
    rebuilt = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + t[h:])
    members = {}
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) if below else 1
        saved[p] = sum(saved[q] for q in below) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if rebuilt[c] == p)))
        out.append(
            (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p],
             saved[p], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out)


def trie(spark, rows, block=prefix_trie.BLOCK):
    frame = spark.createDataFrame([(*r, "x", -1) for r in rows], SCHEMA + ", grp string, depth int").repartition(3)
    return sorted(tuple(r) for r in prefix_trie.prefix_trie(frame, block=block).collect())


def same(got, want):
    assert len(got) == len(want)
    assert [(a, b) for a, b in zip(got, want, strict=True) if a != b][:3] == []


def conversations(seed, n, longest=9, words=3):
    """Ids in some hundreds, few distinct turns, and many copies."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-300, 4 * n), n):
        rows += [(c, t, rng.choice("ua"), rng.choice(["é", "yes", "no\U0001f600"][:words])) for t in range(rng.randint(1, longest))]
    return rows


@pytest.fixture
def many_slices(monkeypatch):
    """Slices of a few rows and rounds of two."""
    monkeypatch.setattr(prefix_trie, "PARTITION_BYTES", 2000)
    monkeypatch.setattr(prefix_trie, "FAN", 2)


@pytest.mark.parametrize("seed", range(2))
def test_random_conversations(spark, many_slices, seed):
    rows = conversations(seed, 150)
    same(trie(spark, rows), brute(rows))


def test_blocks_of_few_turns(spark, many_slices):
    """Conversations of up to six blocks, some of which end at a border."""
    rows = conversations(7, 60, longest=22, words=1)
    same(trie(spark, rows, block=4), brute(rows))


def test_copies_over_many_slices(spark, many_slices):
    """Half of the conversations are copies, whose ids lie in many slices; one holds a third of the rows."""
    rows = [(c, t, "user", "hot") for c in range(100, 300) for t in range(6, 9)] + conversations(3, 40)
    rows += [(7777, t, "user", f"long {t}") for t in range(300)]
    same(trie(spark, rows), brute(rows))


def test_nulls_ties_and_empty_texts(spark):
    rows = [
        (None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 0, None, "b"),
        (1, None, "user", "a"), (2, None, None, None), (2, 0, "", "x" * 100_000), (100, 1, "user", "only"),
        (101, 0, "user", "short"), (5, None, None, None),
    ]
    same(trie(spark, rows), brute(rows))


def test_empty_table(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x")]) == []


def test_query_against_sql(spark):
    folder = f"{DATA}/sf0.01"
    df = queries.op13_prefix_trie(spark, folder)
    assert parity.compare(df, parity.connect(folder), queries.oracle_sql()["op13_prefix_trie"]) is None


def test_components_join_from_the_deepest_edge_on():
    """Two partitions: the left one keeps only what the right one can still reach."""
    forest = prefix_trie.Forest(0)
    counts = prefix_trie.np.array([5, 7, 9], "<i4")

    def part(depth, conv):
        return prefix_trie.Part("", depth, 0, 1, conv, 0, 0, forest.new_node(), [conv], False, None, counts)

    # Sequences a, ab, abc, abd, x: the next partition goes on with one that begins with x.
    left = forest.grow([part(1, 4), part(2, 3), part(3, 2), part(3, 1), part(1, 9)], [1, 2, 2, 0], -1, 1)
    assert [(n[0], n[1], n[3], n[4], n[5], n[6]) for n in forest.nodes] == [
        (2, 3, 1, 0, 1, 0), (1, 3, 1, 0, 1, 0), (1, 2, 3, 2, 2, 14), (1, 1, 4, 1, 2, 29)
    ]
    assert [(edge, p.depth, p.least, p.children) for edge, p in left] == [(-1, 0, 1, 1), (0, 1, 9, 0)]
