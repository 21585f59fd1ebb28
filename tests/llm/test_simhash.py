"""Fingerprints, links and components against brute force."""

import random

import pytest
import xxhash

from paidmedia.llm import simhash

SCHEMA = "doc_id long, text string, bits string, component_id string"


def brute_fingerprint(text, shingle=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_components(ids, prints, max_bits=2):
    least = list(ids)
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= max_bits and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ß", "日本"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(1, 260))] for _ in range(25)]
    out = [" ".join(w) for w in base]
    for w in base:
        for _ in range(4):  # near copies
            near = list(w)
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
            out.append("\t".join(near).upper())
    out += [out[0]] * 60  # a group of copies
    out += ["", " \n ", "one", "one two", "One two", "a b c", "A  B\x0bC", "x" * 100_000]
    rng.shuffle(out)
    return out


def test_same_as_brute_force(spark, texts):
    ids = [7 * i + 3 for i in range(len(texts))]
    prints = [brute_fingerprint(t) for t in texts]
    want = dict(zip(ids, zip(prints, brute_components(ids, prints), strict=True), strict=True))
    docs = spark.createDataFrame(
        [(i, t, "clash", "clash") for i, t in zip(ids, texts, strict=True)], SCHEMA
    ).repartition(5)
    got = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in got} == want
    assert all(len(r["fingerprint"]) == 16 for r in got)
    assert len(got) == len(texts)


def test_cells_within_reach_hold_every_near_pair(spark):
    rng = random.Random(8)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(3)):
            b ^= 1 << bit
        pairs.append((a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b))
    frame = spark.createDataFrame(pairs, "a long, b long")
    from pyspark.sql import functions as F

    cells = [simhash.nearby_cells(simhash.segment_counts(F.col(c)), 1) for c in "ab"]
    assert frame.where(~F.arrays_overlap(*cells)).count() == 0
    counts = frame.select(simhash.segment_counts(F.col("a")).alias("n"), "a").collect()
    for r in counts:
        assert all(r["n"] >> 4 * s & 15 == ((r["a"] & (1 << 64) - 1) >> 4 * s & 15).bit_count() for s in range(16))


@pytest.mark.parametrize("shape", ["chain", "star", "clique", "mixed"])
def test_components_of_any_shape(spark, shape):
    rng = random.Random(2)
    edges = {
        "chain": [(i, i + 1) for i in range(200)],
        "star": [(0, i) for i in range(1, 200)],
        "clique": [(i, j) for i in range(20) for j in range(i)],
        "mixed": [(rng.randrange(300), rng.randrange(300)) for _ in range(170)],
    }[shape]
    edges = [(a, b) for a, b in edges if a != b]
    got = {r["node"]: r["root"] for r in simhash.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: n for e in edges for n in e}
    for _ in want:
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert set(got) == set(want)
    groups = {}
    for n, root in got.items():
        groups.setdefault(root, set()).add(want[n])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(want.values()))


def test_nulls_repeats_and_empty(spark):
    rows = [(1, None), (5, ""), (None, ""), (9, "a b c d"), (9, "a b c d"), (None, "z y x w v"), (4, "A B C D")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["component_id"] or 0) for r in got) == [
        ("1", 1), ("4", 4), ("5", 1), ("9", 4), ("9", 4), ("None", 0), ("None", 1),
    ]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_keep_one(spark):
    rows = [
        (3, "same words in here", "x"), (2, "same words in here", "y"), (2, "same words in here", "y"),
        (8, "quite another text about things", "z"), (None, "lone text without any id at all", "n"),
        (None, "lone text without any id at all", "n"), (1, None, "a"), (7, "", "b"),
        (8, "a different text under the same id", "c"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(map(str, got.collect())) == sorted(
        map(str, spark.createDataFrame([rows[1], rows[3], rows[4], rows[6], rows[8]], docs.schema).collect())
    )
