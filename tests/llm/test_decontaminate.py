"""Planted passages with substitutions are found, others are not."""

import itertools
import random

import numpy as np
import pytest

from paidmedia.llm import decontaminate as d

ITEM = "item_id long, text string"
DOC = "doc_id long, text string, item_id string"


def test_any_fifteen_words_with_three_substituted_have_a_hit():
    for places in itertools.combinations(range(15), 3):
        assert any(
            not {p + o for o in mask} & set(places) for mask in d.MASKS for p in range(15 - mask[-1])
        ), places


def brute_longest(same, least):
    best = 0
    for i in range(len(same)):
        for j in range(i + least, len(same) + 1):
            if same[i:j].mean() >= 0.8:
                best = max(best, j - i)
    return best


@pytest.mark.parametrize("n", range(6, 13))
def test_short_items_with_a_fifth_substituted_are_found(n):
    item = [b"w%d" % i for i in range(n)]
    block = d.Block([(7, b" ".join(item))])
    for gone in itertools.combinations(range(n), n // 5):
        text = [b"x" if i in gone else w for i, w in enumerate(item)]
        tokens = d.word_hashes(b" ".join([b"before"] * 20 + text + [b"after"] * 20))
        assert [k for k, *_ in block.overlaps(tokens)] == [0]
    assert not block.any_overlap(d.word_hashes(b" ".join(item[:3] + [b"x"] * 20)))


@pytest.mark.parametrize("n", range(1, 6))
def test_items_of_one_to_five_words(n):
    item = [b"w%d" % i for i in range(n)]
    block = d.Block([(7, b" ".join(item))])
    for k in range(n + 1):
        for gone in itertools.combinations(range(n), k):
            text = [b"x" if i in gone else w for i, w in enumerate(item)]
            tokens = d.word_hashes(b" ".join([b"before"] * 3 + text + [b"after"] * 3))
            assert block.any_overlap(tokens) == ((n - k) / n >= 0.8)


def brute_maximal(text, items):
    """Runs of every item on every diagonal, without seeds, less those within another."""
    out = set()
    for k, item in enumerate(items):
        found = []
        for diagonal in range(-len(item), len(text)):
            start, end = max(0, -diagonal), min(len(item), len(text) - diagonal)
            if end > start:
                same = np.array([item[i] == text[i + diagonal] for i in range(start, end)])
                for at, length in d.agreements(same, min(d.MIN_WORDS, len(item))):
                    found.append((k, start + at + diagonal, start + at, length, int(same[at : at + length].sum())))
        for f in found:
            inside = [g for g in found if g[1] <= f[1] and f[1] + f[3] <= g[1] + g[3] and g != f]
            if not any((g[3], -g[2]) > (f[3], -f[2]) for g in inside):
                out.add(f)
    return out


def test_query_equals_all_pairs_on_all_diagonals(spark):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(300)]
    sizes = [1, 2, 3, 4, 5, 6, 9, 12, 14, 20, 40, 60]
    items = [[f"i{k}x{j}" if k < 2 else rng.choice(words) for j in range(n)] for k, n in enumerate(sizes)]
    docs = []
    for _ in range(60):
        body = rng.choices(words, k=rng.randrange(0, 120))
        for _ in range(rng.randrange(0, 4)):
            passage = list(rng.choice(items))
            if len(passage) > 14 and rng.random() < 0.5:
                passage = passage[: len(passage) // 2]
            for p in rng.sample(range(len(passage)), len(passage) // 7):
                passage[p] = "other"
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage
        docs.append(body)
    docs += [["v1"] * 50, items[10] + ["z"] * 9 + items[10], items[11][:20] + ["z"] * 30 + items[11][35:]]
    benchmark = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], ITEM)
    frame = spark.createDataFrame([(k, " ".join(t), "") for k, t in enumerate(docs)], DOC).repartition(4)
    got = [tuple(r) for r in d.overlaps(frame, benchmark).collect()]
    want = {(k, *row) for k, t in enumerate(docs) for row in brute_maximal(t, items)}
    assert set(got) == want and len(got) == len(want)
    assert {r[2] for r in got if r[:2] == (61, 10)} == {0, 49}
    assert len([r for r in got if r[:2] == (62, 11)]) == 2
    dirty = {r[0] for r in want}
    assert {r["doc_id"] for r in d.drop_contaminated(frame, benchmark).collect()} == set(range(63)) - dirty
    long = {r[0] for r in want if len(items[r[1]]) >= 6}
    kept = d.drop_contaminated(frame, benchmark, least_item=6).collect()
    assert {r["doc_id"] for r in kept} == set(range(63)) - long


def test_longest_agreement():
    rng = np.random.default_rng(1)
    for _ in range(400):
        n = rng.integers(1, 40)
        same = rng.random(n) < rng.choice([0.5, 0.75, 0.85, 1.0])
        least = int(rng.integers(1, 15))
        at, length = d.longest_agreement(same, least)
        want = brute_longest(same, least)
        assert (length > 0) == (want > 0)
        if length:
            part = same[at : at + length]
            assert length >= least and part.mean() >= 0.8
            # Only unequal places at the ends may be missing.
            assert part.sum() >= want * 0.8 - 1e-9


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(6)
    words = [f"v{i}" for i in range(4000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(15, 60)))) for i in range(40)]
    docs, want = [], set()
    for k in range(120):
        body = rng.choices(words, k=rng.randrange(0, 400))
        if k % 3 == 0:
            i = rng.randrange(40)
            passage = items[i][1].split()
            for p in rng.sample(range(len(passage)), len(passage) // 6):
                passage[p] = "other"
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() + "," for w in passage]
            want.add((k, i))
        docs.append((k, "\n".join(body), "clash"))
    return items, docs, want


@pytest.mark.parametrize("block_words", [d.BLOCK_WORDS, 100])
def test_planted_passages(spark, planted, block_words, monkeypatch):
    items, docs, want = planted
    monkeypatch.setattr(d, "BLOCK_WORDS", block_words)
    benchmark = spark.createDataFrame(items + [(99, items[0][1]), (98, None), (97, ""), (96, "!?")], ITEM)
    frame = spark.createDataFrame(docs, DOC).repartition(3)
    got = d.overlaps(frame, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    for r in got:
        text = d.word_hashes(docs[r["doc_id"]][1].encode())[r["first_word"] :][: r["n_words"]]
        item = d.word_hashes(items[r["item_id"]][1].encode())[r["item_word"] :][: r["n_words"]]
        assert (text == item).sum() == r["n_same"] >= 0.8 * r["n_words"]
    kept = d.drop_contaminated(frame, benchmark)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(120)) - {k for k, _ in want}


def test_slices_of_a_long_text_meet(spark, planted, monkeypatch):
    items, _, _ = planted
    monkeypatch.setattr(d, "SLICE", 16)
    block = d.Block([(i, t.encode()) for i, t in items])
    text = " ".join(["filler"] * 37 + [items[3][1]] + ["filler"] * 25)
    assert {k for k, *_ in block.overlaps(d.word_hashes(text.encode()))} == {3}


def test_nulls_repeats_and_empty(spark, planted):
    items, _, _ = planted
    benchmark = spark.createDataFrame(items[:2], ITEM)
    passage = items[0][1]
    docs = spark.createDataFrame([(1, None, ""), (2, "", ""), (None, passage, ""), (4, passage, ""), (4, passage, "")], DOC)
    got = d.overlaps(docs, benchmark).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["4", "4", "None"]
    assert d.drop_contaminated(docs, benchmark).count() == 2
    none = benchmark.limit(0)
    assert d.overlaps(docs, none).count() == 0
    assert d.drop_contaminated(docs, none).count() == 5
    assert d.overlaps(docs.limit(0), benchmark).count() == 0
