"""Token ids against the library, plans against a piece-by-piece packing, places in full."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA
from tokenizers import Tokenizer

from paidmedia.llm import packing, queries
from paidmedia.llm.common import once

ODD = [
    "It's I'LL we're 'tis don't'", "a.b,c! 1234 x2y ½ ²", "Straße ÉCOLE Œuvre ŒUVRE", "  lead\n\ttab nb",
    "<|endoftext|> x", "日本 test", "İstanbul K", "é combining", "don’t “quote” — dash €5", "", "...", "a\x1cb",
    "ǅ Ǆ", "foo_bar __x", "µ ª º ß", "ŉ ſ Ĳ", "\x00 \x7f \x85x", "'S 'T", "Ÿ ÿ × ÷",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.word_tokenizer())


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def test_ids_are_those_of_the_whole_text(spark, library, monkeypatch):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()]
    for size in (packing.MEMO_BYTES, 1000, 0):
        monkeypatch.setattr(packing, "MEMO_BYTES", size)
        encoder = packing.WordEncoder(packing.word_tokenizer())
        for t in texts:
            assert encoder.encode(t) == ids_of(library, t)[:-1].tobytes(), t[:40]


def one_by_one(counts, capacity):
    """Best-two-fit with a scan of all lengths at each step, one bin at a time."""
    counts = counts.copy()
    bins = []
    while counts.any():
        held, gap = [], capacity
        while (fits := [n for n in range(1, gap + 1) if counts[n]]):
            held.append(fits[-1])
            counts[fits[-1]] -= 1
            gap -= fits[-1]
        if gap and len(held) > 1:
            smallest = held[-1]
            pairs = [
                (a + b, a, b)
                for a in range(1, gap + smallest)
                for b in range(1, a + 1)
                if a + b <= gap + smallest and counts[a] and counts[b] and (a != b or counts[a] > 1)
            ]
            if pairs and max(pairs)[0] > smallest:
                total = max(pairs)[0]
                held = (held[:-1], total)
                counts[smallest] += 1
                # Any pair of that sum is as tight; the plan says which it took.
                held = (held[0], total, {(a, b) for s, a, b in pairs if s == total})
        bins.append(held)
        yield held, counts


def expand(runs):
    return [length for length, n in runs for _ in range(n)]


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_two_fit(seed):
    rng = np.random.default_rng(seed)
    capacity = 40
    counts = np.bincount(rng.integers(1, capacity + 1, 300) if seed % 2 else rng.integers(5, 18, 200), minlength=capacity + 1)
    bins = [expand(runs) for times, runs in packing.plan(counts, capacity) for _ in range(times)]
    assert (sum(np.bincount(b, minlength=capacity + 1) for b in bins) == counts).all()
    left = counts.copy()
    for got in bins:
        held, _ = next(one_by_one(left, capacity))
        if isinstance(held, tuple):
            base, _, pairs = held
            assert sorted(got) in [sorted([*base, a, b]) for a, b in pairs]
        else:
            assert sorted(got) == sorted(held)
        left -= np.bincount(got, minlength=capacity + 1)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(6.3, 1.3, 100_000).astype(int), 1, 2048)
    counts = np.bincount(lengths, minlength=2049)
    plan = packing.plan(counts)
    assert sum(times for times, _ in plan) <= 1.001 * lengths.sum() / 2048 + 1
    assert len(plan) < 4096


def check(rows, texts, library, capacity):
    """Every piece of every text once, gapless in its sequence."""
    want = []
    for i, t in texts:
        ids = ids_of(library, t)
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.append((i, k, at, len(part), zlib.crc32(part.tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("bucket_rows", [packing.BUCKET_ROWS, 7])
def test_pack(spark, library, bucket_rows, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", bucket_rows)
    rng = np.random.default_rng(2)
    texts = [(i, " ".join(rng.choice(["alpha", "beta", "é"], rng.integers(0, 90)))) for i in range(150)]
    texts += [(900, None), (901, ""), (None, "null id"), (5, "repeated"), (5, "repeated")] + [(6, "same length")] * 60
    texts += list(enumerate(ODD, 1000))
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, length int").repartition(3)
    rows = packing.pack(docs, packing.word_tokenizer(), 32, with_ids=True).collect()
    check(rows, texts, library, 32)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, packing.word_tokenizer()).count() == 0


def test_query_on_whole_table(spark, library):
    folder = f"{DATA}/sf0.01"
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = queries.op6_packing(spark, folder).collect()
    bins = check(rows, texts, library, 2048)
    assert bins <= 1.01 * sum(r["length"] for r in rows) / 2048 + 1


def test_a_worker_loads_the_vocabulary_once(spark):
    """One Python process may run many tasks: its memory must not grow with them."""
    import resource

    def peak(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024] * batch.num_rows)], names=["mb"]
            )

    texts = spark.createDataFrame([(i, f"word{i} and more {i}") for i in range(100)], "doc_id long, text string")
    path = packing.word_tokenizer()
    packing.pieces(texts.repartition(4), path, 2048, "doc_id", "text", False).count()
    before = max(r["mb"] for r in texts.mapInArrow(peak, "mb long").collect())
    packing.pieces(texts.repartition(100), path, 2048, "doc_id", "text", False).count()
    after = max(r["mb"] for r in texts.mapInArrow(peak, "mb long").collect())
    assert after - before < 60


def test_once_makes_one_value_a_process():
    made = []
    for _ in range(3):
        once(("test", "once"), lambda: made.append(1))
    assert made == [1]
