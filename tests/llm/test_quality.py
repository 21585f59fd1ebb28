"""The models against a plain count, the threshold against a sort, and held-out labels."""

import math
import random

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from paidmedia.llm import quality

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    good = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(300):
        junk = i % 6 == 0
        words = rng.choices(good, k=rng.randrange(5, 80))
        if junk:
            words = [f"{w} $$$" for w in words] if i % 12 else [w for w in words[:5] for _ in range(9)]
        rows.append((i, " ".join(words), 0.5))
        if i % 2:
            continue
        labels.append((i, int(not junk), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, sample_key double").repartition(4)
    return rows, docs, spark.createDataFrame(labels, LABELS), labels


def test_log_ratios_against_a_plain_count(corpus):
    rows, docs, labels, listed = corpus
    good = {i for i, q, _ in listed if q}
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for i, text, _ in rows:
        n = np.bincount(quality.buckets(text.encode()), minlength=quality.BUCKETS)
        raw += n
        target += n * (i in good)
    want = np.log((target + 1) / (target.sum() + quality.BUCKETS)) - np.log((raw + 1) / (raw.sum() + quality.BUCKETS))
    np.testing.assert_allclose(quality.log_ratios(docs, labels, "doc_id", "text"), want)


def test_a_repeated_word_is_the_same_evidence_for_any_word():
    a, b = (quality.buckets(" ".join([w] * 9).encode()) for w in ("one", "two"))
    assert sorted(a)[1:-1] != [] and len(set(a.tolist()) & set(b.tolist())) >= 2


def test_sample_is_the_largest_keys(corpus):
    rows, docs, labels, _ = corpus
    got = quality.resample(docs, labels, share=0.4).collect()
    assert len(got) == len(rows)
    keys = sorted((r["sample_key"] for r in got), reverse=True)
    assert all(r["kept"] == (r["sample_key"] >= keys[119]) for r in got)
    kept = quality.keep_sampled(docs, labels, share=0.4)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["kept"]}


def test_junk_goes_and_clean_text_stays(corpus):
    _, docs, labels, _ = corpus
    got = quality.resample(docs, labels).collect()
    junk = [r for r in got if r["doc_id"] % 6 == 0]
    clean = [r for r in got if r["doc_id"] % 6]
    assert sum(r["kept"] for r in junk) <= len(junk) // 10
    # The share of good labels is two thirds here, so some clean text has to go with it.
    assert sum(r["kept"] for r in clean) >= 0.75 * len(clean)


@pytest.mark.parametrize("hot_is_clean", [True, False])
def test_a_hot_source_that_labels_do_not_cover(spark, hot_is_clean):
    """A third of all rows is unlabelled and of another mix than the labelled rows, 14 % of them bad."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(900):
        hot = i % 3 == 0
        clean = hot_is_clean if hot else rng.random() >= 0.14
        words = rng.choices(vocabulary, k=rng.randrange(20, 80))
        rows.append((i, " ".join(words if clean else [f"{w} $$$" for w in words]), clean))
        if not hot and i % 2:
            labels.append((i, int(clean), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, clean boolean").repartition(4)
    kept = {r["doc_id"] for r in quality.keep_sampled(docs, spark.createDataFrame(labels, LABELS)).collect()}
    clean = {i for i, _, c in rows if c}
    assert len(kept & clean) >= 0.99 * len(clean)
    assert len(kept - clean) <= 0.02 * (len(rows) - len(clean))


def test_gumbel_noise_has_its_law(spark):
    x = np.array([r[0] for r in spark.range(20_000).select(quality.gumbel(F.col("id"))).collect()])
    assert x.mean() == pytest.approx(0.5772, abs=0.03)
    assert x.std() == pytest.approx(math.pi / math.sqrt(6), abs=0.03)


@pytest.mark.parametrize("values", [[1.0], [2.0] * 50, list(range(5000)), [-1e300, 0.0, 1e-300, 1e300], [1.0, None, 3.0]])
def test_kth_largest(spark, values):
    frame = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    known = sorted((float(v) for v in values if v is not None), reverse=True)
    for k in {1, 2, len(known) // 2, len(known)}:
        if k >= 1:
            assert quality.kth_largest(frame, "v", k) == (known[k - 1] if k <= len(known) else None)
    assert quality.kth_largest(frame, "v", len(known) + 1) is None


def test_nulls_repeats_and_empty(spark, corpus):
    _, docs, labels, _ = corpus
    odd = spark.createDataFrame(
        [(None, None, 1.0), (5, "", 1.0), (7, "same text", 1.0), (7, "same text", 1.0), (9, "é" * 50_000, 1.0)], docs.schema
    )
    got = quality.resample(odd, labels).collect()
    assert len(got) == 5
    assert [r["log_weight"] for r in got if r["doc_id"] in (None, 5)] == [0.0, 0.0]
    assert len({(r["sample_key"], r["kept"]) for r in got if r["doc_id"] == 7}) == 1
    unlabelled = labels.limit(0)
    assert all(r["kept"] for r in quality.resample(odd, unlabelled).collect())
    assert quality.keep_sampled(odd, unlabelled).count() == 5
    assert quality.resample(docs.limit(0), labels).count() == 0
    assert quality.keep_sampled(docs.limit(0), labels).count() == 0


def test_labels_that_were_not_learned_from(spark):
    """Learn from half of the labels, test on the other half."""
    folder = f"{DATA}/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    scored = quality.resample(docs, labels.where(half)).join(labels.where(~half), "doc_id").collect()
    right = sum(r["kept"] == bool(r["quality"]) for r in scored)
    assert right >= 0.9 * len(scored)


def test_a_null_id_is_nobody(spark):
    """A row without an id never counts as target text, whatever ids are labelled."""
    docs = spark.createDataFrame([(None, "x y z"), (-1, "a b"), (0, "c d"), (5, "e f")], "doc_id long, text string")
    for i in (-1, 0):
        labels = spark.createDataFrame([(i, 1, 0)], LABELS)
        _, target = quality.bucket_counts(docs, quality.target_ids(labels), "doc_id", "text")
        assert target.sum() == len(quality.buckets(b"a b"))


def test_all_labels_bad(spark, corpus):
    _, docs, _, listed = corpus
    labels = spark.createDataFrame([(i, 0, 0) for i, *_ in listed], LABELS)
    assert quality.keep_sampled(docs, labels).count() == 0
    assert not any(r["kept"] for r in quality.resample(docs, labels).collect())
    assert quality.keep_sampled(docs, spark.createDataFrame([], LABELS)).count() == docs.count()
