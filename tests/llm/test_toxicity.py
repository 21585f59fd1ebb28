"""Gradients against differences, windows against a plain pass, and held-out labels."""

import random
import zlib

import numpy as np
import pytest

from paidmedia.llm import toxicity as t

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def model():
    """A model learned from windows with a toxic stem."""
    rng = random.Random(1)
    clean = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 7))) for _ in range(400)]
    counts = np.zeros((t.FOLDS, 2, 1 + t.WORD_BUCKETS + t.GRAM_BUCKETS), np.int64)
    texts = []
    for i in range(400):
        words = rng.choices(clean, k=rng.randrange(3, 70))
        if i % 4 == 0:
            words[rng.randrange(len(words))] = "zork" + "".join(rng.choices("abc", k=2))
        texts.append((int(i % 4 == 0), " ".join(words).encode()))
        t.add_document(counts[t.fold_of(texts[-1][1]), texts[-1][0]], texts[-1][1])
    inputs = t.Inputs(counts)
    rows = sorted((w, y, t.fold_of(x)) for y, x in texts for w in t.windows_to_learn(inputs, y, x))
    windows, y, folds = zip(*rows, strict=True)
    steps, t.STEPS = t.STEPS, 120
    network = t.train(list(windows), np.array(folds), np.array(y, np.float32), inputs)
    t.STEPS = steps
    return inputs, network, clean


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    network = t.Network(6)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    x = rng.normal(size=(5, 7, 6))
    mask = (np.arange(7) < rng.integers(1, 8, (5, 1))).astype(float)
    y = rng.integers(0, 2, 5).astype(float)

    def loss():
        states = [network.layer((x @ network.p[f"W{d}"] + network.p[f"c{d}"]).astype(np.float64), mask, d) for d in "fb"]
        z = network.attend(np.concatenate(states, axis=2), mask)[2] @ network.p["w"] + network.p["o"]
        return np.mean(np.log1p(np.exp(z)) - y * z)

    grads, dx = network.gradients(x, mask, y)
    for name, g in grads.items():
        for at in [tuple(rng.integers(0, n) for n in g.shape) for _ in range(4)]:
            keep = network.p[name][at]
            network.p[name][at] = keep + 1e-2
            up = loss()
            network.p[name][at] = keep - 1e-2
            down = loss()
            network.p[name][at] = keep
            assert g[at] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=2e-4), name
    at = (2, 0, 3)
    x[at] += 1e-2
    up = loss()
    x[at] -= 2e-2
    assert dx[at] == pytest.approx((up - loss()) / 2e-2, rel=0.05, abs=2e-4)


def plain_score(inputs, network, text):
    words = t.WORD.findall(text)
    best = 0.0
    for at in range(0, max(1, len(words) - t.STRIDE), t.STRIDE):
        part = words[at : at + t.WINDOW]
        x = inputs.of(part)[None]
        mask = np.ones((1, len(part)), np.float32)
        states = [network.layer(x @ network.p[f"W{d}"] + network.p[f"c{d}"], mask, d) for d in "fb"]
        z = network.attend(np.concatenate(states, axis=2), mask)[2] @ network.p["w"] + network.p["o"]
        best = max(best, float(t.sigmoid(z)[0]))
    return best


@pytest.mark.parametrize("chunk, memo", [(t.CHUNK_WORDS, t.MEMO_WORDS), (64, 20)])
def test_scores_cover_all_windows(model, chunk, memo, monkeypatch):
    inputs, network, clean = model
    monkeypatch.setattr(t, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(t, "MEMO_WORDS", memo)
    monkeypatch.setattr(t, "CHUNK_WINDOWS", 5)
    rng = random.Random(2)
    texts = [" ".join(rng.choices(clean, k=k)).encode() for k in (1, 2, 15, 16, 17, 31, 32, 33, 48, 49, 64, 65, 500)]
    got = t.Scorer(inputs, network).scores([*texts, None, b"", b" , "])
    assert got[-3:].tolist() == [0, 0, 0]
    for text, score in zip(texts, got, strict=False):
        assert score == pytest.approx(plain_score(inputs, network, text), abs=1e-4)


def test_an_unseen_form_of_a_toxic_stem_counts_wherever_it_stands(model):
    inputs, network, clean = model
    rng = random.Random(9)
    scorer = t.Scorer(inputs, network)
    body = rng.choices(clean, k=3000)
    for at in (0, 1499, 2999):
        toxic = list(body)
        toxic[at] = "zorkbbc"
        scores = scorer.scores([" ".join(toxic).encode(), " ".join(body).encode()])
        assert scores[0] >= t.THRESHOLD > scores[1]


def test_held_out_rows_are_never_sampled(spark):
    labels = spark.createDataFrame([(i, 1, i % 3 == 0) for i in range(400)], "doc_id long, quality int, toxic boolean")
    picked = t.sampled_labels(labels.selectExpr("doc_id", "quality", "int(toxic) AS toxic")).collect()
    assert picked and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 for r in picked)


def test_whole_query_on_small_tables(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        body = rng.choices(words, k=rng.randrange(1, 90))
        if i % 3 == 0:
            body[rng.randrange(len(body))] = "zork" + rng.choice(["ab", "ca", "x"])
        rows.append((i, " ".join(body), i % 2))
        labels.append((i, 1, int(i % 3 == 0)))
    rows += [(None, None, 0), (7, "", 0), (9, "é" * 30_000, 0), (11, "same text", 0), (11, "same text", 0)]
    labels += [(None, 1, 1), (700, 1, None), (0, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int").repartition(3)
    got = t.toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] not in (7, 9, 11)]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got if r["doc_id"] is not None)
    assert sum(r["predicted"] == (r["doc_id"] % 3 == 0) for r in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert [r["score"] for r in got if r["doc_id"] is None] == [0.0]


def test_without_labels_and_without_rows(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none = spark.createDataFrame([], LABELS)
    assert [r["score"] for r in t.toxicity(docs, none).collect()] == [0.0]
    assert t.toxicity(docs.limit(0), none).count() == 0
