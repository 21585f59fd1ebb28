"""Base spans against the contract's patterns, added ones against planted and decoy texts."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from conftest import DATA

from paidmedia.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    """(start, kind, end) by the contract's patterns as they stand."""
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                total = sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(digits[::-1]))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def digest_of(text):
    kinds = list(PATTERNS)
    spans = brute(text)
    joined = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)
    return (*[sum(k == n for _, k, _ in spans) for n in range(4)], hashlib.sha256(joined.encode()).hexdigest()), joined


def test_base_spans_of_random_texts():
    rng = random.Random(1)
    alphabet = ["a", "Z", "@", ".", "-", "+", " ", "1", "4", "25", "255", "0", "(", ")", "é", "%", "4111 1111 1111 1111", "::"]
    for _ in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == brute(text), text


def test_query_over_the_whole_table(spark):
    folder = f"{DATA}/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.op12_pii(spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        want, joined = digest_of(texts[r["doc_id"]])
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == want
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
    # Texts without anything personal are left alone, but for few.
    clean = [r for r in got if not digest_of(texts[r["doc_id"]])[1]]
    assert sum(bool(r["spans"]) for r in clean) <= len(clean) / 100


REAL = [
    ("mail me: anna.berg (at) host{} (dot) org", "email"), ("contact jörg{}@firma.de today", "email"),
    ("write to bob{} [at] site.com", "email"), ("phone (743) 555-38{:02d} now", "phone"),
    ("tel 0049 30 1234{:02d}7 or so", "phone"), ("card 4111.1111.1111.1111 no {}", "card"),
    ("host fe80::1ff:fe23:4567:{:x} is up", "ip"), ("call (312) 555.01{:02d}", "phone"),
]
DECOYS = [
    "in the years 1914-19{:02d} there", "isbn 978-3-16-1484{:02d}-0 print", "order 2023/11/{:02d}/4567",
    "look at main.py line {}", "pages 1200-12{:02d} of it", "at 12:30:{:02d} sharp", "section 3.2.1 and {}",
    "serial 1234 5678 9012 34{:02d}",
]
USUAL = ["mail a{}@mail.com", "ip 10.0.0.{}", "card 4111 1111 1111 1111 no {}", "tel +1 (743) 555-38{:02d}"]


@pytest.fixture(scope="module")
def corpus(spark):
    """(text, kind or None) of planted, decoy and usual lines; the fit sees no labels."""
    rng = random.Random(3)
    words = "lorem ipsum dolor sit amet consectetur".split()
    out = []
    for i in range(600):
        line, kind = rng.choice([*REAL, *[(d, None) for d in DECOYS], *[(u, "base") for u in USUAL]])
        text = f"{' '.join(rng.sample(words, 3))} {line.format(i % 90 + 10)} {' '.join(rng.sample(words, 3))}"
        out.append((i, text, kind))
    frame = spark.createDataFrame([(i, t) for i, t, _ in out], "doc_id long, text string")
    half = frame.where("doc_id % 2 = 0")
    return out, frame, pii.fit(half)


def test_held_out_lines(corpus):
    """Half of the lines fit the model, the other half is judged."""
    rows, frame, model = corpus
    got = {r["doc_id"]: r["spans"] for r in pii.find(frame, model=model).collect()}
    held = [(i, kind) for i, _, kind in rows if i % 2]
    real = [(i, kind) for i, kind in held if kind and kind != "base"]
    found = sum(any(s["kind"] == kind and not s["base"] for s in got[i]) for i, kind in real)
    assert found >= 0.9 * len(real)
    decoys = [i for i, kind in held if kind is None]
    assert sum(bool(got[i]) for i in decoys) <= 0.05 * len(decoys)
    assert all(any(s["base"] for s in got[i]) for i, kind in held if kind == "base")


def test_em_finds_reliable_labelers():
    """Votes drawn from known reliabilities: they and the share of real ones come back."""
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.9, 0.85, 0.7, 0.6, 0.5])
    said = np.where(rng.random((20_000, 6)) < right, truth[:, None], ~truth[:, None])
    ballots, counts = np.unique(["".join("+" if v else "-" for v in row) for row in said], return_counts=True)
    real, table = pii.reliabilities(list(ballots), counts.astype(float))
    assert abs((real * counts).sum() / counts.sum() - 0.3) < 0.03
    assert np.abs(table[0, :, 0] - right).max() < 0.05
    assert np.abs(table[1, :, 2] - right).max() < 0.05


def test_odd_rows(spark):
    rows = [
        (None, "a@b.com"), (1, None), (1, ""), (2, "a@b.com"), (2, "a@b.com"), (3, "\U0001f600 a@b.com +1 (743) 555-3824"),
        (4, "1" * 4000 + ".2.3.4 +" + "1" * 20),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, spans string, kind int")
    got = sorted(str(tuple(r)[:6]) for r in pii.digest(pii.find(frame)).collect())
    assert got == sorted(str((i, *digest_of(t)[0])) for i, t in rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert pii.digest(pii.find(frame)).collect() == []


@pytest.mark.parametrize("unit", ["a", "1", "1.", "1 ", "a@", "a@b.", "+1 ", "+1(", "é", "(1", ": ", "1:", " at ", "a at b."])
def test_long_texts_take_linear_time(unit):
    began = time.perf_counter()
    pii.candidates(unit * (400_000 // len(unit)))
    assert time.perf_counter() - began < 8


def test_labels_do_not_depend_on_partitions(spark, corpus):
    _, frame, model = corpus
    again = pii.fit(frame.where("doc_id % 2 = 0").repartition(5))
    assert np.allclose(again.weights, model.weights) and np.allclose(again.tables, model.tables)
    assert zlib.crc32(again.weights.round(6).tobytes()) == zlib.crc32(model.weights.round(6).tobytes())
