"""The pipeline's stages against brute force, each on what the one before kept."""

import numpy as np
import pytest
from conftest import DATA

import corpus_pipeline
from paidmedia.llm import line_dedup, queries
from test_line_dedup import brute as brute_lines
from test_packing import check as check_packing
from test_simhash import brute_components, brute_fingerprint

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that went into each stage and came out of it."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(folder / str(i))
        stage(spark, docs, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_order_and_columns(stages):
    assert [n for n, *_ in stages] == ["quality", "line dedup", "simhash dedup", "benchmark decontamination", "packing"]
    assert all(columns == ["doc_id", "text", "lang", "source", "n_chars"] for *_, columns in stages[:-1])


def test_quality_keeps_the_good_share(spark, stages):
    _, before, after, _ = stages[0]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after}
    assert set(map(str, after)) <= set(map(str, before))
    # Labels are a sample of the rows: the rows kept are as many as weigh like good ones, which
    # the labelled share gives only roughly.
    assert len(after) == pytest.approx(len(before) * np.mean(list(labels.values())), rel=0.05)
    known = [r["doc_id"] for r in before if r["doc_id"] in labels]
    assert sum((i in kept) == bool(labels[i]) for i in known) >= 0.9 * len(known)


def test_lines(stages):
    _, before, after, _ = stages[1]
    want = brute_lines([(r["source"], r["text"]) for r in before], line_dedup.RATIO, line_dedup.MIN_PAGES)
    assert sorted((r["source"], r["text"]) for r in after) == sorted(
        (h, x) for (h, x, _, _), n in want.items() for _ in range(n)
    )
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before)


def test_one_of_each_group(stages):
    _, before, after, _ = stages[2]
    ids = [r["doc_id"] for r in before]
    least = brute_components(ids, [brute_fingerprint(r["text"]) for r in before])
    want = [r for r, first in zip(before, least, strict=True) if r["doc_id"] == first]
    assert sorted(map(str, after)) == sorted(map(str, want))


def test_no_benchmark_passage_is_left(spark, stages):
    _, before, after, _ = stages[3]
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]

    def holds(r):
        text = " ".join(r["text"].lower().split())
        return any(i in text for i in items)

    assert sorted(map(str, after)) == sorted(str(r) for r in before if not holds(r))


def test_packing(stages):
    from tokenizers import Tokenizer

    from paidmedia.llm import packing

    _, before, after, _ = stages[4]
    library = Tokenizer.from_file(packing.word_tokenizer())
    check_packing(after, [(r["doc_id"], r["text"]) for r in before], library, 2048)


def test_run_gives_the_last_stage(spark, stages):
    got = queries.queries()["pipeline"](spark, FOLDER).collect()
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in got) == sorted(
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in stages[-1][2]
    )


def test_stages_on_odd_documents(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x " * 30_000, "en", None, 5)]
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    for n in (len(rows), 0):
        docs = spark.createDataFrame(rows[:n], schema)
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, FOLDER).write.parquet(str(tmp_path / f"{n}-{i}"))
            docs = spark.read.parquet(str(tmp_path / f"{n}-{i}"))
        assert (docs.count() > 0) == (n > 0)
