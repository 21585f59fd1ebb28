"""Quality selection by importance resampling.

Two generative models are counted over hashed n-grams: one of target text (documents
labelled good) and one of raw text (all documents).  A document's log importance weight
is the sum over its n-grams of the log ratio of the two.  Gumbel noise, derived from the
row itself, is added to it, and the rows with the largest sums are a sample drawn without
replacement in proportion to the weights.

N-grams are single tokens and pairs of tokens; a token is a run of letters and digits or
of other visible characters, and one that repeats its predecessor becomes one common
repeat mark, so that "w w w" is the same evidence for any w.

Counting is one pass: each task adds up its n-grams in two arrays of ``BUCKETS`` counters
and emits only those, whatever the corpus size.  The target labels are a bounded sample
(``TARGET_ROWS`` ids), broadcast to the tasks; raw counts cover every document.  The
sample's threshold is found by narrowing a histogram, so nothing is sorted or collected.

How many rows are kept is estimated from all of them, as labels may cover some sources
only: the labelled rows give a cut-off of the weight, with as many of them above it as are
good, and every row of the table above it counts.  Rows the target model has learned from
are weighed without their own n-grams there, so that they do not set the cut-off too high.

Nulls: a null text counts as empty and has log weight zero; rows with a null id are scored
like others.  Rows that tie with the last one sampled are all kept, so equal rows share
their fate.  Empty tables give an empty result; where no row is labelled all are kept, and
where every labelled row is bad none is.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidmedia.llm.common import binary, free_name, freeze, uniform

BUCKETS = 1 << 14
#: Labelled good documents that the target model counts: those of the smallest id hashes.
TARGET_ROWS = 20_000
SEED = 17
#: Bins of one step of the search for the threshold.
BINS = 4096

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xFF]+|[^0-9A-Za-z\x80-\xFF\x00-\x20]+")
REPEAT = np.uint64(0x9E3779B97F4A7C15)
PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)


def buckets(text: bytes | None) -> np.ndarray:
    """The hashed n-grams of a text."""
    tokens = TOKEN.findall(text or b"")
    h = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    if not len(h):
        return np.empty(0, np.int64)
    marked = h.copy()
    marked[1:][h[1:] == h[:-1]] = REPEAT
    pairs = (marked[:-1] * PAIR) ^ marked[1:]
    pairs = (pairs ^ (pairs >> np.uint64(31))) * REPEAT
    return (np.concatenate([marked * REPEAT, pairs]) >> SHIFT).astype(np.int64)


def is_in(ids: pa.Array, known: np.ndarray) -> np.ndarray:
    """Which ids are among the known ones; a null id never is."""
    return np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), known) & ids.is_valid().to_numpy(zero_copy_only=False)


def target_ids(labels: DataFrame, rows: int = TARGET_ROWS) -> np.ndarray:
    """Sorted ids of at most ``rows`` documents labelled good, chosen by their hash."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    picked = good.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(rows).collect()
    return np.sort(np.array([r[0] for r in picked], np.int64))


def bucket_counts(docs: DataFrame, ids: np.ndarray, doc_id: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """How often each bucket occurs in raw text and in target text, that of ``ids``."""
    good = docs.sparkSession.sparkContext.broadcast(ids)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            known = is_in(batch.column(0), good.value)
            for is_target, data in zip(known.tolist(), binary(batch.column(1)), strict=True):
                n = np.bincount(buckets(data), minlength=BUCKETS)
                raw += n
                if is_target:
                    target += n
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"]
        )

    counted = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .mapInArrow(count, "bucket bigint, raw bigint, target bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counted.collect():  # one row per bucket at most
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    return raw, target


def ratios_of(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def log_ratios(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> np.ndarray:
    """For each bucket, the log of its probability in target text over that in raw text."""
    return ratios_of(*bucket_counts(docs, target_ids(labels), doc_id, text))


def log_weight(text: Column, ratios) -> Column:
    """Column: a text's log importance weight under a broadcast array of log ratios."""

    @F.arrow_udf("double")
    def of_batch(column: pa.Array) -> pa.Array:
        w = ratios.value
        return pa.array([float(w[buckets(t)].sum()) for t in binary(column)], pa.float64())

    return of_batch(text)


def held_out_weight(doc_id: Column, text: Column, model) -> Column:
    """Column: the log weight of a row of the target text under a target model without it.

    ``model`` is a broadcast (ids, raw, target); null for rows of other ids.
    """

    @F.arrow_udf("double")
    def of_batch(ids: pa.Array, column: pa.Array) -> pa.Array:
        good, raw, target = model.value
        known = is_in(ids, good)
        out: list[float | None] = [None] * len(ids)
        for i in np.flatnonzero(known).tolist():
            used, n = np.unique(buckets(column[i].as_py().encode() if column[i].is_valid else b""), return_counts=True)
            others = target.sum() - n.sum()
            # Without any other target text there is no model, as in ``ratios_of``.
            if others:
                log_target = np.log((target[used] - n + 1) / (others + BUCKETS))
                out[i] = float((n * (log_target - np.log((raw[used] + 1) / (raw.sum() + BUCKETS)))).sum())
        return pa.array(out, pa.float64())

    return of_batch(doc_id.cast("long"), text)


def gumbel(*row: Column) -> Column:
    return -F.log(-F.log(uniform(F.lit(SEED), *row)))


def kth_largest(values: DataFrame, name: str, k: int) -> float | None:
    """The k-th largest of a column's non-null values, by narrowing a histogram."""
    rows = values.where(F.col(name).isNotNull()).select(F.col(name).alias("v"))
    total, low, high = rows.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not 1 <= k <= total:
        return None
    above = 0
    while low < high:
        width = (high - low) / BINS
        at = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(BINS - 1))
        bins = (
            rows.where(F.col("v").between(low, high))
            .groupBy(at.alias("bin"))
            .agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        )
        for b in sorted(bins.collect(), key=lambda b: -b["bin"]):  # BINS rows at most
            if above + b["n"] >= k:
                low, high = b["low"], b["high"]
                break
            above += b["n"]
    return low


def good_rows(keys: DataFrame, labels: DataFrame, rows: int) -> int:
    """How many of all ``rows`` of ``keys`` weigh as much as those labelled good."""
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("known_id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"))
    )
    labelled = freeze(
        keys.join(known, keys["doc_id"].cast("long") == known["known_id"]).select(
            F.coalesce("held_out", "log_weight").alias("v"), "good"
        )
    )
    total, good = labelled.agg(F.count("v"), F.sum("good")).first()
    if not total or good == total:
        return rows
    if not good:
        return 0
    least = kth_largest(labelled, "v", good)
    below = labelled.where(F.col("v") < F.lit(least)).agg(F.max("v")).first()[0]
    cut = least if below is None else (least + below) / 2
    return keys.where(F.col("log_weight") >= F.lit(cut)).count()


class Selection:
    """The models and the threshold that the corpus and its labels give."""

    def __init__(
        self, docs: DataFrame, labels: DataFrame, doc_id: str, text: str, share: float | None
    ) -> None:
        self.ids = (F.col(doc_id), F.col(text))
        self.text = F.col(text)
        sc = docs.sparkSession.sparkContext
        good = target_ids(labels)
        raw, target = bucket_counts(docs, good, doc_id, text)
        self.ratios = sc.broadcast(ratios_of(raw, target))
        named = [F.col(doc_id).alias("doc_id"), *self.scored()]
        if share is None:
            named.append(held_out_weight(*self.ids, sc.broadcast((good, raw, target))).alias("held_out"))
        keys = freeze(docs.select(*named))
        self.keys = keys.drop("held_out")
        rows = keys.count()
        k = good_rows(keys, labels, rows) if share is None else round(share * rows)
        if rows and k < 1:
            self.threshold = float("inf")
        else:
            self.threshold = kth_largest(self.keys, "sample_key", min(rows, k)) if rows else None

    def scored(self) -> list[Column]:
        weight = log_weight(self.text, self.ratios)
        return [weight.alias("log_weight"), (weight + gumbel(*self.ids)).alias("sample_key")]

    def kept(self) -> Column:
        return F.col("sample_key") >= F.lit(self.threshold)


def resample(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    share: float | None = None,
) -> DataFrame:
    """(doc_id, log_weight, sample_key, kept) for each row of ``docs``.

    ``labels`` has doc_id and quality (1: good).  ``share`` of the rows are kept; by
    default as many as weigh like the rows labelled good.
    """
    chosen = Selection(docs, labels, doc_id, text, share)
    return chosen.keys.withColumn("kept", F.coalesce(chosen.kept(), F.lit(False)))


def keep_sampled(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    share: float | None = None,
) -> DataFrame:
    """The rows of ``docs`` that ``resample`` keeps, with their own columns.

    Scores depend on the row and the models alone, so the second pass meets the
    threshold exactly and no text is shuffled.
    """
    chosen = Selection(docs, labels, doc_id, text, share)
    if chosen.threshold is None:
        return docs
    key = free_name(docs, "sample_key")
    scored = docs.withColumn(key, chosen.scored()[1])
    return scored.where(F.col(key) >= F.lit(chosen.threshold)).drop(key)
