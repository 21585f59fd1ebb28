"""Packing token sequences by best-two-fit, planned on the histogram of lengths.

A bin is filled greedily with the longest pieces that fit.  Then its smallest piece is
taken out again, and if two unpacked pieces fill the larger gap more tightly than it did,
they take its place.  The choice depends only on which lengths are left, so equal bins
repeat until a length runs out: the plan is a list of bins with multiplicities, made from
one count per length (``capacity`` counts), however many documents there are.

The plan goes back to the pieces as intervals: the r-th piece of a length lies in the bin
and place that the interval around r names.  Pieces are numbered within their length in
buckets of bounded size, so a length that a third of all pieces share is spread over tasks.

Token ids come from the ``tokenizers`` library.  A Python worker loads the vocabulary once,
however many tasks it runs, encodes a distinct word once and looks up the others in a memo
of bounded bytes; the ids are those of the whole text (the tests compare them).

A null text is an empty document: the end mark alone.  Longer documents than a bin are cut
into whole bins and a rest.  Repeated rows are documents of their own.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.llm.common import freeze, once

CAPACITY = 2048
END = 0
#: Bytes of words and ids that a Python worker keeps, and what an entry takes besides.
MEMO_BYTES = 64 << 20
ENTRY_BYTES = 200
BUCKET_ROWS = 1 << 19

#: What lower-casing does to each Latin-1 character, and those that are letters or numbers
#: then.  Latin-1 text is in normal form already.
LATIN_LOWER = bytes(ord(c.lower()) if ord(c.lower()) < 256 else ord(c) for c in map(chr, range(256)))


def _class(kind: str) -> bytes:
    lower = (bytes([c]) for c in range(256) if LATIN_LOWER[c] == c)
    return b"".join(c for c in lower if unicodedata.category(c.decode("latin-1"))[0] == kind)


LETTERS, NUMBERS = _class("L"), _class("N")
#: The borders of the vocabulary's pre-tokenizer; a word of it never crosses them.
WORD = re.compile(
    b"[" + LETTERS + b"]+|'(?:s|t|re|ve|m|ll|d)|[" + NUMBERS + b"]"
    b"|[^\\s\x85\xa0" + LETTERS + NUMBERS + b"]+"
)


def word_tokenizer() -> str:
    """The path of the public word vocabulary that is installed with Python."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Memo(dict):
    """Ids of words, from the library's model on first use."""

    def __init__(self, tokenizer) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        split = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.as_bytes = {c: split(chr(c))[0][0] for c in range(256)}
        self.tokenize = tokenizer.model.tokenize
        self.bytes = 0

    def __missing__(self, word: bytes) -> bytes:
        letters = word.decode("latin-1")
        if not word.isalpha():  # only ASCII letters stand for themselves
            letters = letters.translate(self.as_bytes)
        ids = array("I", [t.id for t in self.tokenize(letters)]).tobytes()
        size = len(word) + len(ids) + ENTRY_BYTES
        if self.bytes + size > MEMO_BYTES:
            self.clear()
            self.bytes = 0
        if size <= MEMO_BYTES:
            self[word] = ids
            self.bytes += size
        return ids


class WordEncoder:
    """Little-endian uint32 ids of texts.

    Latin-1 text is split at the borders above and looked up word by word; any other
    text, or one that may spell a special token, is encoded by the library as a whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo = Memo(self.tokenizer)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        try:
            plain = text.encode("latin-1").translate(LATIN_LOWER)
        except UnicodeEncodeError:
            plain = b"<|"
        if b"<|" in plain:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.memo.__getitem__, WORD.findall(plain)))


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer: str, capacity: int, doc_id: str, text: str, with_ids: bool) -> DataFrame:
    """One row per piece of at most ``capacity`` ids, the end mark included."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(("encoder", tokenizer), lambda: WordEncoder(tokenizer))
        end = np.array([END], "<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            rows: list[tuple] = []
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                i, ids = i.as_py(), encoder.encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((i, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=False)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in columns[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = PIECES + (", ids array<int>" if with_ids else "")
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(cut, schema)


def fill(counts: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """One bin as runs (length, pieces), longest first, from ``counts`` of each length."""
    left = counts.copy()
    lengths = np.flatnonzero(left)
    runs: list[list[int]] = []
    gap = capacity
    while gap:
        at = int(np.searchsorted(lengths, gap, "right")) - 1
        if at < 0:
            break
        length = int(lengths[at])
        n = min(int(left[length]), gap // length)
        runs.append([length, n])
        left[length] -= n
        gap -= n * length
        # Of this length none is left or none more fits.
        lengths = lengths[:at]
    if gap and sum(n for _, n in runs) > 1:
        smallest = runs[-1][0]
        wide = gap + smallest
        # The piece that is taken out may not come back in the pair: it was there before.
        free = np.flatnonzero(left[: wide + 1])
        if len(free):
            other = np.searchsorted(free, wide - free, "right") - 1
            # A pair of equal pieces needs two of them.
            same = (other >= 0) & (other == np.arange(len(free))) & (left[free] < 2)
            other[same] -= 1
            sums = np.where(other >= 0, free + free[other], 0)
            best = int(sums.argmax())
            if sums[best] > smallest:
                runs[-1][1] -= 1
                pair = sorted((int(free[best]), int(free[other[best]])), reverse=True)
                runs += [[p, 1] for p in pair]
    merged: dict[int, int] = {}
    for length, n in runs:
        if n:
            merged[length] = merged.get(length, 0) + n
    return sorted(merged.items(), reverse=True)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(bins, runs of one bin) until no piece is left.  ``counts[n]`` is the pieces of length n."""
    counts = counts.copy()
    bins = []
    while counts.any():
        runs = fill(counts, capacity)
        times = min(int(counts[length]) // n for length, n in runs)
        for length, n in runs:
            counts[length] -= times * n
        bins.append((times, runs))
    return bins


def intervals(bins: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, pieces per bin, first bin, offset): where the ranks of a length go."""
    rank: dict[int, int] = {}
    rows, first = [], 0
    for times, runs in bins:
        at = 0
        for length, n in runs:
            rows.append((length, rank.get(length, 0), n, first, at))
            rank[length] = rank.get(length, 0) + times * n
            at += length * n
        first += times
    return rows


def ranked(rows: DataFrame, total: int, order: list[Column]) -> DataFrame:
    """Rows with ``rank`` from 0 within their length, numbered in buckets of bounded size."""
    parts = max(1, math.ceil(total / BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(parts)))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy("length", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("length", "bucket").orderBy(*order)
    return (
        rows.withColumn("within", F.row_number().over(within) - 1)
        .join(before, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("within"))
        .drop("bucket", "within", "before")
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    ``tokenizer`` is the path of a vocabulary file that every executor can read.
    ``with_ids`` adds the piece's ids; they are then written with the pieces.
    """
    cut = freeze(
        pieces(docs, tokenizer, capacity, doc_id, text, with_ids).withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    counts = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # capacity rows at most
        counts[r["length"]] = r["n"]
    spark = docs.sparkSession
    places = spark.createDataFrame(
        intervals(plan(counts, capacity)),
        "length bigint, first_rank bigint, per_bin bigint, first_bin bigint, at bigint",
    )
    # The intervals of a length as one sorted array; the last that starts at or before a
    # rank holds it.  All lengths together have as many intervals as the plan has runs.
    by_length = places.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("first_rank", "per_bin", "first_bin", "at"))).alias("places")
    )
    total = int(counts.sum())
    numbered = ranked(cut, total, [F.xxhash64(F.lit(3), "row"), F.col("row")])
    starts = F.filter("places", lambda p: p["first_rank"] <= F.col("rank"))
    inside = F.col("rank") - F.col("place.first_rank")
    return (
        numbered.join(by_length, "length")
        .withColumn("place", F.element_at(starts, -1))
        .select(
            *[c for c in cut.columns if c not in ("row", "ids")],
            (F.col("place.first_bin") + F.floor(inside / F.col("place.per_bin"))).cast("long").alias("sequence_id"),
            (F.col("place.at") + F.pmod(inside, F.col("place.per_bin")) * F.col("length"))
            .cast("long")
            .alias("offset"),
            *(["ids"] if with_ids else []),
        )
    )
