"""Benchmark passages in training text, by spaced seeds.

A spaced seed is a fixed mask: it reads six of the next seven to ten words and ignores
the others, so a substituted word under a gap does no harm.  With the four masks below
any twelve words with two substitutions, and any fifteen with three, still have a hit.
Items of six to eleven words have a shorter seed besides, three words long, which some
third of such an item holds unless over a fifth of it is substituted.  Items of one to five
words have seeds of their own, short enough for every text that may agree in 80 %: four
words or fewer have to be there word for word, of five one may be substituted.  Hashes of all masks
at all places of the training texts are joined with those of the benchmark; around each
hit the texts are compared word by word along the hit's diagonal, and an overlap counts
if ``MIN_WORDS`` words or more (or the whole item, if it is shorter) agree in 80 % or more.

The benchmark is the small side.  It is read in blocks of at most ``BLOCK_WORDS`` words (an
item longer than that is a block of its own), and each block is broadcast with its hash
table, so memory is bounded by a block or the longest item, whatever the benchmark's size.
Training texts are never shuffled; ``overlaps`` scans them once per block, and
``drop_contaminated`` once in all.
Within a task the hash join is a bitmap lookup and a binary search over numpy arrays.

On a diagonal the longest run counts, then the longest ones before and after it, and so on.
Of one item's overlaps with a text those stay that do not lie within a longer one of them
(of equal places in the text the one earlier in the item stays), so an item that a text holds
twice, or in two passages, has two rows.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased.
Null, empty and wordless texts and items have no overlaps.  A benchmark item of one common
word overlaps every text that holds the word; ``least_item`` leaves out items of fewer words
where that is not wanted.  Equal benchmark texts count once, under
their smallest id.  Repeated documents each have rows of their own.  An empty table on either side gives no overlaps.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidmedia.llm.common import ASCII_LOWER, binary, union_all

MASKS = [
    (0, 1, 2, 3, 4, 5),
    (0, 1, 2, 3, 5, 6),
    (0, 2, 3, 6, 7, 8),
    (0, 1, 5, 7, 8, 9),
]
#: The further seed of items with SHORT_ITEM[0] to SHORT_ITEM[1] words.
SHORT_MASK, SHORT_ITEM = (0, 1, 2), (6, 11)
#: The seeds of items with one to five words, by their number.
TINY_MASKS = {1: (0,), 2: (0, 1), 3: (0, 1, 2), 4: (0, 1, 2), 5: (0, 1)}
MIN_WORDS = 13
SIMILARITY = 0.8
BLOCK_WORDS = 400_000
#: Bits of the table that rules out most hashes, and the words hashed at a time.
TABLE_BITS, SLICE = 22, 1 << 18

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MULTIPLIERS = np.array([(xxhash.xxh64_intdigest(bytes([i]), 0) | 1) for i in range(8)], np.uint64)


def word_hashes(text: bytes | None) -> np.ndarray:
    words = WORD.findall((text or b"").translate(ASCII_LOWER))
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def masks_for(n_words: int) -> list[tuple[int, ...]]:
    """The seeds of an item of so many words."""
    if n_words in TINY_MASKS:
        return [TINY_MASKS[n_words]]
    return [*MASKS, SHORT_MASK] if SHORT_ITEM[0] <= n_words <= SHORT_ITEM[1] else MASKS


def seed_hashes(tokens: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """One hash for each place where the whole mask fits."""
    places = len(tokens) - mask[-1]
    if places <= 0:
        return np.empty(0, np.uint64)
    out = np.full(places, np.uint64(len(mask)))
    for offset, factor in zip(mask, MULTIPLIERS, strict=False):
        out += tokens[offset : offset + places] * factor
    out ^= out >> np.uint64(29)
    out *= MULTIPLIERS[-1]
    return out


class Block:
    """Some benchmark items with the sorted hashes of their seeds."""

    def __init__(self, items: list[tuple[int | None, bytes]]) -> None:
        self.ids = [i for i, _ in items]
        self.tokens = [word_hashes(t) for _, t in items]
        # Texts are hashed by the short seed only where an item has it.
        self.masks = sorted({m for tokens in self.tokens for m in masks_for(len(tokens))})
        hashes, item, place = [], [], []
        for k, tokens in enumerate(self.tokens):
            for mask in masks_for(len(tokens)):
                h = seed_hashes(tokens, mask)
                hashes.append(h)
                item.append(np.full(len(h), k))
                place.append(np.arange(len(h)))
        joined = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(joined, kind="stable")
        self.hashes = joined[order]
        self.item = np.concatenate(item)[order] if item else np.empty(0, int)
        self.place = np.concatenate(place)[order] if place else np.empty(0, int)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.hashes >> np.uint64(64 - TABLE_BITS)] = True

    def hits(self, tokens: np.ndarray) -> set[tuple[int, int]]:
        """(item, diagonal) of every seed that a text shares with an item."""
        found: set[tuple[int, int]] = set()
        for mask in self.masks:
            for at in range(0, len(tokens), SLICE):
                h = seed_hashes(tokens[at : at + SLICE + mask[-1]], mask)
                maybe = np.flatnonzero(self.table[h >> np.uint64(64 - TABLE_BITS)])
                if not len(maybe):
                    continue
                low = np.searchsorted(self.hashes, h[maybe], "left")
                high = np.searchsorted(self.hashes, h[maybe], "right")
                for place, i, j in zip(maybe[high > low], low[high > low], high[high > low], strict=True):
                    found.update(
                        zip(self.item[i:j].tolist(), (at + int(place) - self.place[i:j]).tolist(), strict=True)
                    )
        return found

    def overlaps(self, tokens: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(item, place in the text, place in the item, words, equal words) of every overlap."""
        for k, diagonal in self.hits(tokens):
            item = self.tokens[k]
            start, end = max(0, -diagonal), min(len(item), len(tokens) - diagonal)
            same = item[start:end] == tokens[start + diagonal : end + diagonal]
            for at, length in agreements(same, min(MIN_WORDS, len(item))):
                first = start + at
                yield k, first + diagonal, first, length, int(same[at : at + length].sum())

    def any_overlap(self, tokens: np.ndarray) -> bool:
        return next(self.overlaps(tokens), None) is not None

    def maximal(self, tokens: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """The overlaps that do not lie within another one of the same item, in text order."""
        out: list[tuple[int, int, int, int, int]] = []
        for row in sorted(self.overlaps(tokens), key=lambda r: (r[0], r[1], -r[3], r[2])):
            # Starts rise, so a row lies within an earlier one if it ends no later than the last kept.
            if not out or out[-1][0] != row[0] or row[1] + row[3] > out[-1][1] + out[-1][3]:
                out.append(row)
        return out


def agreements(same: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the longest run, then of those in what is left on both sides of it."""
    parts = [(0, len(same))]
    while parts:
        low, high = parts.pop()
        at, length = longest_agreement(same[low:high], least)
        if length:
            yield low + at, length
            parts += [(low, low + at), (low + at + length, high)]


def longest_agreement(same: np.ndarray, least: int) -> tuple[int, int]:
    """(start, length) of the longest run of ``least`` or more places with 80 % equal; else (0, 0).

    A run starts and ends with an equal place.  Scores +1 and -4 have a sum of zero or
    more where four of five agree, so a run is a pair of prefix sums that do not fall.
    """
    if not least or len(same) < least or same.sum() < SIMILARITY * least:
        return 0, 0
    prefix = np.concatenate([[0], np.cumsum(np.where(same, 1, -4))])
    lowest = np.minimum.accumulate(prefix)
    starts = np.searchsorted(-lowest, -prefix, "left")
    lengths = np.arange(len(prefix)) - starts
    end = int(lengths.argmax())
    start, length = int(starts[end]), int(lengths[end])
    if length < least:
        return 0, 0
    inner = np.flatnonzero(same[start : start + length])
    first, last = int(inner[0]), int(inner[-1])
    return (start + first, last - first + 1) if last - first + 1 >= least else (start, length)


def blocks_of(benchmark: DataFrame, item_id: str, text: str, least_item: int) -> Iterator[Block]:
    """The benchmark's distinct texts of enough words in blocks, fetched one partition at a time."""
    distinct = (
        benchmark.where(F.col(text).isNotNull())
        .groupBy(F.col(text).alias("text"))
        .agg(F.min(item_id).alias("item_id"))
    )
    items: list[tuple[int | None, bytes]] = []
    words = 0
    for row in distinct.toLocalIterator():
        data = row["text"].encode()
        n = len(WORD.findall(data))
        if n < least_item:
            continue
        if items and words + n > BLOCK_WORDS:
            yield Block(items)
            items, words = [], 0
        items.append((row["item_id"], data))
        words += n
    if items:
        yield Block(items)


OVERLAP = (
    "item_id bigint, first_word bigint, item_word bigint, n_words bigint, n_same bigint"
)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least_item: int = 1,
) -> DataFrame:
    """(doc_id, item_id, first_word, item_word, n_words, n_same): the overlaps of each item with a text.

    Places count words from 0; ``n_same`` of the ``n_words`` words agree.
    """
    sc = docs.sparkSession.sparkContext
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def of_block(shared) -> DataFrame:
        def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                rows = []
                ids = batch.column(0).to_pylist()
                for i, data in zip(ids, binary(batch.column(1)), strict=True):
                    for k, *place in block.maximal(word_hashes(data)):
                        rows.append((i, block.ids[k], *place))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.int64()) for c in columns],
                    names=["doc_id", "item_id", "first_word", "item_word", "n_words", "n_same"],
                )

        return narrow.mapInArrow(scan, f"doc_id bigint, {OVERLAP}")

    parts = [of_block(sc.broadcast(b)) for b in blocks_of(benchmark, item_id, item_text, max(1, least_item))]
    if not parts:
        return docs.sparkSession.createDataFrame([], f"doc_id bigint, {OVERLAP}")
    return union_all(parts)


def contaminated(text: Column, blocks: Iterable[Block], docs: DataFrame) -> Column:
    """Column: whether a text overlaps any item of the blocks; never null."""
    sc = docs.sparkSession.sparkContext
    found = F.lit(False)

    def of_block(shared) -> Column:
        @F.arrow_udf("boolean")
        def test(column: pa.Array) -> pa.Array:
            block = shared.value
            return pa.array([block.any_overlap(word_hashes(t)) for t in binary(column)], pa.bool_())

        return test(text)

    for block in blocks:
        found = found | of_block(sc.broadcast(block))
    return found


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least_item: int = 1,
) -> DataFrame:
    """``docs`` without the rows whose text overlaps a benchmark item of ``least_item`` words or more."""
    blocks = blocks_of(benchmark, item_id, item_text, max(1, least_item))
    return docs.where(~contaminated(F.col(text), blocks, docs))
