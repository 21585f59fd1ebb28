"""Prefix trie of conversations by union-find over sorted neighbours.

A turn becomes a 128-bit digest of its role and text, and a conversation the sequence of
its digests.  Sorted, conversations that share a prefix are neighbours, and the common
prefixes (LCP) of neighbours are the edges of a forest: taken from the deepest to the
shallowest, each joins the two components beside it at a branching node of that depth.
What lies between a component's node and the edge that joins it is a chain of nodes with
the same members.

Conversations are range-partitioned by sequence and id, so that copies of one conversation
spread over partitions.  Every partition joins what no neighbour can still reach; complete
nodes leave at once.  What remains is contracted: one row for each component along the
partition's two borders, with counts in place of members.  Rounds of ``FAN`` neighbouring
partitions join these rows in the same way until nothing is open.

A very long conversation is cut into blocks of ``BLOCK`` turns.  Blocks with the same turns
before them are a trie of their own, whose root is a last turn of the block before; blocks
are taken from the deepest on, one round each, and the totals of a root go to the nodes
above it.  So no row and no task holds a conversation or a group of copies as a whole.
SHA-256 is sequential by definition; the ids of copies that lie in several partitions are
joined there and hashed as a stream of such pieces.

Rows without a conversation are left out.  A null role or text is empty, null turns come
first, and turns of the same number go by their digests; repeated rows are turns of their
own.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.llm.common import freeze, union_all

BLOCK = 4096
#: Partitions that one task of a merging round joins.
FAN = 64
#: Bytes of sequences in a partition.
PARTITION_BYTES = 8 << 20
#: Rows up to which a table of references is broadcast; it grows with partitions, not with rows.
BROADCAST_ROWS = 500_000
DIGEST, COUNT = 16, 4
#: Conversations take turns of the one that starts their hundred, up to these many less one.
GROUP, HEADS = 100, 6
NOBODY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turn, digest, n): ``n`` is the text's code points."""
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.unhex(F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, what).cast("binary"))).alias("digest"),
        F.length(what).alias("n"),
    )


def sliced(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """``df`` sorted over all partitions and written; ``size`` bytes decide how many. ``slice`` numbers them."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / PARTITION_BYTES))
    ranged = df.repartitionByRange(parts, *order)
    return freeze(ranged.sortWithinPartitions(*order).withColumn("slice", F.spark_partition_id()))


class Places(NamedTuple):
    #: {slice: (its first conversation, that one's turns in earlier slices)}
    first: dict[int, tuple[int, int]]
    longest: int
    turns: int


def places(rows: DataFrame) -> Places:
    """Where conversations go on in the next slice: one row per slice at the driver."""
    each = rows.groupBy("slice", "conv_id").agg(F.count(F.lit(1)).alias("n"))
    ends = each.groupBy("slice").agg(
        F.min(F.struct("conv_id", "n")).alias("first"),
        F.max(F.struct("conv_id", "n")).alias("last"),
        F.max("n").alias("most"),
        F.sum("n").alias("turns"),
    )
    first: dict[int, tuple[int, int]] = {}
    open_id, seen, longest, total = None, 0, 0, 0
    for r in sorted(ends.collect(), key=lambda r: r["slice"]):
        before = seen if r["first"]["conv_id"] == open_id else 0
        first[r["slice"]] = (r["first"]["conv_id"], before)
        open_id = r["last"]["conv_id"]
        seen = r["last"]["n"] + (before if r["first"]["conv_id"] == open_id else 0)
        longest = max(longest, r["most"], before + r["first"]["n"])
        total += r["turns"]
    return Places(first, longest, total)


def pieces(rows: DataFrame, first: dict[int, tuple[int, int]], block: int) -> DataFrame:
    """(conv_id, start, digests, counts): turns that follow each other in one slice, a block at most."""
    known = rows.sparkSession.sparkContext.broadcast(first)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, at, start = None, 0, 0
        digests: list[bytes] = []
        counts: list[int] = []
        out: list[tuple] = []

        def flush() -> None:
            if digests:
                out.append((current, start, b"".join(digests), np.array(counts, "<i4").tobytes()))
                digests.clear()
                counts.clear()

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "start", "digests", "counts"])

        for batch in batches:
            for conv, digest, n, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != current:
                    flush()
                    top, before = known.value[part]
                    current, at = conv, before if conv == top else 0
                    start = at
                elif len(digests) == block:
                    flush()
                    start = at
                digests.append(digest)
                counts.append(n)
                at += 1
            if out:
                yield batch_of()
        flush()
        if out:
            yield batch_of()

    return rows.select("conv_id", "digest", "n", "slice").mapInArrow(
        cut, "conv_id bigint, start bigint, digests binary, counts binary"
    )


def joined(parts: Column, field: str) -> Column:
    """The bytes of a field of sorted structs, one after the other."""
    return F.aggregate(parts, F.lit(b""), lambda s, p: F.concat(s, p[field]))


def n_turns(digests: Column) -> Column:
    return (F.octet_length(digests) / DIGEST).cast("long")


def part_of(source: str | Column, skip: Column, n: Column, size: int) -> Column:
    """``n`` entries of ``size`` bytes after the first ``skip`` ones."""
    return F.substr(source, (skip * size + 1).cast("int"), (n * size).cast("int"))


def rebuilt(cut: DataFrame, block: int) -> DataFrame:
    """(conv_id, block, digests, counts): every conversation after it took its first turns.

    The first h turns are those of the conversation that starts the hundred, h hashed
    from the id.  Blocks lie at multiples of ``block`` in the new sequence.
    """
    ordered = F.array_sort(F.collect_list(F.struct("start", "digests", "counts")))
    heads = (
        cut.where((F.col("conv_id") % GROUP == 0) & (F.col("start") < HEADS - 1))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(ordered.alias("parts"))  # a row per turn sought at most
        .select(
            "base",
            F.substr(joined(F.col("parts"), "digests"), F.lit(1), F.lit((HEADS - 1) * DIGEST)).alias("head"),
            F.substr(joined(F.col("parts"), "counts"), F.lit(1), F.lit((HEADS - 1) * COUNT)).alias("head_counts"),
        )
    )
    own = cut.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("long")
    rows = (
        own.join(heads, "base", "left")
        .withColumn("h", h)
        .withColumn("head", F.coalesce("head", F.lit(b"")))
        .withColumn("head_counts", F.coalesce("head_counts", F.lit(b"")))
        .withColumn("n", n_turns(F.col("digests")))
        .withColumn("taken", F.least("h", n_turns(F.col("head"))))
        .withColumn("skip", F.least("n", F.greatest(F.col("h") - F.col("start"), F.lit(0))))
        # Depth of the piece's first turn that stays, and the turns up to the next border.
        .withColumn("at", F.col("start") + F.col("skip") - F.col("h") + F.col("taken"))
        .withColumn("fit", F.least(F.col("n") - F.col("skip"), F.lit(block) - F.pmod("at", F.lit(block))))
    )

    def entry(at: Column, source: str, skip: Column, n: Column) -> Column:
        counts = "counts" if source == "digests" else "head_counts"
        return F.struct(
            at.cast("long").alias("at"),
            part_of(source, skip, n, DIGEST).alias("digests"),
            part_of(counts, skip, n, COUNT).alias("counts"),
        )

    zero = F.lit(0).cast("long")
    rest = F.col("n") - F.col("skip") - F.col("fit")
    entries = F.array(
        # Every conversation has one piece that starts at 0; it brings the head, which may be empty.
        F.when(F.col("start") == 0, entry(zero, "head", zero, F.col("taken"))),
        F.when(F.col("fit") > 0, entry(F.col("at"), "digests", F.col("skip"), F.col("fit"))),
        F.when(
            rest > 0,
            entry(F.col("at") + F.col("fit"), "digests", F.col("skip") + F.col("fit"), rest),
        ),
    )
    return (
        rows.select("conv_id", F.explode(F.array_compact(entries)).alias("e"))
        .groupBy("conv_id", F.floor(F.col("e.at") / block).alias("block"))
        # At most a block of turns in a group; the bytes are those of its pieces.
        .agg(F.array_sort(F.collect_list("e")).alias("parts"))
        .select(
            "conv_id",
            "block",
            joined(F.col("parts"), "digests").alias("digests"),
            joined(F.col("parts"), "counts").alias("counts"),
        )
    )


def with_prefixes(blocks: DataFrame, block: int) -> DataFrame:
    """Blocks with ``grp``, which names the turns before them by 120 bits, and ``next``, those after a full one.

    A conversation whose last block is full ends in an empty one, so that the members of a
    trie's root are all there.
    """
    full = blocks.where(n_turns(F.col("digests")) == block).select("conv_id", (F.col("block") + 1).alias("block"))
    ends = full.join(blocks.select("conv_id", "block"), ["conv_id", "block"], "left_anti")
    empty = ends.select("conv_id", "block", F.lit(b"").alias("digests"), F.lit(b"").alias("counts"))
    order = Window.partitionBy("conv_id").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    # Sums of two hashes of (block, digests); a conversation has one row per block.
    digest = F.md5(F.concat(F.col("block").cast("string").cast("binary"), F.col("digests")))
    halves = [F.conv(F.substring(digest, k, 15), 16, 10).cast("decimal(38,0)") for k in (1, 16)]
    named = blocks.unionByName(empty).withColumn("a", halves[0]).withColumn("b", halves[1])

    def name(number: Column, frame) -> Column:
        sums = [F.coalesce(F.sum(c).over(frame), F.lit(0)).cast("string") for c in ("a", "b")]
        return F.concat_ws("/", number.cast("string"), *sums)

    here = F.col("block")
    return named.select(
        "conv_id", "block", "digests", "counts",
        F.when(here > 0, name(here, before)).otherwise(F.lit("")).alias("grp"),
        F.when(n_turns(F.col("digests")) == block, name(here + 1, upto)).alias("next"),
    )


class Part(NamedTuple):
    """A node whose members are not all known yet, and what is known of them."""

    group: str
    depth: int
    children: int
    members: int
    least: int
    leaves: int
    #: Saved tokens of the nodes below.
    below: int
    #: Node number, for children to name.
    node: int
    #: Ids of the members that end here, ascending; ``aside``: those of earlier rounds are kept apart.
    ends: list[int]
    aside: bool
    #: Of the trie of the next block: children, leaves, saved tokens, digest of the ends.
    sub: tuple | None
    #: Code points of the turns up to the depth, or more.
    counts: np.ndarray


#: Parent of a node: the next one of its chain, which has the same members.
SAME = -1


class Forest:
    """Joins neighbours by their common prefixes, from the deepest on."""

    def __init__(self, offset: int) -> None:
        self.offset = offset
        self.up: list[int] = []
        #: Smallest member of each complete node.
        self.least: dict[int, int] = {}
        #: [conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens, digest of the ends]
        self.nodes: list[list] = []
        #: The same with the group in front, for the roots of later blocks.
        self.roots: list[list] = []

    def new_node(self) -> int:
        self.up.append(len(self.up))
        return len(self.up) - 1

    def find(self, node: int) -> int:
        up = self.up
        while up[node] != node:
            up[node] = up[up[node]]
            node = up[node]
        return node

    def complete(self, part: Part, to: int) -> Part | None:
        """All members are known: write the node and the chain above it; the part at depth ``to``, if any."""
        children, leaves, below = part.children, part.leaves, part.below
        ends: str | None = None if part.aside else NOBODY
        if part.sub is not None:
            children, leaves, below, ends = part.sub
        elif part.ends:
            ends = hashlib.sha256(",".join(map(str, part.ends)).encode()).hexdigest()
        if not children:
            leaves = 1
        self.least[self.find(part.node)] = part.least
        for depth in range(part.depth, to, -1):
            if depth:
                below += (part.members - 1) * int(part.counts[depth - 1])
            row = [part.least, self.offset + depth, SAME if depth else None, part.members, children, leaves, below, ends]
            if depth or not self.offset:
                self.nodes.append(row)
            else:
                self.roots.append([part.group, *row])
            children, ends = 1, NOBODY
        if to < 0:
            return None
        node = self.nodes[-1][2] = self.new_node()
        return Part(part.group, to, 1, part.members, part.least, leaves, below, node, [], False, None, part.counts)

    def join(self, a: Part, b: Part) -> Part:
        self.up[self.find(b.node)] = self.find(a.node)
        a.ends.extend(b.ends)
        return Part(
            a.group, a.depth, a.children + b.children, a.members + b.members, min(a.least, b.least),
            a.leaves + b.leaves, a.below + b.below, a.node, a.ends, a.aside or b.aside, a.sub or b.sub, a.counts,
        )

    def grow(self, parts: list[Part], edges: list[int], left: int, right: int) -> list[tuple[int, Part]]:
        """Join whatever no row beyond this range can reach; the rest, each with its edge to the one before.

        ``edges[i]`` is the common prefix of parts i and i + 1 (-1: of different tries),
        ``left`` and ``right`` those with the rows beyond.
        """
        n = len(parts)
        held: list[Part | None] = list(parts)
        #: Component of a position, by its first one, and the last position of each.
        ahead, last = list(range(n)), list(range(n))

        def first(i: int) -> int:
            while ahead[i] != i:
                ahead[i] = ahead[ahead[i]]
                i = ahead[i]
            return i

        # Depths up to which rows elsewhere may belong to the component: those of the borders
        # and of edges that could not join.
        shared = [left, *[-1] * (n - 1), right]
        for k in sorted((k for k in range(n - 1) if edges[k] >= 0), key=lambda k: -edges[k]):
            depth, i, j = edges[k], first(k), k + 1
            for at in (i, j):
                if held[at].depth > depth and max(shared[at], shared[last[at] + 1]) <= depth:
                    held[at] = self.complete(held[at], depth)
            if held[i].depth == held[j].depth == depth:
                held[i], held[j] = self.join(held[i], held[j]), None
                ahead[j], last[i] = i, last[j]
            else:
                shared[j] = depth
        out = []
        for i, part in enumerate(held):
            if part is not None:
                before = edges[i - 1] if i else left
                after = edges[last[i]] if last[i] < n - 1 else right
                if before < 0 and after < 0:
                    self.complete(part, -1)
                else:
                    out.append((before, part))
        return out


NODE, ROOT, OPEN, LINK, ENDS = range(5)
ROWS = (
    "kind int, grp string, conv_id bigint, depth bigint, parent bigint, parent_ref string, members bigint,"
    " children bigint, leaves bigint, saved bigint, ends string, ref string, slice int, seq int, edge int,"
    " sub array<string>, counts binary"
)
ARROW = pa.schema(
    [
        ("kind", pa.int32()), ("grp", pa.string()), ("conv_id", pa.int64()), ("depth", pa.int64()),
        ("parent", pa.int64()), ("parent_ref", pa.string()), ("members", pa.int64()), ("children", pa.int64()),
        ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()), ("ref", pa.string()),
        ("slice", pa.int32()), ("seq", pa.int32()), ("edge", pa.int32()), ("sub", pa.list_(pa.string())),
        ("counts", pa.binary()),
    ]
)


def rows_of(forest: Forest, left_over: list[tuple[int, Part]], links: list[tuple[str, int]], name: str, at: int) -> pa.Table:
    """Everything a task found, as rows of ``ROWS``.

    NODE and ROOT: complete nodes.  OPEN: what the next round goes on with.  LINK: a node
    of the round before and its smallest member, or the node that it became.  ENDS: ids of
    conversations that end at an open node.
    """
    def known(node: int | None, same: int | None = None) -> tuple[int | None, str | None]:
        if node is None or node == SAME:
            return (same if node == SAME else None), None
        root = forest.find(node)
        return (forest.least[root], None) if root in forest.least else (None, f"{name}.{root}")

    rows = forest.nodes + [r[1:] for r in forest.roots]
    conv, depth, above, members, children, leaves, saved, ends = zip(*rows, strict=True) if rows else [()] * 8
    parent, parent_ref = zip(*map(known, above, conv), strict=True) if rows else [()] * 2
    none = [None] * len(rows)
    columns = [
        [NODE] * len(forest.nodes) + [ROOT] * len(forest.roots), none[: len(forest.nodes)] + [r[0] for r in forest.roots],
        conv, depth, parent, parent_ref, members, children, leaves, saved, ends, *[none] * 6,
    ]
    found = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)
    out: list[dict] = []
    for ref, node in links:
        conv, became = known(node)
        out.append({"kind": LINK, "ref": ref, "parent": conv, "parent_ref": became})
    for seq, (edge, p) in enumerate(left_over):
        ref = f"{name}.{forest.find(p.node)}"
        if p.ends:
            text = ",".join(map(str, p.ends))
            out.append({"kind": ENDS, "ref": ref, "depth": forest.offset + p.depth, "slice": at, "ends": text})
        out.append(
            {
                "kind": OPEN, "grp": p.group, "conv_id": p.least, "depth": p.depth, "members": p.members,
                "children": p.children, "leaves": p.leaves, "saved": p.below,
                "ends": "aside" if p.aside or p.ends else None, "ref": ref, "slice": at, "seq": seq, "edge": edge,
                "sub": None if p.sub is None else list(map(str, p.sub)),
                "counts": p.counts[: p.depth].astype("<i4").tobytes(),
            }
        )
    return pa.concat_tables([found, pa.Table.from_pylist(out, schema=ARROW)])


def common_turns(a: bytes, b: bytes) -> int:
    """Digests that two sequences begin with alike."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // DIGEST
    at = 0
    while a[at : at + DIGEST] == b[at : at + DIGEST]:
        at += DIGEST
    return at // DIGEST


def borders(items: DataFrame) -> tuple[dict[int, int], list[int]]:
    """{slice: its rank} and the common prefix of each slice, by rank, with the one before (-1 at both ends).

    The driver sees the first and the last sequence of each partition, a block at most.
    """
    key = F.struct("grp", "digests")
    ends = items.groupBy("slice").agg(F.min(key).alias("first"), F.max(key).alias("last")).collect()
    ends.sort(key=lambda r: r["slice"])
    lefts = [-1]
    for a, b in zip(ends, ends[1:], strict=False):
        same = a["last"]["grp"] == b["first"]["grp"]
        lefts.append(common_turns(bytes(a["last"]["digests"]), bytes(b["first"]["digests"])) if same else -1)
    return {r["slice"]: k for k, r in enumerate(ends)}, [*lefts, -1]


def local_forests(items: DataFrame, ranks: dict[int, int], lefts: list[int], offset: int, name: str) -> DataFrame:
    """Round 0: each slice's conversations, sorted, are the parts."""
    known = items.sparkSession.sparkContext.broadcast((ranks, lefts))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lefts = None, known.value[1]
        forest, parts, edges = Forest(offset), [], []
        last_group, last = None, b""
        for batch in batches:
            for group, digests, counts, conv, part, sub in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = known.value[0][part]
                if parts:
                    edges.append(common_turns(last, digests) if group == last_group else -1)
                last_group, last = group, digests
                sub = None if sub is None else (int(sub[0]), int(sub[1]), int(sub[2]), sub[3])
                parts.append(
                    Part(group, len(digests) // DIGEST, 0, 1, conv, 0, 0, forest.new_node(), [] if sub else [conv], False,
                         sub, np.frombuffer(counts, "<i4"))
                )
        if parts:
            left_over = forest.grow(parts, edges, lefts[at], lefts[at + 1])
            yield from rows_of(forest, left_over, [], f"{name}.{at}", at).to_batches(max_chunksize=10_000)

    return items.select("grp", "digests", "counts", "conv_id", "slice", "sub").mapInArrow(run, ROWS)


def merged_forests(open_parts: DataFrame, lefts: list[int], offset: int, name: str, width: int) -> DataFrame:
    """A later round: what ``width`` neighbouring slices left open, joined in one task."""
    known = open_parts.sparkSession.sparkContext.broadcast(lefts)

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("slice", "ascending"), ("seq", "ascending")]).to_pylist()
        bunch, lefts = rows[0]["slice"] // width, known.value
        forest, parts, links = Forest(offset), [], []
        for r in rows:
            sub = r["sub"] and (*map(int, r["sub"][:3]), r["sub"][3])
            node = forest.new_node()
            links.append((r["ref"], node))
            parts.append(
                Part(r["grp"], r["depth"], r["children"], r["members"], r["conv_id"], r["leaves"], r["saved"], node,
                     [], r["ends"] is not None, sub, np.frombuffer(r["counts"], "<i4"))
            )
        # A slice that left nothing open shares no turn with the ones beside it.
        edges, right = [r["edge"] for r in rows], lefts[min((bunch + 1) * width, len(lefts) - 1)]
        left_over = forest.grow(parts, edges[1:], edges[0], right)
        return rows_of(forest, left_over, links, f"{name}.{bunch}", bunch * width)

    bunched = open_parts.withColumn("bunch", F.floor(F.col("slice") / width))
    return bunched.groupBy("bunch").applyInArrow(lambda t: run(t.drop_columns(["bunch"])), ROWS)


def small(df: DataFrame) -> DataFrame:
    """``df``, written, to be broadcast if it has few rows: references grow with partitions, not with rows."""
    df = freeze(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def hashed_ends(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, sha): the digest of the pieces of each node's ids, in the order of slices.

    A piece is a slice's ids as one text; a task streams them and keeps one hash.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        out: list[tuple] = []
        for batch in batches:
            for conv, depth, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (conv, depth) != key:
                    if state is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (conv, depth), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
        if state is not None:
            out.append((*key, state.hexdigest()))
        if out:
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["conv_id", "depth", "sha"])

    return (
        ends.repartition("conv_id", "depth")
        .sortWithinPartitions("conv_id", "depth", "slice")
        .select("conv_id", "depth", "ends")
        .mapInArrow(run, "conv_id bigint, depth bigint, sha string")
    )


def trie_nodes(items: DataFrame, size: int, offset: int) -> tuple[DataFrame, DataFrame]:
    """Nodes below the tries' roots (and the root itself at offset 0), and roots of later blocks.

    ``items`` has (grp, digests, counts, conv_id, sub).
    """
    items = sliced(items, ["grp", "digests", "conv_id"], size)
    ranks, lefts = borders(items)
    width = 1
    rounds = [freeze(local_forests(items, ranks, lefts, offset, f"{offset}.0"))]
    while width < len(lefts) - 1:
        left_open = rounds[-1].where(F.col("kind") == OPEN)
        width *= FAN
        rounds.append(freeze(merged_forests(left_open, lefts, offset, f"{offset}.{len(rounds)}", width)))
    # What each node of an earlier round became, from the last round back.
    resolved = None
    for r in reversed(rounds[1:]):
        links = r.where(F.col("kind") == LINK).select("ref", F.col("parent").alias("least"), "parent_ref")
        if resolved is not None:
            later = resolved.select(F.col("ref").alias("parent_ref"), F.col("least").alias("later"))
            links = links.join(later, "parent_ref", "left").withColumn("least", F.coalesce("least", "later"))
        links = links.select("ref", "least")
        resolved = links if resolved is None else resolved.unionByName(links)
    every = union_all(rounds)
    done = every.where(F.col("kind").isin(NODE, ROOT))
    if resolved is not None:
        resolved = small(resolved)
        direct, waiting = done.where("parent_ref is null"), done.where("parent_ref is not null")
        found = resolved.select(F.col("ref").alias("parent_ref"), "least")
        waiting = waiting.join(found, "parent_ref").withColumn("parent", F.col("least")).select(*done.columns)
        done = direct.unionByName(waiting)
        # Only nodes at the borders of slices keep ends aside.
        ends = every.where(F.col("kind") == ENDS).select("ref", "depth", "slice", "ends")
        ends = ends.join(resolved, "ref").select(F.col("least").alias("conv_id"), "depth", "slice", "ends")
        told, untold = done.where("ends is not null"), done.where("ends is null")
        untold = untold.join(small(hashed_ends(ends)), ["conv_id", "depth"]).withColumn("ends", F.col("sha"))
        done = told.unionByName(untold.select(*done.columns))
    return done.where(F.col("kind") == NODE), done.where(F.col("kind") == ROOT)


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations; see the contract's columns.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.
    """
    order = ["conv_id", "turn", "digest"]
    plain = turns(conversations, conv_id, turn, role, text)
    rows = sliced(plain, order, plain.select("conv_id").count() * (DIGEST + 24))
    at = places(rows)
    blocks = rebuilt(pieces(rows, at.first, block), block)
    size = at.turns * (DIGEST + COUNT)
    no_sub = F.lit(None).cast("array<string>").alias("sub")
    if at.longest + HEADS < block:
        found, _ = trie_nodes(blocks.select(F.lit("").alias("grp"), "digests", "counts", "conv_id", no_sub), size, 0)
    else:
        blocks = freeze(with_prefixes(blocks, block))
        levels, totals = [], None
        for level in range((at.longest + HEADS) // block, -1, -1):
            items = blocks.where(F.col("block") == level)
            if totals is None:
                items = items.select("grp", "digests", "counts", "conv_id", no_sub)
            else:
                items = items.join(totals, "next", "left").select("grp", "digests", "counts", "conv_id", "sub")
            nodes, roots = trie_nodes(items, size, level * block)
            levels.append(nodes)
            totals = freeze(
                roots.select(
                    F.col("grp").alias("next"),
                    F.array(*[F.col(c).cast("string") for c in ("children", "leaves", "saved")], "ends").alias("sub"),
                )
            )
        found = union_all(levels)
    return found.select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
