"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters the network as a word embedding and as its character n-grams' embeddings,
mean-pooled, each with the word's and n-grams' log odds of standing in a toxic document.
Two gated recurrent layers read a window of words in both directions, attention pools
their states, and a logistic unit scores the pool.  Windows of ``WINDOW`` words overlap by
half and cover the whole text; a document's score is that of its highest window.

Fitting takes a bounded sample of labelled rows (``TOXIC_ROWS`` and ``CLEAN_ROWS`` ids of
the smallest hashes, never held-out ones).  One Spark pass counts their words and n-grams,
one picks the windows to learn from, and the network is trained in numpy on those.
Scoring is one pass over all texts in numpy, in chunks of bounded size, and shuffles none.

A null or empty text scores 0.  A label counts as toxic if any of the id's labels does;
null ids and labels are not learned from.  Repeated rows each have a score.  Without
labels of both kinds every score is 0.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidmedia.llm.common import binary

WINDOW, STRIDE = 32, 16
TOXIC_ROWS, CLEAN_ROWS = 3_000, 6_000
#: The most suspicious windows of a clean document to learn from.
TOP_WINDOWS = 2
WORD_BUCKETS, GRAM_BUCKETS, GRAMS = 1 << 16, 1 << 16, (3, 4, 5)
DIM, HIDDEN, ATTENTION, FOLDS = 4, 8, 8, 4
STEPS, BATCH, SEED = 500, 128, 11
RATE, EMBEDDING_RATE = 0.01, 0.02
#: Words a task keeps the inputs of, and words it scores at a time.
MEMO_WORDS, CHUNK_WORDS, CHUNK_WINDOWS = 250_000, 100_000, 2048
THRESHOLD = 0.3

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def word_buckets(words: list[bytes]) -> np.ndarray:
    h = np.fromiter(map(xxhash.xxh32_intdigest, words), np.int64, len(words))
    return h & (WORD_BUCKETS - 1)


def gram_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of the character n-grams of words, in order of the words."""
    marked = b"".join([b"^" + w + b"$" for w in words])
    data = np.frombuffer(marked, np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    owners, hashes = [], []
    for n in GRAMS:
        last = len(data) - n + 1
        if last <= 0:
            continue
        h = np.full(last, np.uint64(n))
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + data[k : k + last]
        inside = owner[:last] == owner[n - 1 :]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        owners.append(owner[:last][inside])
        hashes.append((h[inside] >> np.uint64(40)).astype(np.int64) & (GRAM_BUCKETS - 1))
    owners, hashes = np.concatenate(owners), np.concatenate(hashes)
    order = np.argsort(owners, kind="stable")
    return owners[order], hashes[order]


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log odds of a bucket's presence, drawn to zero where it was seen in few documents."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    seen = toxic + clean
    return odds * seen / (seen + 10)


def starts_of(n_words: int) -> range:
    """Where the windows of a text start; together they cover all its words."""
    return range(0, max(1, n_words - STRIDE), STRIDE)


class Inputs:
    """The network's input for words: embeddings and log odds of the word and its n-grams.

    ``counts[f, toxic]`` has the documents of fold f by bucket: the number of documents,
    then those with each word bucket, then those with each n-gram bucket.  A text that is
    learned from meets the odds of the other folds, as a new text would.
    """

    size = 2 * DIM + 2

    def __init__(self, counts: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        total = counts.sum(axis=0)
        self.odds = [self._odds(total - counts[f]) for f in range(FOLDS)] + [self._odds(total)]
        self.words = rng.normal(0, 0.02, (WORD_BUCKETS, DIM)).astype(np.float32)
        self.grams = rng.normal(0, 0.02, (GRAM_BUCKETS, DIM)).astype(np.float32)

    @staticmethod
    def _odds(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        clean, toxic = counts.astype(float)
        odds = log_odds(toxic[1:], clean[1:], toxic[0], clean[0]).astype(np.float32)
        return odds[:WORD_BUCKETS], odds[WORD_BUCKETS:]

    def parts(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        buckets = word_buckets(words)
        owner, grams = gram_buckets(words)
        first = np.searchsorted(owner, np.arange(len(words)))
        return buckets, owner, grams, first

    def of(self, words: list[bytes]) -> np.ndarray:
        parts = self.parts(words)
        return self.combine(*parts, self.evidence(*parts, FOLDS))

    def evidence(self, buckets: np.ndarray, owner: np.ndarray, grams: np.ndarray, first: np.ndarray, fold: int) -> np.ndarray:
        """The log odds of each word and the highest of its n-grams."""
        words, of_grams = self.odds[fold]
        return np.stack([words[buckets], np.maximum.reduceat(of_grams[grams], first)], axis=1)

    def combine(
        self, buckets: np.ndarray, owner: np.ndarray, grams: np.ndarray, first: np.ndarray, evidence: np.ndarray
    ) -> np.ndarray:
        n = np.bincount(owner, minlength=len(buckets)).astype(np.float32)
        pooled = np.add.reduceat(self.grams[grams], first) / n[:, None]
        return np.concatenate([self.words[buckets], pooled, evidence], axis=1)

    def suspicion(self, words: list[bytes], fold: int) -> np.ndarray:
        """What the log odds alone say of each word."""
        return np.maximum(self.evidence(*self.parts(words), fold), 0).sum(axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Two gated recurrent layers of opposite direction, attention and a logistic unit."""

    def __init__(self, size: int) -> None:
        rng = np.random.default_rng(SEED + 1)

        def normal(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        self.p = {"A": normal(2 * HIDDEN, ATTENTION), "a": np.zeros(ATTENTION, np.float32), "v": normal(ATTENTION)}
        self.p |= {"w": normal(2 * HIDDEN), "o": np.full(1, -1, np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": normal(size, 3 * HIDDEN), f"U{d}": normal(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}

    def gates(self, inputs: np.ndarray) -> list[np.ndarray]:
        """What words add to the gates of each direction; it does not depend on their places."""
        return [inputs @ self.p[f"W{d}"] + self.p[f"c{d}"] for d in "fb"]

    def layer(self, gates: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (window, place, HIDDEN) from gate inputs (window, place, 3 HIDDEN)."""
        n, length, _ = gates.shape
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((n, length, HIDDEN), np.float32)
        weights = self.p[f"U{d}"]
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            g, u = gates[:, t], h @ weights
            zr = sigmoid(g[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(g[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            m = mask[:, t, None]
            after = h + m * (1 - z) * (new - h)
            if keep is not None:
                keep.append((t, h, z, r, new, u[:, 2 * HIDDEN :], m))
            h = after
            out[:, t] = h
        return out

    def attend(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = np.tanh(states @ self.p["A"] + self.p["a"])
        e = a @ self.p["v"]
        e = np.exp(e - e.max(axis=1, keepdims=True)) * mask
        alpha = e / (e.sum(axis=1, keepdims=True) + 1e-9)
        return a, alpha, np.einsum("ntk,nt->nk", states, alpha)

    def logits(self, tables: list[np.ndarray], rows: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Of windows whose word inputs are ``rows`` of each direction's table; as ``layer``, in place."""
        length, n = rows.shape
        states = np.empty((n, length, 2 * HIDDEN), np.float32)
        full = mask.all(axis=1)
        g, u = np.empty((2, n, 3 * HIDDEN), np.float32)
        zr, new = np.empty((n, 2 * HIDDEN), np.float32), np.empty((n, HIDDEN), np.float32)
        for i, d in enumerate("fb"):
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(length) if d == "f" else range(length - 1, -1, -1):
                np.take(tables[i], rows[t], axis=0, out=g, mode="clip")
                np.matmul(h, self.p[f"U{d}"], out=u)
                np.add(g[:, : 2 * HIDDEN], u[:, : 2 * HIDDEN], out=zr)
                np.negative(zr, out=zr)
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                np.multiply(zr[:, HIDDEN:], u[:, 2 * HIDDEN :], out=new)
                new += g[:, 2 * HIDDEN :]
                np.tanh(new, out=new)
                new -= h
                z = zr[:, :HIDDEN]
                np.subtract(1, z, out=z)
                new *= z
                if not full[t]:
                    new *= mask[t][:, None]
                h += new
                states[:, t, i * HIDDEN : (i + 1) * HIDDEN] = h
        return self.attend(states, mask.T)[2] @ self.p["w"] + self.p["o"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean log loss, for the parameters and for the inputs x."""
        p, n = self.p, len(y)
        kept: dict[str, list] = {"f": [], "b": []}
        states = [self.layer(x @ p[f"W{d}"] + p[f"c{d}"], mask, d, kept[d]) for d in "fb"]
        s = np.concatenate(states, axis=2)
        a, alpha, pool = self.attend(s, mask)
        dl = ((sigmoid(pool @ p["w"] + p["o"]) - y) / n).astype(np.float32)
        g = {"w": pool.T @ dl, "o": dl.sum(keepdims=True)}
        dpool = dl[:, None] * p["w"]
        dalpha = np.einsum("ntk,nk->nt", s, dpool)
        de = alpha * (dalpha - (alpha * dalpha).sum(axis=1, keepdims=True))
        da = de[..., None] * p["v"] * (1 - a * a)
        g |= {"v": np.einsum("ntk,nt->k", a, de), "A": np.einsum("nti,ntj->ij", s, da), "a": da.sum((0, 1))}
        ds = alpha[..., None] * dpool[:, None] + da @ p["A"].T
        dx = np.zeros_like(x)
        for i, d in enumerate("fb"):
            dstate, weights = ds[..., i * HIDDEN : (i + 1) * HIDDEN], p[f"U{d}"]
            dh = np.zeros((n, HIDDEN), np.float32)
            dgate = np.zeros((n, x.shape[1], 3 * HIDDEN), np.float32)
            g[f"U{d}"] = np.zeros_like(weights)
            for t, h, z, r, new, un, m in reversed(kept[d]):
                dh = dh + dstate[:, t]
                dm = dh * m
                dz, dn = dm * (h - new) * z * (1 - z), dm * (1 - z) * (1 - new * new)
                dr = dn * un * r * (1 - r)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                dgate[:, t] = np.concatenate([dz, dr, dn], axis=1)
                g[f"U{d}"] += h.T @ du
                dh = dh * (1 - m) + dm * z + du @ weights.T
            g[f"W{d}"] = np.einsum("nti,ntj->ij", x, dgate)
            g[f"c{d}"] = dgate.sum((0, 1))
            dx += dgate @ p[f"W{d}"].T
        return g, dx


def train(windows: list[bytes], folds: np.ndarray, labels: np.ndarray, inputs: Inputs) -> Network:
    """Fit the network and the embeddings to windows of words by Adam and Adagrad."""
    network = Network(inputs.size)
    rng = np.random.default_rng(SEED + 2)
    words = [w.split() for w in windows]
    vocabulary = sorted({w for ws in words for w in ws})
    number = {w: i for i, w in enumerate(vocabulary)}
    index = np.zeros((len(words), WINDOW), np.int64)
    mask = np.zeros((len(words), WINDOW), np.float32)
    for i, ws in enumerate(words):
        index[i, : len(ws)] = [number[w] for w in ws]
        mask[i, : len(ws)] = 1
    parts = buckets, owner, grams, first = inputs.parts(vocabulary)
    n_grams = np.bincount(owner, minlength=len(vocabulary))
    evidence = np.stack([inputs.evidence(*parts, f) for f in range(FOLDS)])
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in network.p.items()}
    squares = [np.full((n, DIM), 1e-6, np.float32) for n in (WORD_BUCKETS, GRAM_BUCKETS)]
    order = np.empty(0, np.int64)
    for step in range(1, STEPS + 1):
        while len(order) < BATCH:
            order = np.concatenate([order, rng.permutation(len(words))])
        rows, order = order[:BATCH], order[BATCH:]
        used, local = np.unique(index[rows], return_inverse=True)
        local = local.reshape(BATCH, WINDOW)
        # The n-grams of the words in use, renumbered.
        g_owner = np.repeat(np.arange(len(used)), n_grams[used])
        g_first = np.concatenate([[0], np.cumsum(n_grams[used])[:-1]])
        g_ids = grams[np.arange(len(g_owner)) - g_first[g_owner] + first[used][g_owner]]
        x = inputs.combine(buckets[used], g_owner, g_ids, g_first, np.zeros((len(used), 2), np.float32))[local]
        x[..., -2:] = evidence[folds[rows, None], index[rows]]
        grads, dx = network.gradients(x, mask[rows], labels[rows])
        for k, g in grads.items():
            m, v = moment[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            network.p[k] -= (RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        to_word = sums(local.ravel(), dx.reshape(-1, inputs.size)[:, : 2 * DIM], len(used))
        to_gram = (to_word[:, DIM:] / n_grams[used][:, None])[g_owner]
        for table, seen, ids, d in (
            (inputs.words, squares[0], buckets[used], to_word[:, :DIM]),
            (inputs.grams, squares[1], g_ids, to_gram),
        ):
            unique, back = np.unique(ids, return_inverse=True)
            g = sums(back, d, len(unique))
            seen[unique] += g * g
            table[unique] -= (EMBEDDING_RATE * g / np.sqrt(seen[unique])).astype(np.float32)
    return network


def sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Column sums of the rows of each group."""
    return np.stack([np.bincount(group, column, n) for column in values.T], axis=1)


class Gates(dict):
    """Word to row of the growing tables of gate inputs; row 0 is no word."""

    def __init__(self, inputs: Inputs, network: Network) -> None:
        self.inputs, self.network = inputs, network
        self.new: list[bytes] = []
        self.tables = [np.zeros((1, 3 * HIDDEN), np.float32) for _ in "fb"]
        self.rows = 1

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self) + 1
        self.new.append(word)
        return at

    def update_tables(self) -> None:
        if self.new:
            rows = self.rows + len(self.new)
            for i, new in enumerate(self.network.gates(self.inputs.of(self.new))):
                if rows > len(self.tables[i]):
                    more = np.zeros((rows, 3 * HIDDEN), np.float32)
                    self.tables[i] = np.concatenate([self.tables[i], more])
                self.tables[i][self.rows : rows] = new
            self.rows, self.new = rows, []

    def forget(self) -> None:
        self.clear()
        self.rows = 1


class Scorer:
    """Scores of whole texts, some thousand windows at a time."""

    def __init__(self, inputs: Inputs, network: Network) -> None:
        self.network, self.gates = network, Gates(inputs, network)

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for i, text in enumerate(texts):
            words = WORD.findall(text or b"")
            # A very long text goes in slices that end on a window's border.
            for at in range(0, len(words), CHUNK_WORDS // STRIDE * STRIDE):
                part = words[max(0, at - STRIDE) : at + CHUNK_WORDS // STRIDE * STRIDE]
                held.append((i, np.fromiter(map(self.gates.__getitem__, part), np.int64, len(part))))
                size += len(part)
                if size >= CHUNK_WORDS:
                    self.flush(held, out)
                    held, size = [], 0
        self.flush(held, out)
        return out

    def flush(self, held: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
        if not held:
            return
        self.gates.update_tables()
        words = np.concatenate([ids for _, ids in held] + [np.zeros(WINDOW, np.int64)])
        owners, starts, ends = [], [], []
        at = 0
        for i, ids in held:
            own = at + np.arange(0, max(1, len(ids) - STRIDE), STRIDE)
            owners.append(np.full(len(own), i))
            starts.append(own)
            ends.append(np.full(len(own), at + len(ids)))
            at += len(ids)
        owner, start, end = map(np.concatenate, (owners, starts, ends))
        for k in range(0, len(start), CHUNK_WINDOWS):
            place = start[None, k : k + CHUNK_WINDOWS] + np.arange(WINDOW)[:, None]
            mask = (place < end[None, k : k + CHUNK_WINDOWS]).astype(np.float32)
            rows = np.where(mask > 0, words[np.minimum(place, len(words) - 1)], 0)
            p = sigmoid(self.network.logits(self.gates.tables, rows, mask))
            np.maximum.at(out, owner[k : k + CHUNK_WINDOWS], p)
        if len(self.gates) > MEMO_WORDS:
            self.gates.forget()


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): at most TOXIC_ROWS and CLEAN_ROWS ids, chosen by their hash."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    by_hash = [F.xxhash64(F.lit(SEED), "doc_id"), F.col("doc_id")]
    toxic = known.where("toxic = 1").orderBy(*by_hash).limit(TOXIC_ROWS)
    return toxic.unionByName(known.where("toxic = 0").orderBy(*by_hash).limit(CLEAN_ROWS))


def lowered(column: pa.Array) -> list[bytes | None]:
    return binary(pc.utf8_lower(column))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[Inputs, Network] | None:
    """Inputs and network learned from the labelled rows that are not held out."""
    spark = docs.sparkSession
    picked = sampled_labels(labels).collect()  # TOXIC_ROWS + CLEAN_ROWS rows at most
    listed = spark.createDataFrame([(r["doc_id"], int(r["toxic"])) for r in picked], "label_id bigint, toxic int")
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sample = narrow.join(F.broadcast(listed), F.col("doc_id") == F.col("label_id")).select("toxic", "text")

    width = 1 + WORD_BUCKETS + GRAM_BUCKETS

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((FOLDS, 2, width), np.int32)
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), lowered(batch.column(1)), strict=True):
                add_document(seen[fold_of(text), toxic], text)
        flat = seen.ravel()
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used], pa.int64())], names=["cell", "n"])

    counted = (
        sample.mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    )  # one row per cell at most
    counts = np.zeros(FOLDS * 2 * width, np.int64)
    counts[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    counts = counts.reshape(FOLDS, 2, width)
    if not counts[:, :, 0].sum(axis=0).all():
        return None
    inputs = Inputs(counts)
    shared = spark.sparkContext.broadcast(inputs)

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for toxic, text in zip(batch.column(0).to_pylist(), lowered(batch.column(1)), strict=True):
                rows += [(toxic, fold_of(text), w) for w in windows_to_learn(shared.value, toxic, text)]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
            kinds = [pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["toxic", "fold", "words"]
            )

    windows = sample.mapInArrow(choose, "toxic int, fold int, words binary").toArrow()  # a few per sampled document
    rows = sorted(zip(*(windows[c].to_pylist() for c in ("words", "toxic", "fold")), strict=True))
    if not rows:
        return None
    texts, toxic, folds = zip(*rows, strict=True)
    network = train(list(texts), np.array(folds), np.array(toxic, np.float32), inputs)
    return inputs, network


def fold_of(text: bytes | None) -> int:
    """Equal texts are in the same fold."""
    return xxhash.xxh32_intdigest(text or b"") % FOLDS


def add_document(seen: np.ndarray, text: bytes | None) -> None:
    """Count a document and its distinct word and n-gram buckets."""
    words = list(set(WORD.findall(text or b"")))
    seen[0] += 1
    if words:
        seen[1 + np.unique(word_buckets(words))] += 1
        seen[1 + WORD_BUCKETS + np.unique(gram_buckets(words)[1])] += 1


def windows_to_learn(inputs: Inputs, toxic: int, text: bytes | None) -> list[bytes]:
    """The most suspicious window; of a clean text also the next ones and another."""
    words = WORD.findall(text or b"")
    if not words:
        return []
    starts = np.array(starts_of(len(words)))
    total = np.concatenate([[0], np.cumsum(inputs.suspicion(words, fold_of(text)))])
    order = np.argsort(-(total[np.minimum(starts + WINDOW, len(words))] - total[starts]), kind="stable")
    # A toxic text need not be toxic beyond its worst window.
    chosen = order[: 1 if toxic else TOP_WINDOWS].tolist()
    rest = len(order) - TOP_WINDOWS
    if not toxic and rest > 0:
        chosen.append(int(order[TOP_WINDOWS + xxhash.xxh32_intdigest(text, 1) % rest]))
    return [b" ".join(words[starts[k] : starts[k] + WINDOW]) for k in chosen]


def toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id, text))

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        if model.value is None:
            return pa.array(np.zeros(len(column)))
        scorer = model.value[1].__dict__.setdefault("scorer", Scorer(*model.value))
        return pa.array(scorer.scores(lowered(column)))

    return docs.select(
        F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), score(F.col(text)).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
