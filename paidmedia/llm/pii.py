"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

``base_spans`` are found by fixed patterns and always stay.  Besides, wider patterns give
candidates: masked addresses (name at host dot org), names with accents, IPv6, cards with
other separators, phones without a plus sign.  Each candidate, and each base span, is
judged by labelers that say yes, no or nothing: its strict shape, a check of its digits or
parts, a gazetteer (domain endings, issuers of cards, calling codes, reserved networks),
words that stand near it, for and against, and the characters beside it.

How often each pattern of votes occurs is counted over all documents (at most 3 ** 6 per
kind).  Expectation-maximisation over these counts estimates how reliable each labeler is
for each kind and, for each pattern, how likely the candidate is real.  A logistic
classifier over the votes, the span's shape and the words near it then learns these
likelihoods from a sample of distinct candidates: the ``SAMPLE`` of each kind with the
smallest hashes; a task sends no more than that.  Candidates that it gives ``LEAST`` or
more become spans where they overlap no base span and no earlier added one.

Every pattern passes a text in linear time and texts are read whole.  A null text is
empty.  Repeated rows are rows of their own, ids may be null, other columns are ignored,
and an empty table gives an empty result.  The two passes depend on their rows alone, so
a lost executor costs its running tasks.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paidmedia.llm.common import freeze

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Distinct candidates of each kind that the classifier learns from.
SAMPLE = 3000
#: Probability from which a candidate becomes a span.
LEAST = 0.9
#: Characters before and after a span that labelers and features look at.
NEAR = 48
FEATURES = 512
ROUNDS = 60

# Runs are taken whole (possessive), so that no pattern reads a character more than a few
# times; a run that does not go on as it should cannot begin a match further right either.
BASE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?+")
BASE_IP = re.compile(r"[0-9]++(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?+")
BASE_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
BASE_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
NOT_DIGITS = re.compile("[^0-9]+")


def digits_of(text: str) -> str:
    return NOT_DIGITS.sub("", text)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start, then kind."""
    out = []
    if "@" in text:
        out += [(m.start(), EMAIL, m.end()) for m in BASE_EMAIL.finditer(text) if m.group(1)]
    if DIGIT.search(text):
        if "." in text:
            for m in BASE_IP.finditer(text):
                if m.group(1) and all(map(at_most_255, m.group().split("."))):
                    out.append((m.start(), IP, m.end()))
        for m in BASE_CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = digits_of(m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), CARD, m.end()))
        if "+" in text:
            for m in BASE_PHONE.finditer(text):
                if 10 <= len(digits_of(m.group())) <= 15:
                    out.append((m.start(), PHONE, m.end()))
    return sorted(out)


MASKED_AT = re.compile(r"\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s", re.I)
MASKED_HOST = re.compile(r"\w[\w-]*+(?:(?:\s?[\[({<]\s?dot\s?[\])}>]\s?|\sdot\s|\.)\w[\w-]*+)++", re.I)
NAME_BEFORE = re.compile(r"[\w.%+-]+\Z")
WIDE_EMAIL = re.compile(r"[\w.%+-]++(@\w[\w-]*+(?:\.\w[\w-]*+)++)?+")
V6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}+(?::[0-9A-Fa-f]{0,4}+){2,7}+(?![\w:])")
NUMBERS = re.compile(r"\(?[0-9](?:[ ().\-/  ‑–]{0,3}+[0-9])++")


def wide_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates of the wider patterns; they may overlap base spans and each other."""
    out = []
    for m in MASKED_AT.finditer(text):
        name = NAME_BEFORE.search(text, max(0, m.start() - 64), m.start())
        host = MASKED_HOST.match(text, m.end())
        if name and host:
            out.append((name.start(), EMAIL, host.end()))
    if "@" in text and not text.isascii():
        out += [(m.start(), EMAIL, m.end()) for m in WIDE_EMAIL.finditer(text) if m.group(1)]
    if text.count(":") > 3:
        for m in V6.finditer(text):
            groups = m.group().split(":")
            if "::" in m.group() and sum(map(bool, groups)) > 2 or len(groups) == 8 and all(groups):
                out.append((m.start(), IP, m.end()))
    if DIGIT.search(text):
        for m in NUMBERS.finditer(text):
            n = len(digits_of(m.group()))
            if 13 <= n <= 19:
                out.append((m.start() + m.group().startswith("("), CARD, m.end()))
            if 7 <= n <= 15:
                out.append((m.start(), PHONE, m.end()))
    return out


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, base): base spans, and wider ones that overlap none of them, by start."""
    base = base_spans(text)
    wide = sorted(set(wide_spans(text)))
    out, k, reach = [(*s, True) for s in base], 0, 0
    for s in wide:
        while k < len(base) and base[k][0] < s[2]:
            reach = max(reach, base[k][2])
            k += 1
        # Base spans that begin before this one ends and end after it begins.
        if reach <= s[0]:
            out.append((*s, False))
    return sorted(out)


# Usual domain endings, calling codes of countries, prefixes and lengths of
# card issuers, and words for and against each kind in four languages.
ENDINGS = set(
    "com org net edu gov mil int info biz io dev app ai co me tv eu de fr es uk it nl be ch at pl pt se no dk fi ie"
    " cz sk hu ro gr ru ua tr us ca mx br ar cl pe au nz jp cn kr in sg hk tw za il ae example test".split()
)
CALLING = set(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84"
    " 86 90 91 92 93 94 95 98 212 213 216 218 351 352 353 354 358 359 370 371 372 380 385 386 420 421 852 886 971 972"
    .split()
)
ISSUERS = [
    (r"4", (13, 16, 19)),
    (r"5[1-5]", (16,)),
    (r"2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)", (16,)),
    (r"3[47]", (15,)),
    (r"6(?:011|4[4-9]|5)", (16, 17, 18, 19)),
    (r"35", (16, 17, 18, 19)),
    (r"3(?:0[0-5]|[689])", (14, 15, 16)),
]
FOR = (
    {"mail", "email", "e-mail", "contact", "write", "kontakt", "correo", "courriel", "address", "adresse"},
    {"ip", "host", "server", "login", "client", "address", "adresse", "ping", "addr"},
    {"card", "visa", "mastercard", "amex", "credit", "debit", "payment", "karte", "kreditkarte", "tarjeta", "carte"},
    {"phone", "tel", "telephone", "call", "mobile", "fax", "cell", "telefon", "handy", "teléfono", "téléphone", "móvil"},
)
AGAINST = (
    {"meet", "look", "arrive", "class", "method"},
    {"version", "release", "section", "chapter", "v", "build", "update"},
    {"isbn", "issn", "order", "invoice", "serial", "sku", "id", "tracking", "doi"},
    {"isbn", "issn", "order", "invoice", "serial", "sku", "id", "page", "pages", "version", "doi", "score", "years"},
)
WORDS = re.compile(r"[^\W_]+(?:-[^\W\d_]+)?")
STRICT_EMAIL = re.compile(r"[\w%+-]+(?:\.[\w%+-]+)*(?:@|\s?[\[({<]\s?at\s?[\])}>]\s?)\w[\w-]*(?:[^\w]+(?:dot[^\w]+)?[\w-]+)+", re.I)
STRICT_PHONE = re.compile(r"(?:\+[0-9]{1,3}|00[0-9]{1,3})?[ .-]?(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[ .-]?[0-9]{2,4}){2,4}")
GROUPED_CARD = re.compile(r"[0-9]{4}([^0-9]?)(?:[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{6}\1[0-9]{4,5})")
DATE = re.compile(r"(?:(?:19|20)[0-9]{2}\D[0-9]{1,2}\D[0-9]{1,2}|[0-9]{1,2}\D[0-9]{1,2}\D(?:19|20)[0-9]{2})(?!\d)")

YES, NOTHING, NO = "+", "0", "-"


def say(yes: bool, no: bool) -> str:
    return YES if yes else NO if no else NOTHING


def votes(text: str, start: int, kind: int, end: int, near: set[str]) -> str:
    """One character per labeler: shape, digits or parts, gazetteer, words for, words against, neighbours."""
    span = text[start:end]
    digits = digits_of(span)
    if kind == EMAIL:
        shape = bool(STRICT_EMAIL.fullmatch(span))
        host = WORDS.findall(re.split(r"@|\bat\b", span, maxsplit=1, flags=re.I)[-1])
        ending = host[-1].lower() if host else ""
        out = say(shape, not shape) + say(2 <= len(ending) <= 6 and ending.isalpha(), True) + say(ending in ENDINGS, True)
    elif kind == IP:
        parts = span.split(".") if "." in span else [p for p in span.split(":") if p]
        v4 = "." in span
        exact = all(p == (p.lstrip("0") or "0") for p in parts) if v4 else len(parts) > 3
        first = int(digits_of(parts[0])[:4] or 0) if v4 else 0
        out = say(exact, True) + say(len(parts) == 4 if v4 else "::" in span or len(parts) == 8, True)
        out += say(0 < first < 240, True) if v4 else say(parts[0].lower()[:2] in ("20", "26", "2a", "fe", "fd"), False)
    elif kind == CARD:
        issued = any(len(digits) in n and re.match(p, digits) for p, n in ISSUERS)
        out = say(bool(GROUPED_CARD.fullmatch(span)), True) + say(luhn(digits), True) + say(issued, True)
    else:
        plus, area = span.startswith("+"), span.startswith("(")
        out = say(bool(STRICT_PHONE.fullmatch(span)), True)
        out += say(plus or area or 10 <= len(digits) <= 12, len(digits) < 9 or bool(DATE.search(span)))
        known = any(digits[:n] in CALLING for n in (1, 2, 3)) if plus else area and digits[0] in "23456789"
        out += say(known or digits.startswith("00"), plus)
    before, after = text[start - 1 : start], text[end : end + 1]
    beside = before.isalnum() or after.isalnum() or before in ("/", "=", "_", "#", ".") and bool(before)
    return out + say(bool(near & FOR[kind]), False) + say(False, bool(near & AGAINST[kind])) + say(not beside, True)


def features(text: str, start: int, kind: int, end: int, ballot: str, near: list[str]) -> list[int]:
    """Slots of the classifier's inputs: the bias, the votes, and hashed shapes and words."""
    span = text[start:end][:80]
    shape = "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in span)
    shape = re.sub(r"a+", "a", shape)
    named = {f"s{shape[k : k + 3]}" for k in range(max(1, len(shape) - 2))} | {f"w{w}" for w in near}
    taken = 1 + 3 * len(ballot)
    hashed = {taken + int.from_bytes(hashlib.blake2b(f.encode(), digest_size=4).digest(), "little") % (FEATURES - taken) for f in named}
    return [0, *(1 + 3 * k + "+0-".index(v) for k, v in enumerate(ballot)), *sorted(hashed)]


def judged(text: str, start: int, kind: int, end: int) -> tuple[str, list[int]]:
    near = [w.lower() for w in WORDS.findall(text[max(0, start - NEAR) : start])[-6:]]
    near += [w.lower() for w in WORDS.findall(text[end : end + NEAR])[:3]]
    ballot = votes(text, start, kind, end, set(near))
    return ballot, features(text, start, kind, end, ballot, near)


LABELERS = 6
#: What a labeler says of a real candidate before any data, yes, nothing or no, and of another.
EXPECTED = np.array([[0.6, 0.25, 0.15], [0.15, 0.25, 0.6]])
#: Candidates that this expectation counts as much as.
STRENGTH = 10.0


def reliabilities(ballots: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM: how likely each ballot's candidates are real, and each labeler's votes by class.

    The second array is [real or not, labeler, yes/nothing/no].
    """
    said = np.array([["+0-".index(v) for v in b] for b in ballots])
    table = np.repeat(EXPECTED[:, None, :], LABELERS, axis=1)
    share = 0.5
    for _ in range(ROUNDS):
        each = np.log(table)[:, np.arange(LABELERS)[None, :], said].sum(axis=2)
        odds = np.log(share) + each[0] - np.log(1 - share) - each[1]
        real = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        weight = np.stack([real, 1 - real]) * counts
        table = np.stack(
            [
                [np.bincount(said[:, k], weights=w, minlength=3) + STRENGTH * EXPECTED[c] for k in range(LABELERS)]
                for c, w in enumerate(weight)
            ]
        )
        table /= table.sum(axis=2, keepdims=True)
        share = (weight[0].sum() + STRENGTH / 2) / (counts.sum() + STRENGTH)
    return real, table


def logistic(rows: list[list[int]], target: np.ndarray, ridge: float = 0.2) -> np.ndarray:
    """Weights of a logistic model of soft labels, by Newton steps."""
    x = np.zeros((len(rows), FEATURES))
    for k, row in enumerate(rows):
        x[k, row] = 1
    w = np.zeros(FEATURES)
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - target) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(FEATURES)
        w -= np.linalg.solve(curve, slope)
    return w


class Model(NamedTuple):
    #: One row of weights per kind.
    weights: np.ndarray
    #: [kind, real or not, labeler, yes/nothing/no]
    tables: np.ndarray


def observe(docs: DataFrame, text: str) -> DataFrame:
    """Counts of ballots (null key), and the sample of candidates, of every task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        # Largest key of each kind on top, so that smaller ones push it out.
        heaps: list[list[tuple[int, str, list[int]]]] = [[] for _ in KINDS]
        held: list[set[int]] = [set() for _ in KINDS]
        for batch in batches:
            for value in batch.column(0):
                content = value.as_py() or ""
                for start, kind, end, _ in candidates(content):
                    ballot, inputs = judged(content, start, kind, end)
                    counts[kind, ballot] += 1
                    around = content[max(0, start - NEAR) : end + NEAR].encode("utf-8", "surrogatepass")
                    key = int.from_bytes(hashlib.blake2b(around, digest_size=8).digest(), "little") >> 1
                    if key in held[kind] or (len(heaps[kind]) == SAMPLE and key >= -heaps[kind][0][0]):
                        continue
                    held[kind].add(key)
                    heapq.heappush(heaps[kind], (-key, ballot, inputs))
                    if len(heaps[kind]) > SAMPLE:
                        held[kind].discard(-heapq.heappop(heaps[kind])[0])
        rows = [(kind, ballot, n, None, None) for (kind, ballot), n in counts.items()]
        rows += [(kind, b, 1, -key, inputs) for kind, heap in enumerate(heaps) for key, b, inputs in heap]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["kind", "ballot", "n", "key", "inputs"]
        )

    return docs.select(F.col(text).alias("text")).mapInArrow(
        run, "kind int, ballot string, n bigint, key bigint, inputs array<int>"
    )


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Labelers weighed and the classifier trained on the candidates of ``docs``; no labels are used."""
    seen = freeze(observe(docs, text))
    counted = seen.where("key is null").groupBy("kind", "ballot").agg(F.sum("n").alias("n")).collect()
    distinct = seen.where("key is not null").dropDuplicates(["kind", "key"])
    weights, tables = np.zeros((len(KINDS), FEATURES)), np.repeat(EXPECTED[None, :, None, :], LABELERS, axis=2)
    tables = np.repeat(tables, len(KINDS), axis=0)
    for kind in range(len(KINDS)):
        mine = sorted((r["ballot"], r["n"]) for r in counted if r["kind"] == kind)
        if not mine:
            continue
        ballots = [b for b, _ in mine]
        real, tables[kind] = reliabilities(ballots, np.array([float(n) for _, n in mine]))
        likely = dict(zip(ballots, real, strict=True))
        sample = distinct.where(F.col("kind") == kind).orderBy("key").limit(SAMPLE).collect()
        weights[kind] = logistic([r["inputs"] for r in sample], np.array([likely[r["ballot"]] for r in sample]))
    return Model(weights, tables)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])


def spans_of(text: str, weights: np.ndarray) -> list[dict]:
    """All spans of a text: base ones, and candidates that the classifier believes, by start, then kind."""
    out, reach = [], 0
    for start, kind, end, base in candidates(text):
        if not base and start < reach:
            continue
        _, inputs = judged(text, start, kind, end)
        score = float(1 / (1 + np.exp(-np.clip(weights[kind, inputs].sum(), -30, 30))))
        if base or score >= LEAST:
            out.append({"kind": KINDS[kind], "start": start, "end": end, "base": base, "score": score})
            if not base:
                reach = end
    return out


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """(doc_id, spans) for each row of ``docs``, spans being (kind, start, end, base, score).

    ``start`` and ``end`` count code points from 0; the end is not included.  Without a
    ``model`` one is fitted on ``docs``.
    """
    model = model or fit(docs, text)
    known = docs.sparkSession.sparkContext.broadcast(model.weights)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans_of(v.as_py() or "", known.value) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(SPAN))], names=["doc_id", "spans"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>>"
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_ of each kind, base_sha256, spans): counts and hash of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[count_of(base, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
