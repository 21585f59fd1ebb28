"""License scan: ordered signature rules behind a keyword prefilter.

A rule's signature is tried only on texts that contain the rule's keyword, and the texts
that contain no keyword at all, nearly all, are read once and left.  All places of a
signature come from splitting the text at it.  Of two detections, the one whose interval
lies within the other's is dropped if its priority is not higher; of equal intervals the
rule that comes first stays.  One pass over a text's detections in order of their starts
settles this: the farthest end so far of each priority tells whether a detection is
contained, so the work does not grow with the square of the detections.

Besides, ``phrases`` are sought as words that stand consecutively whatever is between
them (``base``), with their word numbers.

All of it is DataFrame functions, in one pass over the texts; only ids, counts and
intervals are shuffled.  A null text is empty.  Repeated rows stay rows.  An empty table
gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paidmedia.llm.license_rules import Rule, rules

#: Phrase (words, lower case) to label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: ASCII letters and digits and all characters beyond ASCII.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]++"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def least(words: set[str]) -> list[str]:
    """The words that hold no other one: a text with any of ``words`` has one of them."""
    return sorted(w for w in words if not any(o != w and o in w for o in words))


def gate_words(signatures: list[Rule]) -> list[str]:
    """Words of which every text with a keyword has one: the longest of each keyword."""
    return least({max(k.split(), key=len) for r in signatures for k in r.keywords})


def any_of(text: Column, parts: list[str]) -> Column:
    hit = F.lit(False)
    for part in parts:
        hit = hit | F.contains(text, F.lit(part))
    return hit


def phrase_places(words: Column, n_words: Column, phrases: dict[str, str]) -> Column:
    """Array with one struct per phrase that occurs: label, places, first and last word."""
    line = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    found = []
    for phrase, label in phrases.items():
        parts = F.split(line, f"(?<= ){phrase}(?= )", -1)

        def words_in(part: Column) -> Column:
            return F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit(""))) - 1

        places = F.size(parts) - 1
        last = n_words - words_in(F.element_at(parts, -1)) - len(phrase.split())
        found.append(
            F.when(
                places > 0,
                F.struct(
                    F.lit(label).alias("label"),
                    places.cast("long").alias("places"),
                    words_in(F.element_at(parts, 1)).cast("long").alias("first"),
                    last.cast("long").alias("last"),
                ),
            )
        )
    return F.array_compact(F.array(*found))


def base_scan(docs: DataFrame, doc_id: str, text: str, phrases: dict[str, str]) -> DataFrame:
    """(row, doc_id, text, low, n_words, base) for each row, texts as they are."""
    content = F.coalesce(F.col(text), F.lit(""))
    seen = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        content.alias("text"),
        F.lower(content).alias("low"),
        F.regexp_count(content, F.lit(WORD)).cast("long").alias("n_words"),
    )
    # Every phrase has a word of three letters or more, or all its words are sought.
    gates = sorted({max(p.split(), key=len) for p in phrases})
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0))
    return seen.withColumn(
        "base",
        F.when(any_of(F.col("low"), gates), phrase_places(words, F.col("n_words"), phrases)),
    )


def detections(seen: DataFrame, signatures: list[Rule]) -> DataFrame:
    """Every place of every signature; rows without any keep one row with a null rule."""
    # One literal, whatever the number of rules.
    listed = F.from_json(
        F.lit(json.dumps([r._asdict() for r in signatures])),
        "array<struct<rule:int,label:string,priority:int,confidence:double,keywords:array<string>,signature:string>>",
    )
    # A phrase may be split by any white space, so keywords are sought in a text where it is one space.
    # The longest words of short forms stand inside many others, so few of the texts that
    # pass the first gate hold a whole keyword; only those are asked for each rule's.
    keywords = least({k for r in signatures for k in r.keywords})
    spaced = F.when(any_of(F.col("low"), gate_words(signatures)), F.regexp_replace("low", r"\s+", " "))
    tried = F.when(
        F.col("gated"),
        F.filter(listed, lambda r: F.exists(r["keywords"], lambda k: F.contains(F.col("spaced"), k))),
    )
    rows = (
        seen.withColumn("spaced", spaced)
        .withColumn("gated", F.col("spaced").isNotNull() & any_of(F.col("spaced"), keywords))
        .select("row", "doc_id", "n_words", "base", "text", F.explode_outer(tried).alias("r"))
    )
    # Parts between the places, each with the place that follows it.
    parts = F.transform(F.split("text", F.col("r.signature"), -1), lambda p: F.length(p))
    places = F.transform(
        F.regexp_extract_all("text", F.col("r.signature"), F.lit(0)), lambda p: F.length(p)
    )
    zipped = F.when(
        F.col("r").isNotNull() & (F.size(places) > 0),
        F.slice(F.arrays_zip(parts.alias("gap"), places.alias("chars")), F.lit(1), F.size(places)),
    )
    found = rows.select(
        "row",
        "doc_id",
        "n_words",
        "base",
        F.col("r.rule").alias("rule"),
        F.col("r.label").alias("label"),
        F.col("r.priority").alias("priority"),
        F.col("r.confidence").alias("confidence"),
        F.posexplode_outer(zipped).alias("at", "place"),
    ).repartition("row")
    upto = Window.partitionBy("row", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    size = F.col("place.chars")
    end = F.sum(F.col("place.gap") + size).over(upto)
    return found.select(
        "row",
        "doc_id",
        "n_words",
        "base",
        *[F.when(F.col("at").isNotNull(), F.col(c)).alias(c) for c in ("rule", "label", "priority", "confidence")],
        (end - size).alias("start"),
        end.alias("end"),
    )


def marked(found: DataFrame, signatures: list[Rule]) -> DataFrame:
    """Detections with ``kept``: false where one of equal or higher priority contains it."""
    order = Window.partitionBy("row").orderBy(
        F.col("start").asc_nulls_last(), F.col("end").desc(), "priority", "rule"
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    contained = F.lit(False)
    for p in sorted({r.priority for r in signatures}):
        farthest = F.max(F.when(F.col("priority") == p, F.col("end"))).over(before)
        contained = contained | ((F.col("priority") >= p) & F.coalesce(farthest >= F.col("end"), F.lit(False)))
    return found.withColumn("kept", F.col("rule").isNotNull() & ~contained)


def license_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", signatures: list[Rule] | None = None
) -> DataFrame:
    """(doc_id, rule, label, priority, confidence, start, end) of the detections that stay.

    ``start`` and ``end`` count characters from 0; the end is not included.
    """
    signatures = signatures or rules()
    found = marked(detections(base_scan(docs, doc_id, text, PHRASES), signatures), signatures)
    return found.where("kept").select("doc_id", "rule", "label", "priority", "confidence", "start", "end")


def license_labels(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    signatures: list[Rule] | None = None,
    phrases: dict[str, str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: word counts, base phrases, all labels and a score.

    ``score`` is the highest confidence of the detections that stay (a base phrase alone
    counts 0.5), 0 where there are none.
    """
    signatures, phrases = signatures or rules(), phrases or PHRASES
    found = marked(detections(base_scan(docs, doc_id, text, phrases), signatures), signatures)
    each = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.first("base").alias("base"),
        # At most one entry per label of the rules.
        F.collect_set(F.when(F.col("kept"), F.col("label"))).alias("own"),
        F.max(F.when(F.col("kept"), F.col("confidence"))).alias("confidence"),
    )
    base = F.coalesce("base", F.array().cast("array<struct<label:string,places:bigint,first:bigint,last:bigint>>"))
    each = each.withColumn("base", base)
    of = F.transform("base", lambda b: b["label"])
    zero = F.lit(0).cast("long")
    has_base = F.size("base") > 0
    return each.select(
        "doc_id",
        "n_words",
        F.aggregate("base", zero, lambda s, b: s + b["places"]).alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["last"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(of)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(of, F.col("own"))), ",").alias("labels"),
        F.greatest(
            F.coalesce("confidence", F.lit(0.0)), F.when(has_base, F.lit(0.5)).otherwise(F.lit(0.0))
        ).alias("score"),
    )
