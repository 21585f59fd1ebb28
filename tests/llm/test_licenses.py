"""Signatures, suppression and base phrases against plain Python."""

import re

import pytest
from conftest import DATA, plan_of

from paidmedia.llm import licenses, queries
from paidmedia.llm.license_rules import Rule, rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_base(text):
    words = WORD.findall(lower(text or ""))
    places = [
        (k, label)
        for phrase, label in licenses.PHRASES.items()
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]
    starts = [k for k, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def brute_spans(text, signatures):
    """All matches, then every pair is compared."""
    found = []
    spaced = re.sub(r"[ \t\n\x0b\x0c\r]+", " ", (text or "").lower())
    for r in signatures:
        if any(k in spaced for k in r.keywords):
            found += [(m.start(), m.end(), r) for m in re.finditer(r.signature, text or "", re.ASCII)]
    out = []
    for s, e, r in found:
        inside = any(
            s2 <= s and e <= e2 and r2.priority <= r.priority and ((s2, e2) != (s, e) or (r2.priority, r2.rule) < (r.priority, r.rule))
            for s2, e2, r2 in found
        )
        if not inside:
            out.append((r.rule, s, e))
    return sorted(out)


TEXTS = [
    "Licensed under the Apache License, Version 2.0. See http://www.apache.org/licenses/LICENSE-2.0",
    "SPDX-License-Identifier: GPL-3.0-or-later\nGNU General Public License version 3, GNU  General\tPublic License",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0. cc-by cc by CC_BY ccby cc  by.",
    "Released under the MIT License. All rights reserved. mit license mit license MIT LICENSE",
    "Permission is hereby granted, free of charge, to any person obtaining a copy. Copyright (c) 2020 X",
    "The K license, the Apaché License and the apache\nlicense; été MIT License",
    "Mozilla Public License 2.0 and Eclipse Public License 2.0, Boost Software License 1.0, ISC License",
    "no mention at all", "", None, "mit", "license", "mit license", "word " * 3000 + "mit license " * 400,
]


def test_there_are_hundreds_of_rules_and_all_compile():
    found = rules()
    assert len(found) >= 250
    assert [r.rule for r in found] == list(range(len(found)))
    assert [r.priority for r in found] == sorted(r.priority for r in found)
    for r in found:
        assert re.compile(r.signature) and all(k == k.lower() for k in r.keywords)


def test_a_name_is_found_by_its_own_rules():
    names = ["Apache License 2.0", "Mozilla Public License 1.1", "GNU Lesser General Public License v2.1", "zlib License"]
    for name in names:
        assert any(re.fullmatch(r.signature, name) for r in rules() if any(k in name.lower() for k in r.keywords)), name


FORMS = {
    "Distributed under the BSD 3-Clause License.": "bsd-3-clause",
    "Available under the two-clause BSD terms; BSD 2 Clause": "bsd-2-clause",
    "This project is licensed under Apache 2.0.": "apache-2.0",
    "Apache-2.0 License": "apache-2.0",
    "Licensed under GPLv3": "gpl-3.0",
    "GPL-2.0": "gpl-2.0",
    "License: GPL, version 2 or later": "gpl-2.0",
    "the GPL": "gpl-family",
    "under LGPLv2.1+": "lgpl-2.1",
    "AGPL-3.0-or-later applies": "agpl-3.0",
    "This Source Code is under the MPL 2.0": "mpl-2.0",
    "Dual licensed: EPL-2.0": "epl-2.0",
    "an MIT-licensed library": "mit",
    "# SPDX-License-Identifier: MIT OR Apache-2.0": "apache-2.0,mit",
    "// SPDX-License-Identifier: (MIT OR Apache-2.0)": "apache-2.0,mit",
    "SPDX-License-Identifier: (MIT AND BSD-3-Clause) OR GPL-2.0-only WITH Classpath-exception-2.0 OR ISC":
        "bsd-3-clause,gpl-2.0,isc,mit",
    "SPDX-License-Identifier: GPL-2.0+ OR LicenseRef-Own OR Zlib.": "gpl-2.0,zlib",
    "an example of a reply 2 simple: Apache 2.0.64 and Apache 2.4 servers, XML OR JSON": "",
}


def test_short_forms_and_expressions(spark):
    frame = spark.createDataFrame(list(enumerate(FORMS)), "doc_id long, text string")
    spans, labels = {}, {}
    for r in licenses.license_spans(frame).collect():
        spans.setdefault(r["doc_id"], []).append((r["rule"], r["start"], r["end"]))
        labels.setdefault(r["doc_id"], set()).add(r["label"])
    for i, (text, want) in enumerate(FORMS.items()):
        assert ",".join(sorted(labels.get(i, set()))) == want, text
        assert sorted(spans.get(i, [])) == brute_spans(text, rules()), text


def test_every_short_form_is_found_in_all_its_spellings():
    from paidmedia.llm.license_rules import SHORT_FORMS

    for spdx, keywords, _ in SHORT_FORMS:
        if "v" not in keywords or spdx.lower().split("-")[0] in ("mit", "ms"):
            continue
        name, version = keywords.split("|")[0][:-1], spdx.split("-")[-1]
        tail = " license" if name == "apache" else ""
        for between in ("", " ", "-", " v", "-v", "v", ", version ", " version ", ", v. "):
            text = f"{name}{between}{version}{tail}"
            assert any(
                r.label == spdx.lower() and re.fullmatch(r.signature, text) and any(k in text for k in r.keywords)
                for r in rules()
            ), text


LONG_HOLDER = "Neither the name of the " + "Very Long Foundation of Many Words " * 4 + "may be used to endorse or promote products"
GAPS = [
    ("bsd-3-clause", "Neither the name of Foo, Inc. nor the names of its\n contributors may be used to endorse or promote products"),
    ("bsd-3-clause", "Neither the name of the J. Doe Co. Ltd. Group nor that of example.org\nmay be used to endorse or promote products"),
    ("bsd-3-clause", LONG_HOLDER),
    ("proprietary", "Unauthorized copying is prohibited"),
    ("proprietary", "Unauthorised copying of this file, via\nany medium, is strictly prohibited"),
    ("unlicense", "the Unlicence"),
]


def test_gaps_reach_to_the_end_of_the_sentence(spark):
    other = "Neither the name of it is known. The MIT License is. It may be used to endorse or promote products"
    texts = [t for _, t in GAPS] + [other, "neither the name of " + "a.b " * 50_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in licenses.license_spans(frame).collect():
        got.setdefault(r["doc_id"], []).append((r["rule"], r["label"], r["start"], r["end"]))
    for i, (label, text) in enumerate(GAPS):
        assert label in {r[1] for r in got.get(i, [])}, text
        assert sorted((r, s, e) for r, _, s, e in got[i]) == brute_spans(text, rules())
    assert {r[1] for r in got[len(GAPS)]} == {"mit"} and len(GAPS) + 1 not in got


def test_every_spelling_passes_its_prefilter():
    for text in ["unauthorised copying is prohibited", "unauthorized copying is prohibited", "the unlicence", "the unlicense"]:
        hit = [r for r in rules() if re.fullmatch(r.signature, text)]
        assert hit and all(any(k in text for k in r.keywords) for r in hit), text


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, labels string").repartition(3)


def test_spans_against_pairwise_comparison(docs):
    got = {}
    for r in licenses.license_spans(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["rule"], r["start"], r["end"]))
    for i, t in enumerate(TEXTS):
        if t is None or len(t) < 5000:
            assert sorted(got.get(i, [])) == brute_spans(t, rules()), t


def test_suppression(spark):
    own = [
        Rule(0, "high", 0, 1.0, ("b",), "(?i)b c"),
        Rule(1, "wide", 1, 0.9, ("a",), "(?i)a b c d"),
        Rule(2, "same", 1, 0.8, ("a",), "(?i)a b c d"),
        Rule(3, "low", 2, 0.7, ("c",), "(?i)c d"),
    ]
    frame = spark.createDataFrame([(1, "x a b c d y"), (2, "c d a b")], "doc_id long, text string")
    got = {(r["doc_id"], r["label"]) for r in licenses.license_spans(frame, signatures=own).collect()}
    # A higher priority stays within a wider span; lower and equal ones go.
    assert got == {(1, "high"), (1, "wide"), (2, "low")}


def test_labels_against_plain_python(docs):
    got = {r["doc_id"]: r for r in licenses.license_labels(docs).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(t), t
        labels = set(filter(None, r["labels"].split(",")))
        assert set(filter(None, r["base_labels"].split(","))) <= labels
        assert r["labels"] == ",".join(sorted(labels))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)
    assert "apache-2.0" in got[0]["labels"] and "gpl-3.0" in got[1]["labels"] and "cc-by-nc-4.0" in got[3]["labels"]


def test_repeats_and_empty(spark):
    frame = spark.createDataFrame([(1, "MIT License")] * 3 + [(None, None)], "doc_id long, text string")
    got = licenses.license_labels(frame).collect()
    assert sorted((str(r["doc_id"]), r["labels"]) for r in got) == [("1", "mit")] * 3 + [("None", "")]
    assert licenses.license_labels(frame.limit(0)).count() == 0


def test_query_on_whole_table(spark):
    folder = f"{DATA}/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    df = queries.op10_licenses(spark, folder)
    plan = plan_of(df)
    assert "Python" not in plan and "Arrow" not in plan
    got = df.collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(texts[r["doc_id"]])


def test_the_word_class_is_the_contract_s():
    """The positive class takes the same code points as the one the contract states."""
    ours = re.compile(licenses.WORD.replace(r"\x{80}-\x{10FFFF}", "\x80-\U0010ffff"))
    points = [*range(0x300), 0x2028, 0xD7FF, 0xE000, 0xFFFD, 0x10000, 0x10FFFF]
    assert [bool(ours.fullmatch(chr(p))) for p in points] == [bool(WORD.fullmatch(lower(chr(p)))) for p in points]


def test_word_count_over_odd_characters(spark):
    texts = ["a\x7fb \x80\x81", "é-ü 日本 x \U0001f600", "", "0/9:@AZ[`az{", "x" * 200_000 + " y"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_words"] for r in licenses.license_labels(rows).collect()}
    assert got == {i: len(WORD.findall(lower(t))) for i, t in enumerate(texts)}
