from __future__ import annotations

import random
import re
import time

import pytest

from llm_helpers import documents, workers_find_the_package  # noqa: F401
from millrace.llm.licenses import BASE_PHRASES, Rule, license_scan, resolved, rules, scan

TEXTS = [None, "", "no words here", "Licensed under the Apache License, Version 2.0.", "CC BY cc-by cc by",
         "GNU General Public License v3 or later", "MIT License; the mit_license", "Apache\nLicense apache license license",
         "été apache license", "xapache license", "SPDX-License-Identifier: LGPL-2.1-only", "cc " * 50000 + "by"]


def plain_base(text: str | None) -> tuple:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    places = [(i, label) for phrase, label in BASE_PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return (len(words), len(at), min(at, default=None), max(at, default=None),
            ",".join(sorted({label for _, label in places})))


def test_base_places_like_a_plain_version(documents):
    found = license_scan(documents(list(enumerate(TEXTS)))).collect()
    for row in found:
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == \
            plain_base(TEXTS[row["doc_id"]])
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


@pytest.mark.parametrize("text,labels", [
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
    ("Creative Commons Attribution-ShareAlike 4.0", "cc-by-sa-4.0"),
    ("SPDX-License-Identifier: LGPL-2.1-only", "lgpl-2.1"),
    ("GNU Lesser General Public License", "lgpl"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
    ("a 3-clause BSD license", "bsd-3-clause"),
    ("the mit of the world", ""),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("SPDX-License-Identifier: Apache-2.0 OR MIT", "apache-2.0,mit"),
    ("// SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0 OR BSD-3-Clause) AND ISC", "bsd-3-clause,gpl-2,isc"),
    ("Apache-2.0 OR MIT", "apache-2.0,mit"),
    ("BSD-3-Clause", "bsd-3-clause"),
    ("mpl-2.0", "mpl-2.0"),
    ("License: BSD", "bsd"),
    ("Er kam mit or and isc zlib", ""),
    ("release 2 0 of apache and 3 clause", ""),
])
def test_labels(text, labels):
    assert scan(text).labels == labels


def test_contained_spans_go():
    low, high = Rule("low", "", "", 1, 0.5), Rule("high", "", "", 5, 0.5)
    spans = [(0, 10, low), (2, 5, high), (2, 4, low), (4, 8, low), (20, 30, low), (20, 30, low)]
    assert [(s, e) for s, e, _ in resolved(spans)] == [(0, 10), (2, 5), (20, 30)]


def test_keywords_are_in_every_match():
    assert len(rules()) > 300
    for rule in rules():
        plain = re.sub(r"\[cs\]", "c", re.sub(r"\?:|\\S\+ |\{1,12\}", "", rule.pattern))
        assert rule.keyword and rule.keyword in plain


def test_an_empty_table(documents):
    assert license_scan(documents([])).count() == 0


def plain_resolved(spans: list) -> list:
    best = sorted(range(len(spans)), key=lambda i: (-spans[i][2].priority, spans[i][0] - spans[i][1], i))
    kept: list = []
    for i in best:
        if not any(s <= spans[i][0] and spans[i][1] <= e for s, e, _ in kept):
            kept.append(spans[i])
    return sorted(kept, key=lambda span: span[:2])


def test_overlaps_like_a_plain_version():
    chance = random.Random(3)
    for _ in range(200):
        spans = [(start, start + chance.randint(1, 12), Rule(str(i), "", "", chance.randint(1, 4), 0.5))
                 for i, start in enumerate(chance.choices(range(30), k=chance.randint(0, 25)))]
        assert resolved(spans) == plain_resolved(spans)


def test_time_grows_with_the_text():
    text = "Licensed under the Apache License, Version 2.0. MIT License. SPDX-License-Identifier: ISC\n" * 110_000
    start = time.perf_counter()
    found = scan(text)
    assert len(text) > 9_000_000 and time.perf_counter() - start < 60
    assert len(found.base) == 220_000 and found.labels == "apache,apache-2.0,isc,mit"
