"""License scan: ordered signature rules behind a keyword gate, overlaps resolved by priority."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases whose every place counts, with their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Words in lower case, separators dropped, as the scan sees them. A name is a regular expression over such words.
# (label, names, versions)
FAMILIES = (
    ("gpl", ("gnu general public licen[cs]e", "gnu gpl", "gplv?"), ("1", "2", "3")),
    ("lgpl", ("gnu lesser general public licen[cs]e", "gnu library general public licen[cs]e", "gnu lgpl", "lgplv?"),
     ("2", "2 1", "3")),
    ("agpl", ("gnu affero general public licen[cs]e", "gnu agpl", "agplv?"), ("1", "3")),
    ("gfdl", ("gnu free documentation licen[cs]e", "gnu fdl", "gfdl"), ("1 1", "1 2", "1 3")),
    ("apache", ("apache software licen[cs]e", "apache licen[cs]e", "asl"), ("1 0", "1 1", "2 0")),
    ("mpl", ("mozilla public licen[cs]e", "mpl"), ("1 0", "1 1", "2 0")),
    ("epl", ("eclipse public licen[cs]e", "epl"), ("1 0", "2 0")),
    ("cddl", ("common development and distribution licen[cs]e", "cddl"), ("1 0", "1 1")),
    ("eupl", ("european union public licen[cs]e", "eupl"), ("1 0", "1 1", "1 2")),
    ("artistic", ("artistic licen[cs]e", "perl artistic licen[cs]e"), ("1 0", "2 0")),
    ("bsl", ("boost software licen[cs]e", "bsl"), ("1 0",)),
    ("afl", ("academic free licen[cs]e", "afl"), ("2 1", "3 0")),
    ("osl", ("open software licen[cs]e",), ("2 1", "3 0")),
    ("cpl", ("common public licen[cs]e",), ("1 0",)),
    ("ofl", ("sil open font licen[cs]e", "open font licen[cs]e"), ("1 0", "1 1")),
    ("zpl", ("zope public licen[cs]e", "zpl"), ("2 0", "2 1")),
    ("odbl", ("open database licen[cs]e", "odbl"), ("1 0",)),
    ("mit", ("mit licen[cs]e", "mit x11 licen[cs]e", "expat licen[cs]e"), ()),
    ("isc", ("isc licen[cs]e",), ()),
    ("zlib", ("zlib licen[cs]e", "zlib libpng licen[cs]e"), ()),
    ("unlicense", ("the unlicense",), ()),
    ("wtfpl", ("do what the fuck you want to public licen[cs]e", "wtfpl"), ("2",)),
    ("python", ("python software foundation licen[cs]e", "psf licen[cs]e"), ("2",)),
    ("postgresql", ("postgresql licen[cs]e",), ()),
    ("bsd-2-clause", ("(?:2|two) clause bsd licen[cs]e", "simplified bsd licen[cs]e", "freebsd licen[cs]e"), ()),
    ("bsd-3-clause", ("(?:3|three) clause bsd licen[cs]e", "new bsd licen[cs]e", "revised bsd licen[cs]e"), ()),
    ("bsd", ("bsd licen[cs]e", "bsd style licen[cs]e"), ()),
    ("cc0", ("cc0", "creative commons zero", "creative commons cc0"), ("1 0",)),
    ("public-domain", ("public domain dedication", "dedicated to the public domain"), ()),
    ("all-rights-reserved", ("all rights reserved", "tous droits réservés", "alle rechte vorbehalten",
                             "todos los derechos reservados"), ()),
)

# Parts of Creative Commons licences: (label, short form, long form).
COMMONS = (
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative)?s"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
)
COMMONS_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Passages of licence texts: (label, signature).
SIGNATURES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "neither the name of (?:\\S+ ){1,12}may be used to endorse or promote products"),
    ("gpl", "either version [123] of the licen[cs]e or (?:at your option )?any later version"),
    ("gpl", "you should have received a copy of the gnu (?:\\S+ )?general public licen[cs]e"),
    ("apache", "you may not use this file except in compliance with the licen[cs]e"),
    ("mpl", "subject to the terms of the mozilla public licen[cs]e"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "you just do what the fuck you want to"),
    ("zlib", "altered source versions must be plainly marked as such"),
    ("ofl", "reserved font name"),
)

# How a licence is declared: (words before its name, certainty).
DECLARED = ((r"licen[cs]ed under (?:the )?(?:terms of )?(?:the )?", 0.95),
            (r"(?:released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?", 0.9),
            (r"spdx licen[cs]e identifier ", 0.99),
            (r"licen[cs]e ", 0.8),
            (r"", 0.7))

# SPDX identifiers, in words: (label, identifier).
IDENTIFIERS = (
    ("mit", "mit"), ("isc", "isc"), ("zlib", "zlib"), ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("bsd", "0bsd"),
    ("apache-2.0", "apache 2 0"), ("apache-1.1", "apache 1 1"), ("bsd-2-clause", "bsd 2 clause"),
    ("bsd-3-clause", "bsd 3 clause"), ("gpl-1", "gpl 1 0"), ("gpl-2", "gpl 2 0"), ("gpl-3", "gpl 3 0"),
    ("lgpl-2", "lgpl 2 0"), ("lgpl-2.1", "lgpl 2 1"), ("lgpl-3", "lgpl 3 0"), ("agpl-3", "agpl 3 0"),
    ("mpl-1.1", "mpl 1 1"), ("mpl-2.0", "mpl 2 0"), ("epl-1.0", "epl 1 0"), ("epl-2.0", "epl 2 0"),
    ("cc0-1.0", "cc0 1 0"), ("cc-by-3.0", "cc by 3 0"), ("cc-by-4.0", "cc by 4 0"), ("cc-by-sa-3.0", "cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0"), ("artistic-2.0", "artistic 2 0"), ("bsl-1.0", "bsl 1 0"), ("ofl-1.1", "ofl 1 1"))
# What may follow an identifier in an expression.
TAIL = r"(?: only| or later)?(?: with (?:\S+ ){1,4}exception(?: \d+){0,2})?"
ANY_IDENTIFIER = "(?:" + "|".join(name for _, name in IDENTIFIERS) + ")" + TAIL
EXPRESSION = re.compile(rf"(?<= )(spdx licen[cs]e identifier )?{ANY_IDENTIFIER}(?: (?:or|and) {ANY_IDENTIFIER})*(?= )")
IDENTIFIER = re.compile(rf"(?<= )(?:{'|'.join(f'({name})' for _, name in IDENTIFIERS)}){TAIL}(?= )")
# Words without which no text holds an expression that counts.
EXPRESSION_GATE = tuple({f" {name.split()[0]} " for _, name in IDENTIFIERS if " " in name} | {" identifier "})

ASCII_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                   for b in range(256))


@dataclass(frozen=True)
class Rule:
    """A signature with its label; a larger priority wins, then the earlier rule."""

    label: str
    pattern: str
    keyword: str
    priority: int
    certainty: float


@dataclass
class Scan:
    """What a text holds; spans are (first word, word behind the last, label, certainty)."""

    n_words: int = 0
    base: list[tuple[int, str]] = field(default_factory=list)
    spans: list[tuple[int, int, str, float]] = field(default_factory=list)

    @property
    def base_labels(self) -> str:
        return ",".join(sorted({label for _, label in self.base}))

    @property
    def labels(self) -> str:
        return ",".join(sorted({label for _, label in self.base} | {span[2] for span in self.spans}))

    @property
    def score(self) -> float:
        """Certainty that some licence is declared: the strongest detection's."""
        return max([span[3] for span in self.spans] + [0.7] * bool(self.base), default=0.0)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased ASCII words and words of other characters."""
    return (text or "").encode().translate(ASCII_FOLD).split()


# Words too common to open the gate on their own.
COMMON = {"licen", "version", "public", "general", "software", "free", "open", "common", "rights", "style", "the"}


def _keyword(pattern: str) -> str:
    """The longest letters or digits that every match of the pattern holds, common words only if there are no others."""
    certain = re.sub(r"\([^)]*\)[^ ]*", " ", pattern)
    plain = [re.match(r"\w*", re.sub(r"\w\?.*", "", word))[0] for word in certain.split()]
    return max(plain, key=lambda word: (word not in COMMON, len(word)))


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in order: licence passages, then declared names with and without a version."""
    found = [Rule(label, pattern, _keyword(pattern), 100, 0.97) for label, pattern in SIGNATURES]
    named = [(label, name, version) for label, names, versions in FAMILIES for name in names
             for version in (*versions, None)]
    for label, short, long in COMMONS:
        for name in (f"cc {short}", f"creative commons {short}", f"creative commons {long}"):
            named += [(label, name, version) for version in (*COMMONS_VERSIONS, None)]
    for rank, (before, certainty) in enumerate(DECLARED):
        for label, name, version in named:
            behind = f"(?: or later)? ?(?:licen[cs]e )?(?:version |v)?{version}(?: only| or later)?" if version else ""
            full = f"{label}-{version.replace(' ', '.')}" if version else label
            found.append(Rule(full, before + name + behind, _keyword(name), 2 * (len(DECLARED) - rank) + bool(version),
                              certainty))
    for label in ("bsd", "mit", "isc", "apache", "gpl", "lgpl", "mpl"):
        found.append(Rule(label, f"licen[cs]e {label}", label, 1, 0.6))
    return tuple(found)


@cache
def compiled() -> dict[str, tuple[tuple[Rule, re.Pattern], ...]]:
    """The rules by keyword, as expressions over space-joined words."""
    by_keyword: dict[str, list] = {}
    for rule in rules():
        by_keyword.setdefault(rule.keyword, []).append((rule, re.compile(rf"(?<= )(?:{rule.pattern})(?= )")))
    return {keyword: tuple(group) for keyword, group in by_keyword.items()}


def identifiers(joined: str) -> Iterator[tuple[int, int, Rule]]:
    """The identifiers of SPDX expressions, each on its own.

    Outside of a tag an expression counts only with an identifier that cannot be a word of a sentence,
    as ``mit`` can.
    """
    if not any(word in joined for word in EXPRESSION_GATE):
        return
    for match in EXPRESSION.finditer(joined):
        names = list(IDENTIFIER.finditer(joined, match.end(1) if match[1] else match.start(), match.end() + 1))
        if match[1] or any(" " in IDENTIFIERS[name.lastindex - 1][1] for name in names):
            priority, certainty = (50, 0.99) if match[1] else (1, 0.7)
            for name in names:
                label, pattern = IDENTIFIERS[name.lastindex - 1]
                yield name.start(), name.end(), Rule(label, pattern, pattern, priority, certainty)


def resolved(spans: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Without the spans that lie within one of a larger priority, or within a longer or earlier one of the same.

    Spans come in that order, and each asks for the farthest end of those before it that start no later:
    maxima over beginnings of the sorted starts, kept in a tree of prefix maxima.
    """
    starts = {start: rank for rank, start in enumerate(sorted({span[0] for span in spans}), 1)}
    farthest = [0] * (len(starts) + 1)
    kept: list[tuple[int, int, Rule]] = []
    best = sorted(range(len(spans)), key=lambda i: (-spans[i][2].priority, spans[i][0] - spans[i][1], i))
    for start, end, rule in (spans[i] for i in best):
        at, held = starts[start], 0
        while at:
            held = max(held, farthest[at])
            at &= at - 1
        if held >= end:
            continue
        kept.append((start, end, rule))
        at = starts[start]
        while at < len(farthest):
            farthest[at] = max(farthest[at], end)
            at += at & -at
    return sorted(kept, key=lambda span: span[:2])


def scan(text: str | None) -> Scan:
    """The base phrases' places and the resolved detections of a whole text."""
    words = words_of(text)
    joined = (b" " + b" ".join(words) + b" ").decode()
    found = Scan(len(words))
    phrases = []
    for phrase, label in BASE_PHRASES.items():
        at = joined.find(f" {phrase} ")
        while at >= 0:
            phrases.append((at, label))
            at = joined.find(f" {phrase} ", at + 1)
    spans = resolved([*identifiers(joined), *(
        (match.start(), match.end(), rule) for keyword, group in compiled().items() if f" {keyword}" in joined
        for rule, pattern in group for match in pattern.finditer(joined))])
    if phrases or spans:
        spaces = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4") == 0x20)

        def spaces_before(places: list[int]) -> list[int]:
            return np.searchsorted(spaces, places).tolist()

        found.base = list(zip(spaces_before([at for at, _ in phrases]), [label for _, label in phrases]))
        found.spans = [(first - 1, behind, rule.label, rule.certainty) for (_, _, rule), first, behind in
                       zip(spans, spaces_before([s[0] for s in spans]), spaces_before([s[1] for s in spans]))]
    return found


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, n_base, first_word, last_word, base_labels,
    labels, score, and spans (first_word, end_word, label, certainty) of the resolved detections.

    Null and empty texts have no words, empty labels, null places and score 0. Rows repeated
    under one id keep a row each; other columns are not read.
    """
    span = pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()),
                      ("certainty", pa.float64())])
    types = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
             "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(span)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                found = scan(text.as_py())
                places = [place for place, _ in found.base]
                rows.append((found.n_words, len(places), min(places, default=None), max(places, default=None),
                             found.base_labels, found.labels, found.score,
                             [dict(zip(("first_word", "end_word", "label", "certainty"), s)) for s in found.spans]))
            columns = list(zip(*rows)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, t) for c, t in zip(columns, types.values()))], [id_col, *types])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        work, f"`{id_col}` long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, "
        "spans array<struct<first_word: long, end_word: long, label: string, certainty: double>>")
