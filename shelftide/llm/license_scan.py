"""License statements by ordered signature rules over normalised words.

A text is lower-cased (A-Z) and cut into words (runs of letters, digits and characters above ASCII);
rules are regular expressions over those words joined by single blanks, so punctuation, line breaks
and case never matter to them. Every rule has

* a level: tags of file headers first, then texts of licenses, addresses, notices, references, names and
  last the plain base phrases; within a level the order in ``RULES`` decides;
* keywords that each of its matches holds. One Aho-Corasick pass over the text finds which keywords
  it has; a rule is run only where all of its keywords are there;
* a label and a confidence.

Matches become intervals of words. A match inside the interval of a match of a better level is
suppressed, and so is one inside a longer one (or an equal one of an earlier rule) of its own level;
matches that overlap in part both stay. Base phrases are counted before suppression, and their
labels always stay.

The score is 1 - prod(1 - c) over the labels of a document, c being the best confidence among a label's
remaining matches (``BASE`` for one that stands only by a base phrase).

Defined results: a null or empty text has no words, no places, empty labels and score 0; a text of any
length is scanned whole, in memory in proportion to that one text; repeated rows are scanned row by row;
equal intervals of one level go to the earlier rule; an empty table gives no rows; columns of the input
other than the text and those carried are not looked at, and an added column replaces a carried one
of its name.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import utf8, with_columns
from shelftide.llm.decontaminate import words_of

#: Phrases whose places are counted, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Confidence of a label that only a base phrase supports.
BASE = 0.4

TAG, BODY, ADDRESS, NOTICE, REFERENCE, NAME, PLAIN = range(7)


@dataclass(frozen=True)
class Rule:
    level: int
    label: str
    pattern: str
    keywords: tuple[str, ...]
    confidence: float


#: label: (words that a mention must hold, the license's identifier in tags, its name in prose).
FAMILIES = {
    "cc-by-nc-nd": ("by nc nd", r"cc by nc nd(?: \d)?(?: \d)?", r"(?:a )?cc by nc nd(?: license)?(?: \d \d)?"),
    "cc-by-nc-sa": ("by nc sa", r"cc by nc sa(?: \d)?(?: \d)?", r"(?:a )?cc by nc sa(?: license)?(?: \d \d)?"),
    "cc-by-nc": ("by nc", r"cc by nc(?: \d)?(?: \d)?", r"(?:a )?cc by nc(?: license)?(?: \d \d)?"),
    "cc-by-nd": ("by nd", r"cc by nd(?: \d)?(?: \d)?", r"(?:a )?cc by nd(?: license)?(?: \d \d)?"),
    "cc-by-sa": ("by sa", r"cc by sa(?: \d)?(?: \d)?", r"(?:a )?cc by sa(?: license)?(?: \d \d)?"),
    "cc-by-4.0": ("cc by 4", r"cc by 4 0", r"cc by 4 0(?: international)?"),
    "cc-by-3.0": ("cc by 3", r"cc by 3 0", r"cc by 3 0(?: unported)?"),
    "cc0": ("cc0", r"cc0(?: 1 0)?", r"cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?"),
    "creative-commons": ("creative commons", r"cc pddc",
                         r"creative commons(?: attribution)?(?: license| licence| public license)?"),
    "agpl-3.0": ("agpl", r"agpl 3 0(?: only| or later)?", r"(?:gnu )?agpl ?v?(?: ?3(?: 0)?)?"),
    "affero-gpl": ("affero", r"agpl 1 0(?: only| or later)?",
                   r"(?:gnu )?affero general public licen[cs]e(?: v(?:ersion )?\d)?"),
    "lgpl-2.1": ("lgpl 2", r"lgpl 2 1(?: only| or later)?", r"(?:gnu )?lgpl 2 1"),
    "lgpl-3.0": ("lgpl 3", r"lgpl 3 0(?: only| or later)?", r"(?:gnu )?lgpl 3(?: 0)?"),
    "lgpl": ("general public licen", r"lgpl 2 0(?: only| or later)?",
             r"(?:gnu )?(?:lesser|library) general public licen[cs]e(?: v(?:ersion )?\d(?: \d)?)?"),
    "gpl-2.0": ("gpl", r"gpl 2 0(?: only| or later)?", r"(?:gnu )?gpl ?v?(?:ersion )?2(?: 0)?"),
    "gpl-3.0": ("gpl", r"gpl 3 0(?: only| or later)?", r"(?:gnu )?gpl ?v?(?:ersion )?3(?: 0)?"),
    "gnu-gpl-2": ("general public", r"gpl 2",
                  r"(?:gnu )?general public licen[cs]e v(?:ersion )?2(?: 0)?"),
    "gnu-gpl-3": ("general public", r"gpl 3",
                  r"(?:gnu )?general public licen[cs]e v(?:ersion )?3(?: 0)?"),
    "gnu-gpl": ("gnu general public", r"gpl 1 0(?: only| or later)?", r"gnu general public licen[cs]e"),
    "gfdl": ("free documentation", r"gfdl 1 \d(?: only| or later)?",
             r"(?:gnu )?free documentation licen[cs]e(?: version 1 \d)?"),
    "apache-2.0": ("apache", r"apache 2 0",
                   r"apache (?:software )?(?:licen[cs]e )?(?:version |v)?2(?: 0)?(?: licen[cs]e)?"),
    "apache-1.1": ("apache", r"apache 1 1", r"apache (?:software )?licen[cs]e (?:version )?1 1"),
    "apache": ("apache licen", r"apache 1 0", r"apache licen[cs]e"),
    "mit": ("mit licen", r"mit", r"(?:expat )?mit licen[cs]e"),
    "mit-0": ("mit no attribution", r"mit 0", r"mit no attribution(?: licen[cs]e)?"),
    "bsd-2-clause": ("bsd", r"bsd 2 clause", r"(?:simplified bsd|freebsd|2 clause bsd|bsd 2 clause)(?: licen[cs]e)?"),
    "bsd-3-clause": ("bsd", r"bsd 3 clause",
                     r"(?:new bsd|modified bsd|revised bsd|3 clause bsd|bsd 3 clause)(?: licen[cs]e)?"),
    "bsd-4-clause": ("bsd", r"bsd 4 clause", r"(?:original bsd|4 clause bsd|bsd 4 clause)(?: licen[cs]e)?"),
    "0bsd": ("bsd", r"0bsd", r"(?:zero clause bsd|0 clause bsd|0bsd)(?: licen[cs]e)?"),
    "bsd": ("bsd", r"bsd", r"bsd(?: style)? licen[cs]e"),
    "isc": ("isc licen", r"isc", r"isc licen[cs]e"),
    "mpl-2.0": ("mpl", r"mpl 2 0(?: no copyleft exception)?", r"mpl ?v?2(?: 0)?"),
    "mpl-1.1": ("mpl", r"mpl 1 1", r"mpl 1 1"),
    "mozilla-public": ("mozilla public", r"mpl 1 0",
                       r"mozilla public licen[cs]e(?: v(?:ersion )?\d(?: \d)?)?"),
    "epl-2.0": ("eclipse public", r"epl 2 0", r"eclipse public licen[cs]e v?(?:ersion )?2(?: 0)?"),
    "epl": ("eclipse public", r"epl 1 0", r"eclipse public licen[cs]e"),
    "cddl": ("common development and distribution", r"cddl 1 [01]",
             r"common development and distribution licen[cs]e"),
    "cpl": ("common public licen", r"cpl 1 0", r"common public licen[cs]e"),
    "eupl": ("european union public", r"eupl 1 [012]", r"european union public licen[cs]e"),
    "osl": ("open software licen", r"osl 3 0", r"open software licen[cs]e"),
    "afl": ("academic free", r"afl 3 0", r"academic free licen[cs]e"),
    "artistic": ("artistic licen", r"artistic [12] 0", r"artistic licen[cs]e(?: [12] 0)?"),
    "bsl-1.0": ("boost software", r"bsl 1 0", r"boost software licen[cs]e"),
    "busl": ("business source", r"busl 1 1", r"business source licen[cs]e(?: 1 1)?"),
    "sspl": ("server side public", r"sspl 1 0", r"server side public licen[cs]e"),
    "elastic": ("elastic licen", r"elastic 2 0", r"elastic licen[cs]e(?: 2 0)?"),
    "unlicense": ("unlicense", r"unlicense", r"unlicense"),
    "wtfpl": ("wtfpl", r"wtfpl", r"wtfpl"),
    "zlib": ("zlib", r"zlib", r"zlib(?: libpng)? licen[cs]e"),
    "openssl": ("openssl licen", r"openssl", r"openssl licen[cs]e"),
    "php": ("php licen", r"php 3 01?", r"php licen[cs]e"),
    "python": ("python software foundation", r"psf 2 0|python 2 0", r"python software foundation licen[cs]e"),
    "postgresql": ("postgresql licen", r"postgresql", r"postgresql licen[cs]e"),
    "ruby": ("ruby licen", r"ruby", r"ruby licen[cs]e"),
    "perl": ("same terms as perl", r"artistic 1 0 perl", r"same terms as perl(?: itself)?"),
    "w3c": ("w3c", r"w3c", r"w3c software(?: notice and)? licen[cs]e"),
    "ofl-1.1": ("open font licen", r"ofl 1 [01]", r"(?:sil )?open font licen[cs]e(?: (?:version )?1 1)?"),
    "odbl": ("database licen", r"odbl 1 0", r"open (?:data commons open )?database licen[cs]e"),
    "odc-by": ("open data commons", r"odc by 1 0", r"open data commons attribution licen[cs]e"),
    "pddl": ("public domain dedication", r"pddl 1 0", r"public domain dedication(?: and licen[cs]e)?"),
    "ogl": ("open government licen", r"ogl uk [123] 0", r"open government licen[cs]e(?: v?[123] 0)?"),
    "etalab": ("licence ouverte", r"etalab 2 0", r"licence ouverte(?: open licence)?"),
    "cecill": ("cecill", r"cecill(?: [abc])?(?: \d \d)?", r"cecill(?: [abc])?(?: licen[cs]e)?"),
    "openrail": ("openrail", r"openrail(?: m)?", r"(?:bigscience |creativeml )?openrail(?: m)?(?: licen[cs]e)?"),
    "ms-pl": ("microsoft public", r"ms pl", r"microsoft public licen[cs]e"),
    "ncsa": ("ncsa", r"ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[cs]e"),
    "proprietary": ("proprietary licen", r"licenseref proprietary", r"proprietary licen[cs]e"),
}

#: level, confidence, keywords, and the words around a name ({id}: in tags, {name}: in prose).
FORMS = (
    (TAG, 1.0, ("spdx",), r"spdx licen[cs]e identifier {id}"),
    (NOTICE, 0.95, ("under",),
     r"(?:re)?(?:licen[cs]ed|released|distributed|published|available|provided|shared|offered|covered) "
     r"(?:to you )?under (?:the |a |an )?(?:(?:terms|conditions|terms and conditions) of )?(?:the |a |an )?{name}"),
    (NOTICE, 0.9, ("licen",),
     r"licen[cs]e (?:is |text |file |type |name |information )?(?:the |a |an )?{name}"),
    (REFERENCE, 0.8, (),
     r"(?:subject to|governed by|according to|accordance with|compliance with|terms of|copy of|see|under) "
     r"(?:the |a |an )?(?:terms of )?(?:the |a |an )?{name}"),
    (NAME, 0.6, (), r"(?:the )?{name}"),
)

#: Sentences of license texts: label, pattern, keywords.
BODIES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software",
     ("permission is hereby granted", "obtaining a copy")),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies",
     ("this permission notice shall",)),
    ("mit-0", r"permission to use copy modify and or distribute this software .{0,80}without fee is hereby granted",
     ("without fee is hereby granted",)),
    ("as-is", r"the software is provided as is without warranty of any kind(?: express or implied)?",
     ("provided as is",)),
    ("as-is", r"this software is provided by the copyright holders and contributors as is",
     ("copyright holders and contributors",)),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted",
     ("redistribution and use",)),
    ("bsd", r"redistributions of source code must retain the above copyright notice", ("redistributions of source",)),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice",
     ("redistributions in binary",)),
    ("bsd-3-clause", r"neither the name of .{1,120}? nor the names of its contributors may be used to endorse",
     ("neither the name of",)),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display",
     ("advertising materials",)),
    ("apache-2.0", r"you may not use this file except in compliance with the license",
     ("except in compliance with the license",)),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license",
     ("agreed to in writing",)),
    ("gnu-gpl", r"this program is free software you can redistribute it and or modify it under the terms of the "
                r"gnu general public license", ("is free software", "gnu general public license")),
    ("gnu-gpl-3", r"gnu general public license as published by the free software foundation either version 3",
     ("either version 3",)),
    ("gnu-gpl-2", r"gnu general public license as published by the free software foundation either version 2",
     ("either version 2",)),
    ("gnu-gpl", r"everyone is permitted to copy and distribute verbatim copies of this license document",
     ("verbatim copies of this license",)),
    ("gnu-gpl", r"without even the implied warranty of merchantability or fitness for a particular purpose",
     ("without even the implied warranty",)),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu "
             r"(?:lesser|library) general public license", ("this library is free software",)),
    ("mozilla-public", r"this source code form is subject to the terms of the mozilla public license",
     ("this source code form is subject",)),
    ("unlicense", r"this is free and unencumbered software released into the public domain",
     ("free and unencumbered software",)),
    ("wtfpl", r"do what the fuck you want to public license", ("you want to public license",)),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors",
     ("without any express or implied warranty",)),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy",
     ("any person or organization obtaining",)),
    ("ofl-1.1", r"the font software may be modified altered or added to", ("the font software may be modified",)),
    ("public-domain", r"(?:is|are|released|placed|dedicated) (?:hereby )?(?:in|into|to) the public domain",
     ("the public domain",)),
    ("cc0", r"to the extent possible under law .{1,120}? has waived all copyright", ("waived all copyright",)),
    ("cc-by-sa", r"creative commons attribution share ?alike(?: \d \d)?", ("creative commons attribution",)),
    ("cc-by-nc", r"creative commons attribution non ?commercial(?: \d \d)?", ("creative commons attribution",)),
    ("cc-by-nd", r"creative commons attribution no ?deriv(?:ative)?s?(?: \d \d)?", ("creative commons attribution",)),
    ("no-redistribution", r"(?:may|must|shall|can) not be (?:copied|reproduced|redistributed|republished)"
                          r"(?: or (?:copied|reproduced|redistributed|distributed))*", (" not be ",)),
    ("no-redistribution", r"no part of this (?:publication|book|work|document) may be reproduced",
     ("no part of this",)),
    ("non-commercial", r"(?:for )?non ?commercial (?:use|purposes) only", ("commercial", "only")),
    ("permission-required", r"without (?:the )?(?:prior |express )*(?:written )?permission", ("permission",)),
    ("no-ai-training", r"(?:may|must|shall) not be used (?:to|for) (?:train|training)", ("not be used",)),
    ("reserved", r"copyright (?:c )?(?:\d{4} )+.{0,80}?all rights reserved", ("copyright", "all rights reserved")),
    ("reserved", r"tous droits r(?:é|e)serv(?:é|e)s", ("tous droits",)),
    ("reserved", r"alle rechte vorbehalten", ("alle rechte",)),
    ("reserved", r"todos los derechos reservados", ("todos los derechos",)),
    ("cc-by-nc-nd", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: \d \d)?",
     ("creative commons attribution",)),
    ("cc-by-nc-sa", r"creative commons attribution non ?commercial share ?alike(?: \d \d)?",
     ("creative commons attribution",)),
)

#: Addresses, as words: label, pattern, keywords.
ADDRESSES = (
    ("cc-by", r"creativecommons org licenses by \d \d", ("creativecommons",)),
    ("cc-by-sa", r"creativecommons org licenses by sa(?: \d \d)?", ("creativecommons",)),
    ("cc-by-nc", r"creativecommons org licenses by nc(?: \d \d)?", ("creativecommons",)),
    ("cc-by-nd", r"creativecommons org licenses by nd(?: \d \d)?", ("creativecommons",)),
    ("cc-by-nc-sa", r"creativecommons org licenses by nc sa(?: \d \d)?", ("creativecommons",)),
    ("cc-by-nc-nd", r"creativecommons org licenses by nc nd(?: \d \d)?", ("creativecommons",)),
    ("cc0", r"creativecommons org publicdomain zero(?: \d \d)?", ("publicdomain zero",)),
    ("public-domain", r"creativecommons org publicdomain mark(?: \d \d)?", ("publicdomain mark",)),
    ("apache-2.0", r"(?:www )?apache org licenses license 2 0", ("apache org licenses",)),
    ("gnu-gpl", r"(?:www )?gnu org (?:licenses gpl(?: \d \d)?|copyleft gpl)", ("gnu org",)),
    ("lgpl", r"(?:www )?gnu org licenses lgpl(?: \d \d)?", ("gnu org licenses lgpl",)),
    ("agpl-3.0", r"(?:www )?gnu org licenses agpl(?: \d \d)?", ("gnu org licenses agpl",)),
    ("gfdl", r"(?:www )?gnu org licenses fdl(?: \d \d)?", ("gnu org licenses fdl",)),
    ("mit", r"opensource org licenses? mit(?: license)?", ("opensource org",)),
    ("bsd", r"opensource org licenses? bsd (?:license|\d clause)", ("opensource org",)),
    ("isc", r"opensource org licenses? isc", ("opensource org",)),
    ("mozilla-public", r"(?:www )?mozilla org (?:en us )?mpl(?: 2 0)?", ("mozilla org",)),
    ("epl", r"(?:www )?eclipse org (?:legal epl|org documents epl)(?: \w+)?", ("eclipse org",)),
    ("bsl-1.0", r"(?:www )?boost org license 1 0", ("boost org",)),
    ("ofl-1.1", r"scripts sil org ofl", ("sil org",)),
    ("unlicense", r"unlicense org", ("unlicense org",)),
    ("odbl", r"opendatacommons org licenses odbl(?: \d \d)?", ("opendatacommons",)),
)


def built_rules() -> tuple[Rule, ...]:
    """All rules by level: every family in every form, license texts, addresses, base phrases."""
    rules = [Rule(level, label, around.format(id=f"(?:{tag})", name=name),
                  ((*more,) if level == TAG else (*more, must)), confidence)
             for level, confidence, more, around in FORMS
             for label, (must, tag, name) in FAMILIES.items()]
    rules += [Rule(BODY, label, pattern, keywords, 0.97) for label, pattern, keywords in BODIES]
    rules += [Rule(ADDRESS, label, pattern, keywords, 0.95) for label, pattern, keywords in ADDRESSES]
    rules += [Rule(PLAIN, label, phrase, (phrase,), BASE) for phrase, label in PHRASES.items()]
    return tuple(sorted(rules, key=lambda r: r.level))


RULES = built_rules()


def places(words: str, phrase: str) -> list[int]:
    """All character places of a phrase of whole words, overlapping ones too."""
    found, want, at = [], f" {phrase} ", 0
    while (at := words.find(want, at)) >= 0:
        found.append(at + 1)
        at += 1
    return found


def remaining(level: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which matches, in the order of their rules, are not suppressed."""
    keep = np.zeros(len(level), bool)
    starts = ends = np.zeros(0, np.int64)
    for now in np.unique(level):
        own = np.flatnonzero(level == now)
        own = own[np.lexsort((own, -last[own], first[own]))]  # outer before inner, earlier rule first
        a, b = first[own], last[own]
        before = np.concatenate([[-1], np.maximum.accumulate(b)[:-1]])
        inside = b <= before
        if len(starts):
            at = np.searchsorted(starts, a, "right") - 1
            inside |= (at >= 0) & (ends[np.maximum(at, 0)] >= b)
        keep[own[~inside]] = True
        starts = np.concatenate([starts, a[~inside]])
        ends = np.concatenate([ends, b[~inside]])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], np.maximum.accumulate(ends[order])
    return keep


class Scanner:
    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = rules
        self.compiled = [re.compile(f"(?<= )(?:{r.pattern})(?= )".encode().decode("latin-1")) for r in rules]
        keywords = sorted({k.encode().decode("latin-1") for r in rules for k in r.keywords})
        number = {k: i for i, k in enumerate(keywords)}
        self.needs = [frozenset(number[k.encode().decode("latin-1")] for k in r.keywords) for r in rules]
        self.by_last: dict[int, list[int]] = {}
        for i, r in enumerate(rules):
            self.by_last.setdefault(number[r.keywords[-1].encode().decode("latin-1")], []).append(i)
        self.automaton = ahocorasick.Automaton()
        for k, i in number.items():
            self.automaton.add_word(k, i)
        self.automaton.make_automaton()

    def present(self, words: str) -> set[int]:
        return {i for _, i in self.automaton.iter(words)}

    def matches(self, words: str) -> list[tuple[int, int, int]]:
        """(rule, start, end) of every match, in the order of the rules, in characters."""
        present, out = self.present(words), []
        for i in sorted(i for k in present for i in self.by_last.get(k, ())):
            if self.needs[i] <= present:
                if self.rules[i].level == PLAIN:
                    size = len(self.rules[i].pattern)
                    out += [(i, at, at + size) for at in places(words, self.rules[i].pattern)]
                else:
                    out += [(i, m.start(), m.end()) for m in self.compiled[i].finditer(words)]
        return out

    def scan(self, text: bytes):
        """Words, base matches and remaining matches as (rule, first word, last word)."""
        split = words_of(text)
        # One character for each byte, so that neither the pass nor the rules need to decode.
        words = f" {b' '.join(split).decode('latin-1')} "
        found = self.matches(words)
        if not found:
            return len(split), [], []
        blanks = [m.start() for m in re.finditer(" ", words)]
        rule = np.array([f[0] for f in found])
        first = np.array([bisect.bisect_left(blanks, f[1]) - 1 for f in found])
        last = np.array([bisect.bisect_left(blanks, f[2]) - 1 for f in found])
        level = np.array([self.rules[i].level for i in rule])
        keep = remaining(level, first, last)
        rows = list(zip(rule.tolist(), first.tolist(), last.tolist(), strict=True))
        return (len(split), [r for r, v in zip(rows, level, strict=True) if v == PLAIN],
                [r for r, k in zip(rows, keep, strict=True) if k])


def score_of(rules: Sequence[Rule], base: list, kept: list) -> tuple[list[str], float]:
    """Sorted labels and the score of base matches and remaining matches."""
    best: dict[str, float] = {}
    for i, *_ in (*base, *kept):
        best[rules[i].label] = max(best.get(rules[i].label, 0.0), rules[i].confidence)
    rest = 1.0
    for label in sorted(best):
        rest *= 1.0 - best[label]
    return sorted(best), 1.0 - rest


ADDED = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
         "labels array<string>, score double, matches array<struct<label:string,level:int,first:bigint,last:bigint>>")


def scanned(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
            carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Adds the words, base places, labels, score and remaining matches of every text."""
    rules = tuple(rules)

    def start():
        scanner = Scanner(rules)

        def work(column):
            rows = []
            for t in utf8(column):
                n, base, kept = scanner.scan(t)
                labels, score = score_of(rules, base, kept)
                rows.append((n, len(base), min((b[1] for b in base), default=None),
                             max((b[1] for b in base), default=None),
                             sorted({rules[b[0]].label for b in base}), labels, score,
                             [{"label": rules[i].label, "level": rules[i].level, "first": a, "last": b}
                              for i, a, b in kept]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()),
                     pa.list_(pa.string()), pa.float64(),
                     pa.list_(pa.struct([("label", pa.string()), ("level", pa.int32()),
                                         ("first", pa.int64()), ("last", pa.int64())])))
            return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return work

    return with_columns(docs, [text], ADDED, start, carry)


def summary(made: DataFrame) -> DataFrame:
    """doc_id and the contracted columns, labels comma-joined, with the number of remaining matches."""
    return made.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                       F.array_join("base_labels", ",").alias("base_labels"),
                       F.array_join("labels", ",").alias("labels"), "score",
                       F.size("matches").cast("bigint").alias("n_matches"))
