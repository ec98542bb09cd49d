"""License scans by ordered signature rules.

A rule is a hand-written pattern with a label, a priority and keywords. A text
is first searched for the keywords (one pass over the whole text); only the
rules whose keyword occurs are matched. Detections of different rules may lie
inside each other ("apache license" inside "apache license, version 2.0"):
they are taken by priority, then length, then start, and one that lies wholly
inside a detection already taken is suppressed.

Rules are written over words: "mit license" stands for the two words next to
each other with any run of non-word characters between them. The families below
give the names and versions; the forms give the wordings in which a name is
stated, so several hundred rules come from two short tables.

Edge cases: a null or empty text has no words, no detections and score 0; equal
intervals go to the earlier rule; texts are never cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundtrail.llm.textblocks import LOWER, WORD_BYTES, blocks, runs

WORD = rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]"
GAP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"

# The phrases that always count, with their labels.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Families: label, names, versions. A name is a sequence of words; (a b)? marks an optional part.
FAMILIES = (
    ("apache", ("apache license", "apache software license"), ("1.0", "1.1", "2.0")),
    ("mit", ("mit license", "expat license", "x11 license"), ()),
    ("gpl", ("gnu general public license", "general public license", "gnu gpl", "gpl"), ("1", "2", "3", "2.0", "3.0")),
    ("lgpl", ("gnu lesser general public license", "lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl"), ("2", "2.1", "3", "3.0")),
    ("agpl", ("gnu affero general public license", "affero general public license", "gnu agpl", "agpl"), ("1", "3", "3.0")),
    ("bsd", ("bsd license", "berkeley software distribution license", "bsd 2 clause license", "bsd 3 clause license", "simplified bsd license", "new bsd license", "modified bsd license"), ()),
    ("mpl", ("mozilla public license", "mpl"), ("1.0", "1.1", "2.0")),
    ("epl", ("eclipse public license", "epl"), ("1.0", "2.0")),
    ("cddl", ("common development and distribution license", "cddl"), ("1.0", "1.1")),
    ("cpl", ("common public license",), ("0.5", "1.0")),
    ("eupl", ("european union public license", "european union public licence", "eupl"), ("1.0", "1.1", "1.2")),
    ("artistic", ("artistic license", "perl artistic license"), ("1.0", "2.0")),
    ("isc", ("isc license", "internet systems consortium license"), ()),
    ("zlib", ("zlib license", "zlib libpng license"), ()),
    ("boost", ("boost software license",), ("1.0",)),
    ("unlicense", ("the unlicense", "unlicense license"), ()),
    ("wtfpl", ("wtfpl", "wtfpl license"), ("1", "2")),
    ("python", ("python software foundation license", "psf license"), ("2",)),
    ("php", ("php license",), ("3.0", "3.01")),
    ("ruby", ("ruby license",), ()),
    ("postgresql", ("postgresql license",), ()),
    ("openssl", ("openssl license",), ()),
    ("ofl", ("sil open font license", "open font license"), ("1.0", "1.1")),
    ("odbl", ("open database license", "odbl"), ("1.0",)),
    ("odc-by", ("open data commons attribution license",), ("1.0",)),
    ("gfdl", ("gnu free documentation license", "free documentation license", "gfdl"), ("1.1", "1.2", "1.3")),
    ("ms-pl", ("microsoft public license",), ()),
    ("ms-rl", ("microsoft reciprocal license",), ()),
    ("cecill", ("cecill license", "cecill"), ("1.0", "1.1", "2.0", "2.1")),
    ("osl", ("open software license",), ("1.0", "2.0", "2.1", "3.0")),
    ("afl", ("academic free license",), ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("bsl", ("business source license",), ("1.0", "1.1")),
    ("sspl", ("server side public license", "sspl"), ("1",)),
    ("elastic", ("elastic license",), ("1.0", "2.0")),
    ("cc0", ("creative commons zero", "cc0"), ("1.0",)),
    ("cc-by", ("creative commons attribution", "cc by"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", ("creative commons attribution sharealike", "creative commons attribution share alike", "cc by sa"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc", ("creative commons attribution noncommercial", "creative commons attribution non commercial", "cc by nc"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd", ("creative commons attribution noderivatives", "creative commons attribution no derivatives", "cc by nd"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa", ("creative commons attribution noncommercial sharealike", "cc by nc sa"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-nd", ("creative commons attribution noncommercial noderivatives", "cc by nc nd"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
)

# Notices: fixed wordings, without a family's name.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "this software is provided as is without any express or implied warranty"),
    ("public-domain", "released into the public domain"),
    ("public-domain", "dedicated to the public domain"),
    ("public-domain", "this work is in the public domain"),
    ("proprietary", "all rights reserved"),
    ("proprietary", "proprietary and confidential"),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "this software is provided by the copyright holders and contributors as is"),
    ("apache", "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("lgpl", "you should have received a copy of the gnu lesser general public license along with this library"),
    ("agpl", "you should have received a copy of the gnu affero general public license along with this program"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("ofl", "this font software is licensed under the sil open font license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights"),
)

# Identifiers behind "SPDX-License-Identifier:", by label.
SPDX = (
    ("mit", ("MIT", "MIT-0", "X11")),
    ("apache", ("Apache-1.0", "Apache-1.1", "Apache-2.0")),
    ("bsd", ("0BSD", "BSD-1-Clause", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause")),
    ("gpl", ("GPL-1.0", "GPL-2.0", "GPL-3.0")),
    ("lgpl", ("LGPL-2.0", "LGPL-2.1", "LGPL-3.0")),
    ("agpl", ("AGPL-1.0", "AGPL-3.0")),
    ("mpl", ("MPL-1.0", "MPL-1.1", "MPL-2.0")),
    ("epl", ("EPL-1.0", "EPL-2.0")),
    ("cddl", ("CDDL-1.0", "CDDL-1.1")),
    ("eupl", ("EUPL-1.0", "EUPL-1.1", "EUPL-1.2")),
    ("isc", ("ISC",)),
    ("zlib", ("Zlib",)),
    ("boost", ("BSL-1.0",)),
    ("unlicense", ("Unlicense",)),
    ("wtfpl", ("WTFPL",)),
    ("artistic", ("Artistic-1.0", "Artistic-2.0")),
    ("python", ("PSF-2.0", "Python-2.0")),
    ("postgresql", ("PostgreSQL",)),
    ("openssl", ("OpenSSL",)),
    ("ofl", ("OFL-1.0", "OFL-1.1")),
    ("cc0", ("CC0-1.0",)),
    ("cc-by", ("CC-BY-3.0", "CC-BY-4.0")),
    ("cc-by-sa", ("CC-BY-SA-3.0", "CC-BY-SA-4.0")),
    ("cc-by-nc", ("CC-BY-NC-3.0", "CC-BY-NC-4.0")),
    ("cc-by-nd", ("CC-BY-ND-3.0", "CC-BY-ND-4.0")),
)

# Forms in which a name is stated, with the confidence of the statement. {} is the name.
FORMS = (
    ("this work is licensed under the {}", 1.0),
    ("licensed under {}", 0.98),
    ("licensed under the {}", 0.98),
    ("released under the {}", 0.97),
    ("distributed under the {}", 0.97),
    ("available under the {}", 0.95),
    ("under the terms of the {}", 0.95),
    ("spdx license identifier {}", 1.0),
)
PLAIN_CONFIDENCE = 0.8
NOTICE_CONFIDENCE = 0.9


@dataclass(frozen=True)
class Rule:
    """``keyword`` must occur as a word of the lower-cased text before the pattern is tried."""

    label: str
    pattern: bytes
    priority: int  # smaller goes first
    confidence: float
    keyword: str


def _phrase(words: str, version: str | None = None) -> bytes:
    """Bytes pattern of words standing next to each other, with an optional version behind."""
    parts = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", words.lower())
    body = GAP.join(re.escape(p.encode()) for p in parts)
    if version is not None:
        digits = GAP.join(re.escape(p.encode()) for p in version.split("."))
        # "version 2", "v2.0", "2.0", with "or later" left outside
        body += GAP + rb"(?:version" + GAP + rb"|ver" + GAP + rb"|v" + GAP + rb"|v)?" + digits
    return rb"(?<!" + WORD + rb")" + body + rb"(?!" + WORD + rb")"


def _keyword(name: str) -> str:
    """The longest word of a name: rare enough in prose to gate its rules."""
    return max(name.split(), key=lambda w: (w not in ("license", "licence", "public", "general", "software"), len(w)))


def build_rules() -> list[Rule]:
    """All rules, in order: with version before without, stated before plain, longer names before shorter."""
    rules = []
    for label, names, versions in FAMILIES:
        for name in names:
            for version in versions:
                rules.append(Rule(label, _phrase(name, version), 20, 0.95, _keyword(name)))
            for form, confidence in FORMS:
                rules.append(Rule(label, _phrase(form.format(name)), 10, confidence, _keyword(name)))
            rules.append(Rule(label, _phrase(name), 30, PLAIN_CONFIDENCE, _keyword(name)))
    for label, words in NOTICES:
        rules.append(Rule(label, _phrase(words), 15, NOTICE_CONFIDENCE, _keyword(words)))
    for label, names in SPDX:
        for name in names:
            rules.append(Rule(label, _phrase(f"spdx license identifier {name}"), 10, 1.0, "identifier"))
    return rules


def _resolve(found: list[tuple]) -> list[tuple]:
    """Detections (priority, -length, start, end, rule) that are not inside one taken before.

    A tree over the starts keeps the furthest end taken from any start up to
    each place, so n detections take n log n steps.
    """
    place = {start: k + 1 for k, start in enumerate(sorted({hit[2] for hit in found}))}
    furthest = [-1] * (len(place) + 1)
    taken: list[tuple] = []
    for hit in sorted(found):
        _, _, start, end, _ = hit
        k, reach = place[start], -1
        while k:
            reach = max(reach, furthest[k])
            k &= k - 1
        if reach >= end:
            continue
        taken.append(hit)
        k = place[start]
        while k <= len(place):
            furthest[k] = max(furthest[k], end)
            k += k & -k
    return sorted(taken, key=lambda h: (h[2], h[3], h[4]))


class Scanner:
    """Matches the rules against lower-cased bytes."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.compiled = [re.compile(r.pattern) for r in rules]
        self.base = [(re.compile(_phrase(p)), label) for p, label in BASE_PHRASES]
        by_keyword: dict[str, list[int]] = {}
        for k, rule in enumerate(rules):
            by_keyword.setdefault(rule.keyword, []).append(k)
        # base phrases share one keyword
        by_keyword.setdefault("license", [])
        self.gate = ahocorasick.Automaton()
        for word, ks in by_keyword.items():
            self.gate.add_word(word, (word, ks))
        self.gate.make_automaton()

    def scan(self, text: bytes) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, float]]]:
        """(base places as (byte, label), detections as (start byte, end byte, label, confidence))."""
        # latin-1 keeps one character per byte, so places in the string are places in the bytes
        seen = {}
        for end, (word, ks) in self.gate.iter(text.decode("latin-1")):
            start = end - len(word)
            whole = (start < 0 or not WORD_BYTES[text[start]]) and (
                end + 1 == len(text) or not WORD_BYTES[text[end + 1]]
            )
            if whole:
                seen[word] = ks
        if not seen:
            return [], []
        base = []
        if "license" in seen:
            base = [(m.start(), label) for pattern, label in self.base for m in pattern.finditer(text)]
        found = []
        for ks in seen.values():
            for k in ks:
                for m in self.compiled[k].finditer(text):
                    found.append((self.rules[k].priority, m.start() - m.end(), m.start(), m.end(), k))
        hits = [(a, b, self.rules[k].label, self.rules[k].confidence) for _, _, a, b, k in _resolve(found)]
        return base, hits


def scan_licenses(
    docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_words, the base places and the detections, both by word.

    ``base``: array of (word, label); ``detections``: array of (first_word,
    end_word, label, confidence).
    """
    rules = build_rules() if rules is None else rules
    base_type = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    hit_type = pa.list_(
        pa.struct(
            [("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string()), ("confidence", pa.float64())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            for a, b, data, offs in blocks(batch.column("_text")):
                low = LOWER[data]
                starts, _, first = runs(low, offs, WORD_BYTES)
                raw = low.tobytes()
                base_rows, hit_rows = [], []
                for k in range(b - a):
                    base, hits = scanner.scan(raw[offs[k] : offs[k + 1]])
                    word = lambda at, k=k: int(np.searchsorted(starts, at + offs[k]) - first[k])
                    base_rows.append([{"word": word(at), "label": label} for at, label in base])
                    hit_rows.append(
                        [
                            {"first_word": word(x), "end_word": word(y), "label": label, "confidence": confidence}
                            for x, y, label, confidence in hits
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(a, b - a),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(base_rows, base_type),
                        pa.array(hit_rows, hit_type),
                    ],
                    ["_id", "n_words", "base", "detections"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run,
        f"_id {kind}, n_words long, base array<struct<word:long,label:string>>, "
        "detections array<struct<first_word:long,end_word:long,label:string,confidence:double>>",
    )
    return out.withColumnRenamed("_id", id_col)
