"""License scans by sentence rules.

A text is cut into sentences, each is normalised and looked up among the known licence
sentences, and the sequence of their ids is matched against ordered rules: a rule names a
licence by the sentences that make its notice, in order, with at most ``GAP`` unknown
sentences between two of them.  Rules that need more sentences win over those that need
fewer.

Notices are cut in two ways at once: at the end of lines (a notice on a line of its own)
and with the lines of a paragraph joined (a notice that runs over lines).  Comment marks
that lines share are blanked first, so that a comment is cut like the text in it.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, record_batch, slices, strings

#: Unknown sentences that may stand between two sentences of a rule.
GAP = 2

#: Known licence sentences by id.
SENTENCES = {
    "mit.released": "Released under the MIT License.",
    "mit.licensed": "Licensed under the MIT License.",
    "mit.title": "The MIT License (MIT)",
    "mit.short_title": "MIT License",
    "mit.grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit.notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit.warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "apache2.short": "Licensed under the Apache License, Version 2.0.",
    "apache2.released": "Released under the Apache License, Version 2.0.",
    "apache2.header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "apache2.obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache2.warranty": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache2.see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3.work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3.short": "Licensed under the GNU General Public License, version 3.",
    "gpl3.title": "GNU General Public License version 3",
    "gpl.redistribute3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl.redistribute2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl.warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl.details": "See the GNU General Public License for more details.",
    "bsd.redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd.endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "unlicense.public": "This is free and unencumbered software released into the public domain.",
    "mpl2.subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ccbync4.short": "Licensed under CC BY-NC 4.0.",
    "ccbync4.work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "ccby4.short": "Licensed under CC BY 4.0.",
    "ccby4.work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "ccbysa4.short": "Licensed under CC BY-SA 4.0.",
    "ccbysa4.work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0.short": "Licensed under CC0 1.0.",
    "reserved.all": "All rights reserved.",
}

#: Rules, as a licence and the ids of its sentences in order.
RULES = (
    ("MIT", ("mit.grant", "mit.notice", "mit.warranty")),
    ("MIT", ("mit.grant", "mit.notice")),
    ("MIT", ("mit.title",)),
    ("MIT", ("mit.short_title",)),
    ("MIT", ("mit.released",)),
    ("MIT", ("mit.licensed",)),
    ("MIT", ("mit.grant",)),
    ("Apache-2.0", ("apache2.header", "apache2.obtain", "apache2.warranty", "apache2.see")),
    ("Apache-2.0", ("apache2.header", "apache2.warranty")),
    ("Apache-2.0", ("apache2.header",)),
    ("Apache-2.0", ("apache2.short",)),
    ("Apache-2.0", ("apache2.released",)),
    ("GPL-3.0-or-later", ("gpl.redistribute3", "gpl.warranty", "gpl.details")),
    ("GPL-3.0-or-later", ("gpl.redistribute3",)),
    ("GPL-2.0-or-later", ("gpl.redistribute2", "gpl.warranty", "gpl.details")),
    ("GPL-2.0-or-later", ("gpl.redistribute2",)),
    ("GPL-3.0-only", ("gpl3.work",)),
    ("GPL-3.0-only", ("gpl3.short",)),
    ("GPL-3.0-only", ("gpl3.title",)),
    ("BSD-3-Clause", ("bsd.redistribution", "bsd.source", "bsd.binary", "bsd.endorse")),
    ("BSD-2-Clause", ("bsd.redistribution", "bsd.source", "bsd.binary")),
    ("ISC", ("isc.grant",)),
    ("Unlicense", ("unlicense.public",)),
    ("MPL-2.0", ("mpl2.subject",)),
    ("CC-BY-NC-4.0", ("ccbync4.short",)),
    ("CC-BY-NC-4.0", ("ccbync4.work",)),
    ("CC-BY-4.0", ("ccby4.short",)),
    ("CC-BY-4.0", ("ccby4.work",)),
    ("CC-BY-SA-4.0", ("ccbysa4.short",)),
    ("CC-BY-SA-4.0", ("ccbysa4.work",)),
    ("CC0-1.0", ("cc0.short",)),
    ("Proprietary", ("reserved.all",)),
)

#: A sentence ends before white space that follows . ! or ? (but "v. 2.0" goes on) and at an
#: empty line.  It may end at a colon that ends a line, and before a list mark that begins
#: one: a line may as well break there inside a sentence.
_CUT = re.compile(r"(?<=[.!?])\s+(?=[^\s\d])|(?P<weak>(?<=:)[ \t]*\n(?!\s*\n)|\n(?=[^\S\n]*(?:\d+[.)]|[*-])\s))|\n\s*\n")
#: A word of a sentence beside which a line break looks like the end of one.
_WEAK = re.compile(r"\S:(?=\s)|(?<=\s)(?:\d+[.)]|[*-])(?=\s|$)")
_LINE = re.compile(r"\n")
_NOISE = re.compile(r"[^a-z0-9]+")
#: Marks that begin a line of a comment; a star or a single dash may be a list mark as well.
_MARK = re.compile(r"[ \t]*(//+!?|#+|--+|;+|%+|\*+(?:[/)](?=\s|$))?|-(?=\s|$))")
#: A line that opens a comment and does not close it, with the mark if the line begins with
#: it; the end of one.
_OPEN = re.compile(r"([ \t]*(?:/\*+!?|\(\*+|<!--+))|.*?(?:/\*|\(\*|<!--)")
#: Only the first of a run of stars or dashes is tried, so that a long rule costs one pass.
_CLOSE = re.compile(r"^[ \t]*(?:\*+[/)]|--+>)|(?:(?<!\*)\*+[/)]|(?<!-)--+>)\s*$")
_LEAD = re.compile(r"^(?:\d+|[a-z]|[*#/;-]+)[.)]?\s+", re.IGNORECASE)


def sentence_key(sentence: str) -> str:
    """Lower case, letters and digits only, single spaces; list marks at the start go."""
    return _NOISE.sub(" ", _LEAD.sub("", sentence.strip().lower())).strip()


def known_sentences() -> dict[str, str]:
    """Normalised sentence to id."""
    return {sentence_key(s): i for i, s in SENTENCES.items()}


def anchor_words(keys: Iterable[str]) -> list[str]:
    """Words of which every key has one: at each step the word that most of the keys left
    have (of equal ones the longest, then the first).

    A word of a key is one run of letters and digits, which no line break, comment mark or
    spacing can part, so a lower-case text without any of the words has none of the keys.
    """
    left, out = [set(k.split()) for k in keys], []
    while left:
        words = Counter(w for own in left for w in own)
        out.append(min(words, key=lambda w: (len(w) < 6, -words[w], -len(w), w)))
        left = [own for own in left if out[-1] not in own]
    return out


def _pieces(text: str, cut: re.Pattern, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Stretches between cuts."""
    return ((a, b) for a, b, _ in _cut_up(text, cut, start, end))


def _cut_up(text: str, cut: re.Pattern, start: int, end: int) -> Iterator[tuple[int, int, bool]]:
    """Stretches between cuts, and whether the cut behind one is a weak one."""
    at = start
    for m in cut.finditer(text, start, end):
        if m.start() > at:
            yield at, m.start(), m.lastgroup == "weak"
        at = m.end()
    if end > at:
        yield at, end, False


def uncommented(text: str) -> str:
    """The text with the comment marks that consecutive lines share as spaces, place by place.

    Stars and single dashes count only if they stand on every line of a paragraph or of a
    comment; else they mark the items of a list.
    """
    lines, marks = text.split("\n"), []
    for line in lines:
        m = _MARK.match(line)
        marks.append(m and (m[1][0] + (m[1] == "-") * " ", m.end()))
    out, i = list(lines), 0
    opened = lambda line: (m := _OPEN.match(line)) and not _CLOSE.search(line, m.end()) and m
    while i < len(lines):
        if not marks[i]:
            i += 1
            continue
        kind, j = marks[i][0], i + 1
        while j < len(lines) and marks[j] and marks[j][0] == kind and not (kind == "*" and _CLOSE.search(lines[j - 1])):
            j += 1
        top = opened(lines[i - 1]) if i else None
        shared = j - i > 1 or top
        if kind in ("*", "- "):
            starts = i == 0 or not lines[i - 1].strip() or top
            ends = j == len(lines) or not lines[j].strip() or _CLOSE.search(lines[j - 1]) or _CLOSE.match(lines[j])
            shared = shared and starts and ends
        if shared:
            for k in range(i, j):
                out[k] = " " * marks[k][1] + lines[k][marks[k][1] :]
            if top and top[1]:
                out[i - 1] = " " * len(top[1]) + lines[i - 1][len(top[1]) :]
        i = j
    return "\n".join(out)


class Recogniser:
    """Known sentences of a text, and the rules that they meet."""

    def __init__(self, gap: int = GAP):
        self.known, self.gap = known_sentences(), gap
        self.anchors = anchor_words(self.known)
        #: Weak cuts that can lie inside a known sentence.
        self.weak = max(len(_WEAK.findall(x)) for x in SENTENCES.values())
        self.rules = sorted(RULES, key=lambda r: -len(r[1]))

    def sentences(self, text: str) -> list[tuple[int, int, int, int, str]]:
        """(first, last, start, end, id) of the known sentences in order; first and last
        number the paragraph sentences, known or not, that it begins and ends in."""
        found: dict[tuple[int, int], str] = {}
        bare = uncommented(text)
        starts = [a for a, _ in _pieces(bare, _CUT, 0, len(bare))]
        for body in (bare, text) if bare != text else (text,):
            cuts = list(_cut_up(body, _CUT, 0, len(body)))
            for n, (a, b, _) in enumerate(cuts):
                spans = [(a, b)]
                if "\n" in body[a:b]:
                    spans += _pieces(body, _LINE, a, b)
                for k in range(n, min(n + self.weak, len(cuts) - 1)):
                    if not cuts[k][2]:
                        break
                    spans.append((a, cuts[k + 1][1]))
                for x, y in spans:
                    if body is not text:  # blanked marks at the end are no part of a notice
                        y = x + len(body[x:y].rstrip())
                    if own := self.known.get(sentence_key(body[x:y])):
                        found.setdefault((x, y), own)
        out: list[tuple[int, int, int, int, str]] = []
        for (a, b), own in sorted(found.items(), key=lambda x: (x[0][0], -x[0][1])):
            if not out or a >= out[-1][3]:
                first, last = (max(0, bisect_right(starts, at) - 1) for at in (a, b - 1))
                out.append((first, last, a, b, own))
        return out

    def __call__(self, text: str) -> list[tuple[str, str, int, int, int]]:
        """(licence, rule, sentences, start, end) of the rules met, in order; a sentence
        serves one rule."""
        lower = text.lower()
        if not any(a in lower for a in self.anchors):
            return []
        row = self.sentences(text)
        out, at = [], 0
        while at < len(row):
            for licence, ids in self.rules:
                got = self._meets(row, at, ids)
                if got:
                    out.append((licence, "+".join(ids), len(ids), row[at][2], row[got - 1][3]))
                    at = got
                    break
            else:
                at += 1
        return out

    def _meets(self, row: list[tuple[int, int, int, int, str]], at: int, ids: tuple[str, ...]) -> int:
        """The place behind the sentences that meet the rule from ``at`` on, or 0."""
        if at + len(ids) > len(row):
            return 0
        for k, want in enumerate(ids):
            first, _, _, _, own = row[at + k]
            if own != want or k and first - row[at + k - 1][1] > self.gap + 1:
                return 0
        return at + len(ids)


def license_notices(docs: DataFrame, id_col: str = "doc_id", text: str = "text", gap: int = GAP) -> DataFrame:
    """id, license, rule, n_sentences, start, end: one row per rule met in a text.

    Null and empty texts have none, an empty table gives no rows, a null id stays null.
    Every row is scanned by itself, so repeated rows give repeated results.  Of rules that
    begin at one sentence the one with the most sentences is taken, of equally long ones the
    first listed.  A text of any length is scanned whole, in time proportional to it.  Places
    are code points, end exclusive.
    """
    schema = pa.schema([("id", pa.int64()), ("license", pa.string()), ("rule", pa.string()), ("n_sentences", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recognise = Recogniser(gap)
        for batch in slices(batches):
            found = [(d, *hit) for d, t in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True) for hit in recognise(t)]
            if found:
                yield record_batch(schema, [list(c) for c in zip(*found, strict=True)])

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text)), work, "id long, license string, rule string, n_sentences long, start long, end long")
