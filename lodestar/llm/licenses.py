"""License scans: patience alignment of license notices with whole texts."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import id_and_text

# Names of licenses as their short notices give them.
_NAMED = {
    "Apache-2.0": "Apache License, Version 2.0", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License",
    "BSL-1.0": "Boost Software License, Version 1.0", "EPL-2.0": "Eclipse Public License, Version 2.0", "ISC": "ISC License",
    "MPL-2.0": "Mozilla Public License, Version 2.0", "Unlicense": "The Unlicense", "Zlib": "zlib License",
    "GPL-2.0": "GNU General Public License, version 2", "GPL-3.0": "GNU General Public License, version 3",
    "LGPL-2.1": "GNU Lesser General Public License, version 2.1", "LGPL-3.0": "GNU Lesser General Public License, version 3",
    "AGPL-3.0": "GNU Affero General Public License, version 3",
}
# Creative Commons variants, their long names, and what follows a version.
_COMMONS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_VERSIONS = {"3.0": "Unported", "4.0": "International"}
# Sentences of license texts.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
    "product includes software developed by the organization. ")
_NO_ENDORSEMENT = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. ")
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES'
_WITHOUT_FEE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_FREE = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} Public License as published "
    "by the Free Software Foundation, either version {2} of the License, or (at your option) any later version.")
# Each notice with its telling words: runs that a match holds with no other word between.
_LONG = {
    "0BSD-permission": (f'{_WITHOUT_FEE}. THE SOFTWARE IS PROVIDED "AS IS"', "with or without fee is hereby granted the software is provided"),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied.", "Apache License, Version 2.0"),
    "BSD-2-Clause-text": (_BSD + _BSD_END, "provided with the distribution this software is provided by"),
    "BSD-3-Clause-text": (f"{_BSD}3. {_NO_ENDORSEMENT}{_BSD_END}", "source and binary forms", "neither the name of"),
    "BSD-4-Clause-text": (f"{_BSD}{_ADVERTISING}4. {_NO_ENDORSEMENT}{_BSD_END}", "all advertising materials", "neither the name of"),
    "CC0-1.0": ("Licensed under CC0 1.0 Universal.", "CC0 1.0"),
    "CC0-1.0-statement": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "waived all copyright and related or neighboring rights"),
    "ISC-permission": (
        f"{_WITHOUT_FEE}, provided that the above copyright notice and this permission notice appear in all copies.",
        "with or without fee is hereby granted provided that the above copyright notice"),
    "MIT": ("Released under the MIT License.", "MIT License"),
    "MIT-disclaimer": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "authors or copyright holders be liable"),
    "MIT-permission": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:", "to deal in the software", "subject to"),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "Mozilla Public License, v. 2.0"),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.", "free and unencumbered software released into the public domain"),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "to alter it and redistribute it freely"),
}


def _notices() -> dict[str, tuple[str, ...]]:
    found = dict(_LONG)
    for name, called in _NAMED.items():
        work = "This work is licensed" if name.startswith(("GPL", "LGPL", "AGPL")) else "Licensed"
        found[name] = (f"{work} under {'' if called.startswith('The ') else 'the '}{called}.", called)
    for name, kind, version in (("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("LGPL-2.1", "Lesser General", "2.1"),
                                ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3")):
        text = _FREE.format("library" if name == "LGPL-2.1" else "program", kind, version)
        found[f"{name}-header"] = (text, f"GNU {kind} Public License", f"version {version} of the License")
    for variant, called in _COMMONS.items():
        for version, scope in _VERSIONS.items():
            found[f"CC-{variant}-{version}"] = (f"Licensed under CC {variant} {version}.", f"CC {variant} {version}")
            found[f"CC-{variant}-{version}-work"] = (
                f"This work is licensed under a Creative Commons {called} {version} {scope} License.", f"Creative Commons {called} {version}")
    return found


TELLING = {name: telling for name, (_, *telling) in _notices().items()}
NOTICES = {name: text for name, (text, *_) in _notices().items()}
COVERAGE = 0.8
_WORD = re.compile(r"\w+")


def word_list(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def longest_rising(values: list[int]) -> list[int]:
    """Indexes of a longest strictly increasing subsequence, by patience piles."""
    tops, ends, before = [], [], [-1] * len(values)
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        before[i] = ends[pile - 1] if pile else -1
        tops[pile:pile + 1], ends[pile:pile + 1] = [value], [i]
    chain, at = [], ends[-1] if ends else -1
    while at >= 0:
        chain.append(at)
        at = before[at]
    return chain[::-1]


def patience(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matching places of both, ascending.

    Equal words at both ends match; words that occur once in both are anchors, of which the
    longest rising chain stays; the gaps between anchors are aligned in the same way.
    """
    matches, open_gaps = [], [(0, len(text), 0, len(template))]
    while open_gaps:
        a, b, c, d = open_gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            matches.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            matches.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(template[c:d], c) if there[w] == 1}
        pairs = [(i, place[w]) for i, w in enumerate(text[a:b], a) if here[w] == 1 and w in place]
        anchors = [pairs[i] for i in longest_rising([p for _, p in pairs])]
        if not anchors:
            continue
        matches += anchors
        ends = [(a - 1, c - 1), *anchors, (b, d)]
        open_gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(matches)


class Notice:
    """A template with what its search needs.

    Its telling words, if it has any, are runs that a match must hold with no other word between.
    """

    def __init__(self, name: str, text: str, least: float, telling: Sequence[str] = ()):
        self.name, self.words, self.least = name, word_list(text), least
        self.counts = Counter(self.words)
        self.reach = max(int(len(self.words) / least + 1e-9), len(self.words))
        # A match leaves out at most this many words, so one of any more words must be there.
        spare = len(self.words) * (1 - least) + 1e-9
        self.starts = set(self.words[:int(spare) + 1])
        self.runs = []
        for run in filter(None, map(word_list, telling)):
            place = next(iter(places_of(run, self.words)), None)
            if place is None:
                raise ValueError(f"telling words of {name} are not in its text: {' '.join(run)}")
            self.runs.append((place, run))
        self.needed = []
        for word in sorted(self.counts, key=lambda w: (-len(w), w)):
            self.needed.append(word)
            spare -= self.counts[word]
            if spare < 0:
                break
        self.telling = sorted({w for _, run in self.runs for w in run}, key=lambda w: (-len(w), w))
        self.telling_line = re.compile(r"\W+".join(map(re.escape, self.runs[0][1]))) if self.runs else None

    def possible(self, low: str, has) -> bool:
        """Whether a lower-cased text holds what a match cannot do without; ``has`` looks up one word."""
        if self.runs:
            return all(map(has, self.telling)) and self.telling_line.search(low) is not None
        return any(map(has, self.needed))

    def find(self, words: list[str]) -> list[tuple[float, int, int]]:
        """``(coverage, first, last)`` of every separate stretch of words that the notice covers.

        With telling words, each place of the first run is aligned to both sides as far as a match
        can reach. Without, a match starts with one of the notice's first words, as few may be
        missing: the windows of one reach from each of their places are aligned.
        """
        found = []
        for matches, kept in self._around_runs(words) if self.runs else self._from_starts(words):
            best = self._densest(matches, kept)
            if best and best[0] >= self.least - 1e-9:
                found.append(best)
        return apart(found, lambda f: (-f[0], f[2] - f[1], f[1]))

    def _around_runs(self, words: list[str]):
        place, run = self.runs[0]
        slack = self.reach - len(self.words)
        for at in places_of(run, words):
            low, after = max(0, at - place - slack), at + len(run)
            # Backwards, so that equal words next to the run match first, as they do behind it.
            before = patience(words[low:at][::-1], self.words[:place][::-1])
            matches = [(at - 1 - i, place - 1 - j) for i, j in before[::-1]]
            matches += [(at + i, place + i) for i in range(len(run))]
            behind = words[after:after + len(self.words) - place - len(run) + slack]
            matches += [(i + after, j + place + len(run)) for i, j in patience(behind, self.words[place + len(run):])]
            aligned = {j: i for i, j in matches}
            ends = [at, after - 1]
            for start, other in self.runs[1:]:
                first = aligned.get(start)
                if first is None or any(aligned.get(start + i) != first + i for i in range(len(other))):
                    break
                ends += [first, first + len(other) - 1]
            else:
                yield matches, (min(ends), max(ends))

    def _from_starts(self, words: list[str]):
        own = [i for i, w in enumerate(words) if w in self.counts]
        for rank, at in enumerate(own):
            if words[at] not in self.starts or bisect_left(own, at + self.reach) - rank < self.least * len(self.words) - 1e-9:
                continue
            window = words[at:at + self.reach]
            if sum((Counter(window) & self.counts).values()) >= self.least * len(self.words) - 1e-9:
                yield [(i + at, j) for i, j in patience(window, self.words)], None

    def _densest(self, matches: list[tuple[int, int]], kept: tuple[int, int] | None):
        """The stretch of at most ``reach`` words, around ``kept``, with the most matches: coverage, first, last."""
        best, low = None, 0
        for high, (place, _) in enumerate(matches):
            while place - matches[low][0] >= self.reach:
                low += 1
            first, count = matches[low][0], high - low + 1
            if kept and not first <= kept[0] <= kept[1] <= place:
                continue
            if best is None or (count, first - place) > (best[0], best[1] - best[2]):
                best = (count, first, place)
        return best and (best[0] / len(self.words), best[1], best[2])


def places_of(run: list[str], words: list[str]) -> list[int]:
    """Where a run of words starts, also within itself."""
    found, at = [], -1
    try:
        while True:
            at = words.index(run[0], at + 1)
            if words[at:at + len(run)] == run:
                found.append(at)
    except ValueError:
        return found


def apart(found: list[tuple], order) -> list[tuple]:
    """The ``(_, first, last, ...)`` stretches that overlap none before them in the order, by place."""
    kept: list[tuple] = []
    for item in sorted(found, key=order):
        at = bisect_left(kept, item[1], key=lambda k: k[2])
        if at == len(kept) or item[2] < kept[at][1]:
            kept.insert(at, item)
    return kept


def fullest(found: list[tuple]) -> list[tuple]:
    """Of overlapping ``(coverage, first, last, notice)`` stretches the one with most aligned words."""
    return apart(found, lambda f: (-round(f[0] * len(f[3].words)), f[2] - f[1], f[1], f[3].name))


def scan(docs: DataFrame, notices: dict[str, str] | None = None, least: float = COVERAGE,
         telling: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """``doc_id, license, coverage, start, end``: every stretch of a text that a notice covers.

    Coverage is the share of the notice's words aligned in order within the stretch, which is at
    most ``1 / least`` times as long; ``start`` and ``end`` are its code points. ``telling`` names
    runs of words, such as a license's name and version, that a match of a notice holds with no other
    word between, so that a near relative is not taken for it; a license that has no template
    gives no row, though its relatives have one. Notices that follow each other are told apart. A text without a
    match has one row with nulls, so have missing and empty texts. Repeated rows give repeated
    rows, an empty table none; extra columns are ignored. Where stretches of several notices
    overlap, the one with the most aligned words stays, then the tighter one.
    """
    texts = NOTICES if notices is None else notices
    runs = telling if telling is not None else TELLING if notices is None else {}

    def work(batches):
        made = [Notice(name, text, least, runs.get(name, ())) for name, text in texts.items() if word_list(text)]
        for batch in batches:
            owner, name, coverage, start, end = [], [], [], [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                low, before, spans, words, found = text.lower(), len(owner), None, [], []
                has = lru_cache(maxsize=None)(low.__contains__)
                for notice in made:
                    if not notice.possible(low, has):
                        continue
                    if spans is None:
                        spans = [m.span() for m in _WORD.finditer(text)]
                        words = [text[a:b].lower() for a, b in spans]
                    found += [(share, first, last, notice) for share, first, last in notice.find(words)]
                for share, first, last, notice in fullest(found):
                    owner.append(at)
                    name.append(notice.name)
                    coverage.append(share)
                    start.append(spans[first][0])
                    end.append(spans[last][1])
                if len(owner) == before:
                    owner.append(at)
                    for column in (name, coverage, start, end):
                        column.append(None)
            yield pa.record_batch(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(name, pa.string()), pa.array(coverage, pa.float64()),
                 pa.array(start, pa.int64()), pa.array(end, pa.int64())], ["doc_id", "license", "coverage", "start", "end"])

    rows = id_and_text(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, license string, coverage double, start bigint, end bigint")
