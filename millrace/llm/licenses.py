"""Licence scans: texts compared to licence templates by the Dice coefficient of word bigrams.

A document is looked at as a whole, by paragraph, by line and by sentence, and, for each
template, by runs of as many words as the template has, wherever they begin: so a licence
is found alone, in a comment block, wrapped over lines or amid other words. Each of these, normalised
to lower-case words, has a set A of word bigrams, a template a set B, and Dice is 2 |A n B| / (|A| + |B|).
It can reach a threshold t only if |A| lies between t / (2 - t) and (2 - t) / t times |B|, and only if A
holds t / (2 - t) of B. The first bound leaves few templates for most segments; the second leaves few
documents, and in them the runs around so many hits.

Defined results: a null text has no segments; a segment of fewer than two words has no
bigrams and matches nothing; the best coefficient of a licence counts, in whichever part it is found, and
licences with the same coefficient come by name. Rows that share a doc_id are scanned
each for itself. An empty table gives an empty result. Columns other than doc_id and text do
not matter.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import pick

THRESHOLD = 0.8
#: Bytes of all templates together, which are broadcast.
TEMPLATE_BYTES = 64_000_000

# Notices as licences ask for them, and the sentences that stand for them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
]

_WORDS = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")
_PARAGRAPH = re.compile(r"\n\s*\n")
_SENTENCE = re.compile(r"(?<=[.!?;])\s+")


def words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def segments(text: str) -> Iterator[list[str]]:
    """Words of the sentences, lines, paragraphs and the whole of a text; a part that is a larger one too comes once."""
    whole: list[str] = []
    paragraphs = 0
    for block in _PARAGRAPH.split(text):
        joined: list[str] = []
        lines = 0
        for line in block.split("\n"):
            own: list[str] = []
            parts = 0
            for sentence in _SENTENCE.split(line):
                if found := words(sentence):
                    parts += 1
                    own += found
                    yield found
            if parts > 1:
                yield own
            if parts:
                lines += 1
                joined += own
        if lines > 1:
            yield joined
        if lines:
            paragraphs += 1
            whole += joined
    if paragraphs > 1:
        yield whole


class Templates:
    """Templates by the number of their bigrams, and by bigram."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold lies above 0 and up to 1")
        cut = [(name, words(text)) for name, text in templates]
        made = sorted(((len(b), name, len(w), b) for name, w in cut if (b := frozenset(zip(w, w[1:])))), key=lambda m: m[:3])
        self.threshold = threshold
        self.sizes = [size for size, _, _, _ in made]
        self.names = [name for _, name, _, _ in made]
        #: Bigrams in a run of a template's length, and how many of the template's it must hold.
        self.widths = [width - 1 for _, _, width, _ in made]
        self.needs = [max(1, math.ceil(size * threshold / (2 - threshold) - 1e-9)) for size in self.sizes]
        self.at: dict[tuple[str, str], list[int]] = defaultdict(list)
        for i, (_, _, _, bigrams) in enumerate(made):
            for bigram in bigrams:
                self.at[bigram].append(i)
        self.known = frozenset(self.at)

    def matches(self, found: list[str]) -> Iterator[tuple[str, float]]:
        """Names and coefficients of the templates that a segment's words reach."""
        if self.known.isdisjoint(zip(found, found[1:])):
            return
        bigrams = set(zip(found, found[1:]))
        t, size = self.threshold, len(bigrams)
        low, high = bisect_left(self.sizes, size * t / (2 - t) - 1e-9), bisect_right(self.sizes, size * (2 - t) / t + 1e-9)
        if low >= high:
            return
        shared = Counter(i for bigram in bigrams if bigram in self.known for i in self.at[bigram] if low <= i < high)
        for i, n in shared.items():
            if (dice := 2 * n / (size + self.sizes[i])) >= t:
                yield self.names[i], dice

    def runs(self, i: int, bigrams: list[tuple[str, str]], hits: list[int]) -> tuple[float, int]:
        """The best coefficient of template ``i`` with a run of its length, and how many runs that do not overlap reach the threshold.

        ``hits`` are the places of the template's bigrams. Only runs that hold enough of them are looked at.
        """
        width, need, last = self.widths[i], self.needs[i], len(bigrams) - self.widths[i]
        own, inside, best, places, free = Counter(), 0, 0.0, 0, 0
        begin = end = 0  # own counts the bigrams from begin to end
        for first, final in zip(hits, hits[need - 1 :]):
            for start in range(max(begin, 0, final - width + 1), min(first, last) + 1):
                if start >= end:
                    own, inside, begin, end = Counter(), 0, start, start
                while begin < start:
                    gone = bigrams[begin]
                    own[gone] -= 1
                    if not own[gone]:
                        del own[gone]
                        inside -= i in self.at.get(gone, ())
                    begin += 1
                while end < start + width:
                    if bigrams[end] not in own:
                        inside += i in self.at.get(bigrams[end], ())
                    own[bigrams[end]] += 1
                    end += 1
                dice = 2 * inside / (len(own) + self.sizes[i])
                if dice >= self.threshold:
                    best = max(best, dice)
                    if start >= free:
                        places, free = places + 1, start + width + 1
        return best, places

    def best(self, text: str) -> list[dict]:
        """For each licence found in a text, its best coefficient and in how many segments it was found, or in how many runs alone."""
        found = words(text)
        bigrams = list(zip(found, found[1:]))
        hits: dict[int, list[int]] = defaultdict(list)
        for place, bigram in enumerate(bigrams):
            if bigram in self.known:
                for i in self.at[bigram]:
                    hits[i].append(place)
        # Neither a segment nor a run can hold more of a template than the whole text.
        likely = [i for i, at in hits.items() if len({bigrams[place] for place in at}) >= self.needs[i]]
        if not likely:
            return []
        best: dict[str, float] = {}
        seen: Counter = Counter()
        amid: dict[str, int] = {}
        for part in segments(text):
            # A licence has several templates: of those that a segment reaches the best one counts.
            for name, dice in {n: d for n, d in sorted(self.matches(part))}.items():
                best[name] = max(dice, best.get(name, 0.0))
                seen[name] += 1
        for i in likely:
            dice, places = self.runs(i, bigrams, hits[i])
            if places:
                name = self.names[i]
                best[name], amid[name] = max(dice, best.get(name, 0.0)), max(places, amid.get(name, 0))
        return [{"license": n, "dice": best[n], "segments": seen[n] or amid[n]} for n in sorted(best, key=lambda n: (-best[n], n))]


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and ``found``: licences with their best coefficient and number of segments, best first."""
    if sum(len(text.encode()) for _, text in templates) > TEMPLATE_BYTES:
        raise ValueError("the templates are too large to be broadcast")
    docs = pick(docs, "doc_id", "text")
    given = docs.sparkSession.sparkContext.broadcast(list(templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Templates(given.value, threshold)
        for batch in batches:
            found = [own.best(text) if text else [] for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, FOUND)], ["doc_id", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, found array<struct<license: string, dice: double, segments: long>>")


FOUND = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("segments", pa.int64())]))
