"""Licence scan: normalised passages against licence templates, by Dice coefficient over word bigrams.

The passages of a text are its lines, its paragraphs (parted by empty lines) and the whole text. Normalising lower-cases,
drops copyright lines and turns everything but letters and digits into blanks. With a passage's distinct bigrams A and a
template's B, Dice is 2 |A & B| / (|A| + |B|); it can reach the threshold t only if t / (2 - t) <= |A| / |B| <= (2 - t) / t,
so most passages are dropped by their length before anything else is done, and templates by size before bigrams are
compared. A passage of one word has that word as its only bigram.

A document's licence is that of its best passage (ties: the licence first by name), null with score 0 if no passage
reaches the threshold, as for null and empty texts.

Windows are all runs of words of the text, over line and paragraph breaks, compared with the templates and with whole
licence texts. The best one of a template starts and ends at bigrams of the template that occur once in it, which leaves
few to be looked at. Of the templates whose best window reaches the threshold, the one that shares most bigrams wins (a
licence that holds another's text before that other one), then the higher score, then the first name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import only, tidy
from millrace.llm.shingles import slices

THRESHOLD = 0.85

# Notices and short texts of public licences.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]

BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
BSD_2 = next(text for name, text in TEMPLATES if name == "BSD-2-Clause")
BSD_3 = BSD_2 + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
MIT_END = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
#: Whole licences, for windows; the long ones lie beside this file.
WHOLE: list[tuple[str, str]] = [
    ("BSD-2-Clause", f"{BSD_2} {BSD_END}"),
    ("BSD-3-Clause", BSD_3),
    ("BSD-3-Clause", f"{BSD_3} {BSD_END}"),
    ("MIT", f"{next(text for name, text in TEMPLATES if name == 'MIT' and len(text) > 100)} {MIT_END}"),
    *((x.stem, x.read_text()) for x in sorted((Path(__file__).parent / "licenses").glob("*.txt"))),
]

COPYRIGHT = re.compile(r"(?im)^\W*(copyright|\(c\)|©)[^\n]*$")
WORDS = re.compile(r"[^\W_]+")


def bigrams(text: str) -> set[tuple[str, ...]]:
    words = WORDS.findall(COPYRIGHT.sub(" ", text).lower())
    return set(zip(words, words[1:])) if len(words) > 1 else {tuple(words)} if words else set()


class Scanner:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> None:
        self.threshold = threshold
        self.templates = sorted(((name, bigrams(text)) for name, text in templates), key=lambda x: x[0])
        ratio = (2 - threshold) / threshold
        self.bounds = [(len(b) / ratio, len(b) * ratio) for _, b in self.templates]
        self.least, self.most = min(a for a, _ in self.bounds), max(b for _, b in self.bounds)
        #: bigrams that a passage shares with some template if it matches at all
        self.known = set().union(*(b for _, b in self.templates))

    def best(self, passage: str) -> tuple[float, str] | None:
        """Score and licence of the passage, if it reaches the threshold."""
        if len(passage) < 2 * self.least:
            return None
        own = bigrams(passage)
        if not self.least <= len(own) <= self.most or own.isdisjoint(self.known):
            return None
        found = None
        for (name, template), (low, high) in zip(self.templates, self.bounds):
            if low <= len(own) <= high:
                score = 2 * len(own & template) / (len(own) + len(template))
                if score >= self.threshold and (found is None or score > found[0]):
                    found = score, name
        return found

    def scan(self, text: str | None) -> tuple[str | None, float, str | None, int]:
        """Licence, score, scope of the best passage, and how many lines match some licence."""
        if not text:
            return None, 0.0, None, 0
        lines = text.split("\n")
        found = [(x, "line") for line in lines if (x := self.best(line))]
        matches = len(found)
        if len(lines) > 1:
            found += [(x, "document")] if (x := self.best(text)) else []
            blocks = re.split(r"\n\s*\n", text)
            if len(blocks) > 1:
                found += [(x, "paragraph") for block in blocks if "\n" in block and (x := self.best(block))]
        if not found:
            return None, 0.0, None, 0
        (score, name), scope = min(found, key=lambda x: (-x[0][0], x[0][1], x[1]))
        return name, score, scope, matches


class Windows:
    """The best run of words of a text for any template."""

    def __init__(self, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> None:
        self.threshold = threshold
        sets = [(name, b) for name, text in sorted(templates or TEMPLATES + WHOLE) if (b := bigrams(text)) and len(next(iter(b))) == 2]
        self.names, self.sizes = [n for n, _ in sets], np.array([len(b) for _, b in sets])
        self.words = {w: k + 1 for k, w in enumerate(sorted({w for _, b in sets for pair in b for w in pair}))}
        code = lambda pair: self.words[pair[0]] * (len(self.words) + 1) + self.words[pair[1]]
        self.codes = np.array(sorted({code(pair) for _, b in sets for pair in b}), np.int64)
        self.has = np.zeros((len(sets), len(self.codes) + 1), bool)  # the last: any other bigram
        for k, (_, b) in enumerate(sets):
            self.has[k, np.searchsorted(self.codes, [code(pair) for pair in b])] = True
        # a window that reaches the threshold shares at least so many bigrams and has at most so many
        self.need = np.ceil(self.sizes * threshold / (2 - threshold) - 1e-9).astype(int)
        self.most = self.sizes * (2 - threshold) / threshold

    def best(self, text: str | None) -> tuple[str | None, float]:
        """Licence and score, null and 0 if no window reaches the threshold."""
        words = WORDS.findall(COPYRIGHT.sub(" ", text).lower()) if text else []
        if len(words) < 2:
            return None, 0.0
        ids = np.fromiter(map(self.words.get, words, repeat(0)), np.int64, len(words))
        pairs = np.where((ids[:-1] > 0) & (ids[1:] > 0), ids[:-1] * (len(self.words) + 1) + ids[1:], -1)
        places = np.minimum(np.searchsorted(self.codes, pairs), len(self.codes) - 1)
        known = np.where(self.codes[places] == pairs, places, len(self.codes))
        there = np.zeros(len(self.codes) + 1, bool)
        there[known] = True
        able = np.flatnonzero(self.has[:, there].sum(axis=1) >= self.need)
        if not len(able):
            return None, 0.0
        own: dict[str, int] = {}
        numbers = np.fromiter((own.setdefault(w, len(own)) for w in words), np.int64, len(words))
        same = np.unique(numbers[:-1] * len(own) + numbers[1:], return_inverse=True)[1]
        order = np.argsort(same, kind="stable")
        again = same[order[1:]] == same[order[:-1]]
        before, after = np.full(len(same), -1), np.full(len(same), len(same))
        before[order[1:][again]] = order[:-1][again]
        after[order[:-1][again]] = order[1:][again]
        found = [(-shared, -score, self.names[t]) for t in able.tolist() for score, shared in [self.window(t, known, same, before, after)] if score >= self.threshold]
        return (min(found)[2], -min(found)[1]) if found else (None, 0.0)

    def window(self, t: int, known: np.ndarray, same: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[float, int]:
        """Score of a template's best window, and how many bigrams they share."""
        member = self.has[t, known]
        sums = np.concatenate([[0], np.cumsum(member)])
        starts = np.flatnonzero(member)
        starts = starts[sums[after[starts]] - sums[starts] >= self.need[t]]
        best, seen = (0.0, 0), set()
        for s in starts.tolist():
            width = 2 * int(self.sizes[t]) + 2
            while True:  # a window in which the first bigram comes again is no better without its first
                end = min(int(after[s]), s + width)
                fresh = before[s:end] < s
                size = np.cumsum(fresh)
                if size[-1] > self.most[t] or end == after[s]:
                    break
                width *= 2
            if (key := same[s:end].tobytes()) in seen:
                continue
            seen.add(key)
            shared = np.cumsum(fresh & member[s:end])
            score = 2 * shared / (size + self.sizes[t])
            k = int(score.argmax())
            best = max(best, (float(score[k]), int(shared[k])))
            if best[0] == 1.0:
                break
        return best


def scanned(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, score, scope and n_lines of each document, and licence and score of its best window, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, wide = Scanner(threshold=threshold), Windows(threshold=threshold)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [(*own.scan(t), *wide.best(t)) for t in part.column("text").to_pylist()]
                name, score, scope, lines, window, high = zip(*rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(scope, pa.string()), pa.array(lines, pa.int64()), pa.array(window, pa.string()), pa.array(high, pa.float64())], ["doc_id", "license", "score", "scope", "n_lines", "window_license", "window_score"])

    return only(documents, "doc_id", "text").mapInArrow(tidy(run), "doc_id long, license string, score double, scope string, n_lines long, window_license string, window_score double")
