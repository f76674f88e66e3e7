"""Licence scans: normalised text against licence templates by Dice coefficient.

Lines, paragraphs and whole texts are normalised to words and compared with
each template as multisets of word bigrams: Dice = 2 |A and B| / (|A| + |B|).
A coefficient of t or more needs |A| between |B| t / (2 - t) and
|B| (2 - t) / t, so the templates, sorted by size, are pruned to those bounds
before anything is compared.

Words that no unit of a licence covers are searched for that licence's
templates by sliding windows, which cross lines and paragraphs: a notice inside
a line, wrapped within a larger paragraph, or of several paragraphs in a longer
text is a window. The best window begins and ends with a bigram of the
template, so only such positions are tried, and only where the longest window
holds enough of the template.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed
to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GPL_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR
A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License
along with this program. If not, see <https://www.gnu.org/licenses/>."""
_MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""

# Published licence texts and the usual one-line notices.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE_NOTICE),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _GPL_NOTICE),
    ("ISC", _ISC_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT_GRANT),
    ("MPL-2.0", _MPL_NOTICE),
    ("all-rights-reserved", "All rights reserved."),
]

_WORD = re.compile(r"[^\W_]+")
_RIGHTS_LINE = re.compile(r"^\s*(?:copyright|©|\(c\))[^\n]*\n", re.I | re.M)


@dataclass(frozen=True)
class Params:
    threshold: float = 0.8


def words(text: str) -> list[str]:
    """Lower-cased words; British spelling as American."""
    return [{"licence": "license", "licenced": "licensed"}.get(w, w) for w in _WORD.findall(text.lower())]


def bigrams(w: list[str]) -> Counter:
    return Counter(zip(w, w[1:]))


class Matcher:
    """Templates sorted by size, with the size bounds of a threshold."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        parts = [(name, bigrams(words(text))) for name, text in templates]
        parts = sorted(((sum(b.values()), name, b) for name, b in parts if b), key=lambda x: x[:2])
        self.sizes, self.names, self.grams = [p[0] for p in parts], [p[1] for p in parts], [p[2] for p in parts]
        self.threshold = threshold
        self.low, self.high = threshold / (2 - threshold), (2 - threshold) / threshold
        # No unit outside these sizes can match anything.
        self.least = int(self.sizes[0] * self.low) if parts else 1
        self.most = int(self.sizes[-1] * self.high) + 1 if parts else 0
        self.heads: dict[tuple, list[int]] = {}
        for i, b in enumerate(self.grams):
            for g in b:
                self.heads.setdefault(g, []).append(i)

    def match(self, w: list[str]):
        """(template name, coefficient) of every template that the words reach."""
        n = len(w) - 1
        if n < max(1, self.least) or n > self.most:
            return
        pairs = list(zip(w, w[1:]))
        if self.heads.keys().isdisjoint(pairs):
            return
        mine = None
        first, last = bisect_left(self.sizes, n * self.low - 1e-9), bisect_right(self.sizes, n * self.high + 1e-9)
        for i in range(first, last):
            if mine is None:
                mine = Counter(pairs)
            a, b = (mine, self.grams[i]) if len(mine) < len(self.grams[i]) else (self.grams[i], mine)
            dice = 2 * sum(min(c, b[g]) for g, c in a.items() if g in b) / (n + self.sizes[i])
            if dice >= self.threshold:
                yield self.names[i], dice


    def windows(self, w: list[str], matches: dict[str, list[tuple[int, int, float]]]):
        """(template name, coefficient) of windows of the words that reach a
        template, the best first. ``matches`` has what is found so far: first
        word, word after the last and coefficient, per licence. Windows hold no
        word of a match of their licence, and half of the bigrams that they
        share with the template at least are not owed to a match of another
        licence with as large a coefficient. Windows become matches."""
        at: dict[int, list[int]] = {}
        for p, g in enumerate(zip(w, w[1:])):
            if g in self.heads:
                for i in self.heads[g]:
                    at.setdefault(i, []).append(p)
        at = {i: ps for i, ps in at.items() if len(ps) >= self.sizes[i] * self.low - 1e-9}
        owed: dict[int, list[tuple[int, int]]] = {i: [] for i in at}
        while True:
            # What lost to a window that lost itself is found by the next turn.
            found = sorted((-dice, a - b, a, i) for i, ps in at.items()
                           for part in _outside(ps, [m[:2] for m in matches.get(self.names[i], ())] + owed[i]) for dice, a, b in self._slide(w, part, i))
            if not found:
                return
            new: dict[str, list[tuple[int, int]]] = {}
            for dice, size, a, i in found:
                name, dice, b = self.names[i], -dice, a - size
                mine = new.setdefault(name, [])
                k = bisect_left(mine, (a, b))
                if (k and mine[k - 1][1] > a) or (k < len(mine) and b > mine[k][0]):
                    continue
                if others := self._owed(w, a, b, dice, i, matches):
                    owed[i] += others
                    continue
                mine.insert(k, (a, b))
                matches.setdefault(name, []).append((a, b, dice))
                yield name, dice

    def _owed(self, w: list[str], a: int, b: int, dice: float, i: int, matches: dict) -> list[tuple[int, int]]:
        """The parts of a window that matches of other licences explain, if they explain half of it."""
        shared = {p for p in range(a, b - 1) if (w[p], w[p + 1]) in self.grams[i]}
        left, parts = set(shared), []
        for name, ms in matches.items():
            if name != self.names[i]:
                for first, last, d in ms:
                    if d >= dice and first < b and a < last:
                        own = {p for p in left if first <= p < last - 1 and any(self.names[k] == name for k in self.heads[w[p], w[p + 1]])}
                        if own:
                            parts.append((max(a, first), min(b, last)))
                            left -= own
        return parts if 2 * len(left) <= len(shared) else []

    def _slide(self, w: list[str], ps: list[int], i: int):
        """(coefficient, first word, word after the last) of the best window from
        each of the positions of a template's bigrams, where it reaches the
        threshold and the positions' last window does not overlap it with as
        much as this one can have."""
        size, grams = self.sizes[i], self.grams[i]
        reach = int(size * self.high + 1e-9)
        held, common, end = Counter(), 0, 0  # of the longest window from a position
        top, until = 0.0, 0
        for k, p in enumerate(ps):
            while end < len(ps) and ps[end] - p < reach:
                g = w[ps[end]], w[ps[end] + 1]
                held[g] += 1
                common += held[g] <= grams[g]
                end += 1
            most = 2 * common / (common + size)
            if most >= self.threshold and (p >= until or most > top):
                mine, both, best, stop = Counter(), 0, 0.0, 0
                for q in ps[k:end]:
                    g = w[q], w[q + 1]
                    mine[g] += 1
                    if mine[g] <= grams[g]:
                        both += 1
                        dice = 2 * both / (q - p + 1 + size)
                        if dice > best:
                            best, stop = dice, q + 2
                if best >= self.threshold:
                    yield best, p, stop
                    if p >= until or best > top:
                        top, until = best, stop
            g = w[p], w[p + 1]
            common -= held[g] <= grams[g]
            held[g] -= 1


def _outside(ps: list[int], ranges: list[tuple[int, int]]):
    """The positions of bigrams without a word of the ranges, cut at each range."""
    start = 0
    for a, b in sorted(ranges):
        yield ps[start:max(start, bisect_left(ps, a - 1))]
        start = max(start, bisect_left(ps, b))
    yield ps[start:]


def units(text: str):
    """(kind, index of the first word, words) of the lines, the paragraphs of
    several lines, and the whole text of several lines."""
    lines, n = text.split("\n"), 0
    for line in lines:
        yield "line", n, (w := words(line))
        n += len(w)
    if len(lines) > 1:
        n = 0
        for paragraph in (paragraphs := re.split(r"\n[^\S\n]*\n", text)):
            if len(paragraphs) > 1:
                w = words(paragraph)
                if "\n" in paragraph.strip("\n"):
                    yield "paragraph", n, w
                n += len(w)
        yield "text", 0, words(_RIGHTS_LINE.sub("", text))


def scan_text(text: str | None, matcher: Matcher) -> list[dict]:
    """Per licence found: best coefficient, the kind of unit that has it, units matched."""
    best: dict[str, list] = {}
    whole: list[str] = []
    matches: dict[str, list[tuple[int, int, float]]] = {}

    def add(name: str, dice: float, kind: str) -> None:
        got = best.setdefault(name, [0.0, kind, 0])
        got[2] += 1
        if dice > got[0]:
            got[0], got[1] = dice, kind

    for kind, first, w in units(text) if text else ():
        if kind == "line":
            whole += w
        for name, dice in matcher.match(w):
            add(name, dice, kind)
            matches.setdefault(name, []).append((0, len(whole), dice) if kind == "text" else (first, first + len(w), dice))
    for name, dice in matcher.windows(whole, matches):
        add(name, dice, "window")
    return [{"license": name, "dice": d, "unit": kind, "units": n} for name, (d, kind, n) in sorted(best.items())]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
         params: Params = Params()) -> DataFrame:
    """Rows (id, license, dice, unit, units): one per document and licence with
    a unit or window of at least ``threshold``.

    Null, empty and licence-free texts have no row. Of units that reach the same
    coefficient the first counts (lines, then paragraphs, then the text, then
    windows). A window holds no word of a unit that has its licence, and is
    none if a match of another licence explains half of what it shares.
    Repeated rows and null ids are judged like any other; an empty table gives
    none. Templates travel with the task, so they are a short list (4 MB of
    text at most); templates of one word match nothing."""
    if sum(len(t) for _, t in templates) > 4 << 20:
        raise ValueError("more than 4 MB of templates")

    @F.pandas_udf("array<struct<license:string,dice:double,unit:string,units:int>>")
    def run(texts: pd.Series) -> pd.Series:
        matcher = Matcher(templates, params.threshold)
        return texts.map(lambda t: scan_text(t, matcher))

    found = df.select(F.col(id_col).alias("id"), run(F.coalesce(F.col(text_col), F.lit(""))).alias("m"))
    return found.select("id", F.explode("m").alias("m")).select("id", "m.*")
