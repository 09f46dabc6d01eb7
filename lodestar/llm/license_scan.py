"""License scans by patience alignment.

A license template is looked for around seeds. With a coverage of at least
0.8 asked for, a fifth of a template's words may be missing, so a match holds
at least one of any fifth-and-one-more of its words; the longest words of the
template serve as these seeds, which loses nothing. Around each seed
occurrence a window of the template's length (and some slack) is aligned.
Where that gives no match, or one without a run of words at the template's
beginning or end, a wide window is aligned, too, which holds the template with
as many inserted words as it has itself, wherever they stand (``SPREAD``).
Windows that hold too few of the template's words, counted with repeats while
they slide along the text, are left out:

* words that occur once in the window and once in the template are anchors;
* the longest increasing subsequence of the anchors' places is kept;
* the gaps between them are aligned the same way; a gap without anchors
  matches its common beginning and end.

The share of template words that are matched is the coverage. Of overlapping
matches the one with the most matched words (then the best coverage, then the
shorter, then the earlier) stays, so a notice is not lost to a short line that
it begins with. The other one is aligned anew in the words left free; failing
that, the first one gives up its words in the other's span if both then cover
enough and match more words together than the first did alone.

Spark's scan drops texts without any seed before Python sees them; the others
come whole, in Arrow batches.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COVERAGE = 0.8
SLACK = 0.25   # of a template's words, on both sides of the window around a seed
SPREAD = 1.0   # inserted words that a match may hold, as a share of its template's words
EDGE = 1       # words that a match may lack at its template's beginning or end before a wide window is tried
_WORD = re.compile(r"[^\W_]+")

# Public license notices, as their licenses word them.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "Apache-2.0 (short)": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
    "CC-BY-4.0 (short)": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 (short)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 (short)": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."),
    "GPL-3.0 (short)": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION "
        "WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "MIT (with warranty)": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "MIT (short)": "Released under the MIT License.",
}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(places: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(places)
    for i, p in enumerate(places):
        k = bisect_left(tops, p)
        if k == len(tops):
            tops.append(p)
            piles.append(i)
        else:
            tops[k], piles[k] = p, i
        back[i] = piles[k - 1] if k else -1
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(template: list[str], text: list[str]) -> list[tuple[int, int]]:
    """Matched (template place, text place) pairs, increasing in both."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(template), 0, len(text))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and template[a] == text[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        in_template, in_text = Counter(template[a:b]), Counter(text[c:d])
        place = {w: i for i, w in enumerate(text[c:d], c) if in_text[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(template[a:b], a) if in_template[w] == 1 and w in place]
        kept = [anchors[k] for k in _increasing([y for _, y in anchors])]
        if not kept:
            continue
        pairs += kept
        edges = [(a - 1, c - 1), *kept, (b, d)]
        todo += [(x + 1, x2, y + 1, y2) for (x, y), (x2, y2) in zip(edges, edges[1:])]
    return sorted(pairs)


class Scanner:
    """Finds templates in texts."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE, spread: float = SPREAD):
        self.coverage, self.spread = coverage, spread
        self.templates = {k: w for k, v in sorted(templates.items()) if (w := words_of(v))}
        self.seeds: dict[str, list[tuple[str, int]]] = {}
        for name, words in self.templates.items():
            spare = int((1 - coverage) * len(words) + 1e-9)  # words that a match may lack
            places = sorted(range(len(words)), key=lambda i: (-len(words[i]), i))[:spare + 1]
            for i in places:
                self.seeds.setdefault(words[i], []).append((name, i))

    def pattern(self) -> str:
        """Regular expression (over lower-case text) that every matching text satisfies."""
        return "|".join(sorted(map(re.escape, self.seeds)))

    def _within(self, name: str, words: list[str], lo: int, hi: int) -> tuple[int, int, str, float, int] | None:
        """(first word, word after the last, template, coverage, matched words) in words[lo:hi], if covered enough."""
        template = self.templates[name]
        if (hi - lo) / len(template) < self.coverage:
            return None
        pairs = align(template, words[lo:hi])
        share = len(pairs) / len(template)
        return (lo + pairs[0][1], lo + pairs[-1][1] + 1, name, share, len(pairs)) if share >= self.coverage else None

    def _windows(self, name: str, spans: list[tuple[int, int]], words: list[str]) -> Iterator[tuple[int, int]]:
        """Of ascending spans of words, those that hold enough of the template's words."""
        n, wanted = len(self.templates[name]), Counter(self.templates[name])
        held, common, left, right = Counter(), 0, 0, 0
        for lo, hi in spans:
            lo, hi = max(0, lo), min(len(words), hi)
            if lo >= right:
                held, common, left, right = Counter(), 0, lo, lo
            for word in words[right:hi]:
                held[word] += 1
                common += held[word] <= wanted[word]
            for word in words[left:lo]:
                common -= held[word] <= wanted[word]
                held[word] -= 1
            left, right = lo, hi
            if common >= self.coverage * n - 1e-9:
                yield lo, hi

    def _found(self, name: str, begins: list[int], words: list[str]) -> Iterator[tuple[int, int, str, float, int]]:
        """Matches of a template, from the places where its seeds say that it may begin."""
        n = len(self.templates[name])
        slack, whole = int(SLACK * n) + 1, []
        for lo, hi in self._windows(name, [(b - slack, b + n + slack) for b in begins], words):
            if m := self._within(name, words, lo, hi):
                yield m
                pairs = align(self.templates[name], words[m[0]:m[1]])
                if pairs[0][0] <= EDGE and pairs[-1][0] >= n - 1 - EDGE:
                    whole.append(m[0])
        # wide windows at steps, each for all the places in its step, so that their number is bounded by the text
        step, wide = max(1, n // 4), int(self.spread * n) + 1
        spans = [(b - wide, b + step + n + wide) for b in sorted({b // step * step for b in begins})]
        for lo, hi in self._windows(name, spans, words):
            k = bisect_left(whole, lo)
            if (k == len(whole) or whole[k] >= hi) and (m := self._within(name, words, lo, hi)):
                yield m

    def matches(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """(template, coverage, matched words, first word, word after the last), by place."""
        words = words_of(text)
        found: set[tuple[int, int, str, float, int]] = set()
        begins: dict[str, set[int]] = {}
        for at, word in enumerate(words):
            for name, i in self.seeds.get(word, ()):
                begins.setdefault(name, set()).add(at - i)
        for name, places in begins.items():
            found.update(self._found(name, sorted(places), words))

        def ranked(m: tuple[int, int, str, float, int]) -> tuple:
            lo, hi, name, share, n = m
            return -n, -share, hi - lo, lo, name, m

        todo = sorted(map(ranked, found))
        chosen: list[tuple[int, int, str, float, int]] = []  # by place, no two overlap
        while todo:
            m = heappop(todo)[-1]
            lo, hi, name, _, n = m
            first, last = bisect_left(chosen, (lo,)), bisect_left(chosen, (hi,))
            first -= first > 0 and chosen[first - 1][1] > lo
            over, cut = chosen[first:last], []
            if over:
                free = zip([lo, *(c[1] for c in over)], [*(c[0] for c in over), hi])
                again = [x for a, b in free if (x := self._within(name, words, a, b))]
                for x in again:
                    heappush(todo, ranked(x))
                if again:
                    continue
                for c in over:
                    sides = [x for a, b in ((c[0], lo), (hi, c[1])) if (x := self._within(c[2], words, a, b))]
                    cut += sorted(sides, key=ranked)[:1]
                if len(cut) < len(over) or sum(c[4] for c in cut) + n <= sum(c[4] for c in over):
                    continue
            chosen[first:last] = sorted([*cut, m])
        return [(name, share, n, lo, hi) for lo, hi, name, share, n in chosen]


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per match: doc_id, license, coverage, matched_words, first_word, end_word.

    Words are runs of letters and digits in lower case, numbered over the
    whole text. Null and empty texts match nothing; rows without doc_id and
    repeated rows report their own matches; no rows, or no template words,
    give no rows; other columns are ignored.
    """
    scanner = Scanner(TEMPLATES if templates is None else templates, coverage)

    @F.pandas_udf("array<struct<license string, coverage double, matched_words int, first_word int, end_word int>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[dict(zip(("license", "coverage", "matched_words", "first_word", "end_word"), m))
                              for m in scanner.matches(t)] if isinstance(t, str) else [] for t in batch], dtype=object)

    hit = F.lower(F.col(text)).rlike(scanner.pattern()) if scanner.seeds else F.lit(False)
    return (docs.where(hit).select(F.col(doc_id).alias("doc_id"), F.explode(find(F.col(text))).alias("m"))
            .select("doc_id", "m.*"))
