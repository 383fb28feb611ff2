"""Licences in texts: Dice coefficient over word bigrams against templates.

Texts are normalised to words of letters and digits, A-Z lowered. Units of a text are its lines
and the whole of it. The Dice coefficient of two bigram sets of sizes a and b is 2 * common /
(a + b); it can only reach `least` if `common` may, so a template of size b is a candidate of a
unit of size a only if 2 * min(a, b) >= least * (a + b). Units without a bigram of any template
are out at once. A unit matches the template of the highest coefficient (ties: the first id in
order), if that is `least` or more.

Notices that are wrapped over lines, or stand within a longer line, are found in windows: runs of
consecutive words over the whole text, across line breaks and comment marks (which are no words),
of at most 1.5 times a template's bigrams. As an optimal window starts and ends with a bigram of its
template, only these are looked at. Of overlapping windows that reach `least` the one with the most
common bigrams counts, then the higher coefficient, the first id, the first place. A window in a
line that matches, or over units that match the same template, is not given again.

The templates' bigrams are broadcast: their number is the templates', not the data's. Null and
empty texts, and units of fewer than two words, match nothing. Repeated rows get equal results.
Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import pieces
from dockflow.llm.textbytes import ALNUM, LOWER_VALUES, U, column_bytes, mix, prefix_hash, span_hash, text_of, word_spans

LEAST = 0.8
#: Notices and short texts as their publishers give them (fixed values); names and years left out.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "all-rights-reserved": "All rights reserved.",
}
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
#: Whole texts of the short licences, and the whole headers of the long ones.
TEMPLATES |= {
    "Apache-2.0-header": TEMPLATES["Apache-2.0-notice"] + " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause-full": _BSD + _BSD_END,
    "BSD-3-Clause-full": _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _BSD_END,
    "GPL-2.0-header": TEMPLATES["GPL-2.0-notice"] + " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "GPL-3.0-header": TEMPLATES["GPL-3.0-notice"] + " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    "ISC-full": TEMPLATES["ISC"] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "MIT-full": TEMPLATES["MIT-text"] + " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}


def bigrams(data: np.ndarray, at: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start byte and text number of every pair of neighbouring words of a text."""
    starts, ends, first = word_spans(data, at, ALNUM)
    words = span_hash(prefix, starts, ends)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(first))
    inside = owner[1:] == owner[:-1]
    return mix(words[:-1] * U(0x9E3779B97F4A7C15) + words[1:])[inside], starts[:-1][inside], owner[:-1][inside]


def compile_templates(templates: dict[str, str]) -> dict:
    ids = sorted(templates)
    data, at = column_bytes(pa.array([templates[k] for k in ids], pa.string()))
    pair, _, owner = bigrams(data, at, prefix_hash(data, LOWER_VALUES))
    sets = [np.unique(pair[owner == k]) for k in range(len(ids))]
    return {"ids": ids, "sets": sets, "any": np.unique(np.concatenate([*sets, np.zeros(0, U)]))}


def _best(unit: np.ndarray, known: dict, least: float) -> tuple[int, float] | None:
    best: tuple[int, float] | None = None
    for k, other in enumerate(known["sets"]):
        both = len(unit) + len(other)
        if both and 2 * min(len(unit), len(other)) >= least * both:
            dice = 2 * len(np.intersect1d(unit, other, assume_unique=True)) / both
            if dice >= least and (best is None or dice > best[1]):
                best = k, dice
    return best


def matches(texts: pa.Array, known: dict, least: float = LEAST) -> list[tuple[int, int, int, int, float]]:
    """(text, unit, start byte, template, Dice) of every matching unit; unit 0 is the whole, then the lines."""
    data, at = column_bytes(texts)
    pair, start, owner = bigrams(data, at, prefix_hash(data, LOWER_VALUES))
    newlines = np.flatnonzero(data == 10)
    line = np.searchsorted(newlines, start)  # words don't hold newlines, but pairs may cross them
    second = np.zeros(0, np.int64)
    if len(pair):
        starts, _, first = word_spans(data, at, ALNUM)
        second = starts[np.searchsorted(starts, start) + 1]
    same = np.searchsorted(newlines, second) == line
    hit = np.searchsorted(known["any"], pair)
    hit = known["any"][np.minimum(hit, max(len(known["any"]) - 1, 0))] == pair if len(known["any"]) else np.zeros(len(pair), bool)
    largest = max((len(s) for s in known["sets"]), default=0) * (2 - least) / least
    out = []
    edges = np.searchsorted(owner, np.arange(len(at)))
    for t in np.unique(owner[hit]):
        a, b = edges[t], edges[t + 1]
        whole = np.unique(pair[a:b])
        if len(whole) <= largest and (m := _best(whole, known, least)):
            out.append((int(t), 0, 0, *m))
        first_line = np.searchsorted(newlines, at[t])
        lines = line[a:b]
        for x in np.unique(lines[hit[a:b] & same[a:b]]):
            i, j = a + np.searchsorted(lines, x), a + np.searchsorted(lines, x, side="right")
            unit = np.unique(pair[i:j][same[i:j]])
            if len(unit) <= largest and (m := _best(unit, known, least)):
                out.append((int(t), int(x - first_line) + 1, int(start[i:j][same[i:j]][0] - at[t]), *m))
    return out


def _windows_of(pair: np.ndarray, size: int, common: np.ndarray, least: float) -> list[tuple[int, float, int, int]]:
    """(common, Dice, first, last bigram) of the best window from each start that has one; `common`
    marks the bigrams of the template, which has `size` different ones."""
    at = np.flatnonzero(common)
    need = least * size / (2 - least)
    reach = int(size * (2 - least) / least)
    # Where each bigram stood before, so that windows count different ones.
    order = np.argsort(pair, kind="stable")
    before = np.full(len(pair), -1)
    again = pair[order][1:] == pair[order][:-1]
    before[order[1:][again]] = order[:-1][again]
    out = []
    for i in at[np.searchsorted(at, at + reach) - np.arange(len(at)) >= need]:
        fresh = before[i : i + reach] < i
        both = np.cumsum(fresh & common[i : i + reach])
        dice = np.where(common[i : i + reach], 2 * both / (np.cumsum(fresh) + size), 0.0)
        j = int(dice.argmax())
        if dice[j] >= least:
            out.append((int(both[j]), float(dice[j]), int(i), int(i) + j))
    return out


def windows(texts: pa.Array, known: dict, least: float = LEAST) -> list[tuple[int, int, int, int, float]]:
    """(text, first line, last line, template, Dice) of notices within texts, lines counted from 1."""
    data, at = column_bytes(texts)
    pair, start, owner = bigrams(data, at, prefix_hash(data, LOWER_VALUES))
    out = []
    if not len(pair) or not len(known["any"]):
        return out
    starts, _, _ = word_spans(data, at, ALNUM)
    second = starts[np.searchsorted(starts, start) + 1]
    newlines = np.flatnonzero(data == 10)
    place = np.minimum(np.searchsorted(known["any"], pair), len(known["any"]) - 1)
    hit = known["any"][place] == pair
    edges = np.searchsorted(owner, np.arange(len(at)))
    for t in np.unique(owner[hit]):
        own = slice(edges[t], edges[t + 1])
        here = np.unique(pair[own][hit[own]])
        found = []
        for k, other in enumerate(known["sets"]):
            if len(other) and len(np.intersect1d(here, other, assume_unique=True)) >= least * len(other) / (2 - least):
                found += [(-c, -d, k, i, j) for c, d, i, j in _windows_of(pair[own], len(other), np.isin(pair[own], other), least)]
        taken = np.zeros(edges[t + 1] - edges[t], dtype=bool)
        first_line = np.searchsorted(newlines, at[t])
        for _, d, k, i, j in sorted(found):
            if not taken[i : j + 1].any():
                taken[i : j + 1] = True
                lines = np.searchsorted(newlines, [start[own][i], second[own][j]]) - first_line + 1
                out.append((int(t), int(lines[0]), int(lines[1]), k, -d))
    return out


def notices(texts: pa.Array, known: dict, least: float = LEAST) -> list[tuple[int, int, int, float]]:
    """(text, unit, template, Dice) of all matches: whole texts (unit 0), lines, and windows by their first line."""
    out = [(t, unit, k, dice) for t, unit, _, k, dice in matches(texts, known, least)]
    by_line = {(t, unit): k for t, unit, k, _ in out}
    same = {(t, k, unit) for t, unit, k, _ in out}
    for t, first, last, k, dice in windows(texts, known, least):
        decided = first == last and (t, first) in by_line
        if not decided and not any((t, k, unit) in same for unit in (0, *range(first, last + 1))):
            out.append((t, first, k, dice))
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, n_matches, license and score of the best match (null without one), and all matches
    as `line:template` in order, line 0 being the whole text; a notice over several lines has its first."""
    shared = docs.sparkSession.sparkContext.broadcast(compile_templates(TEMPLATES if templates is None else templates))

    def read(batches):
        for batch in batches:
            for piece in pieces(batch):
                known, n = shared.value, len(piece)
                found: list[list[tuple]] = [[] for _ in range(n)]
                for t, unit, template, dice in notices(text_of(piece), known, least):
                    found[t].append((unit, known["ids"][template], dice))
                best = [min(((-d, k) for _, k, d in f), default=(None, None)) for f in found]
                yield pa.RecordBatch.from_arrays([
                    text_of(piece, "doc_id"), pa.array([len(f) for f in found], pa.int64()), pa.array([k for _, k in best], pa.string()),
                    pa.array([None if d is None else -d for d, _ in best], pa.float64()), pa.array([",".join(f"{u}:{k}" for u, k, _ in sorted(f)) for f in found], pa.string()),
                ], ["doc_id", "n_matches", "license", "score", "matches"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(read, "doc_id long, n_matches long, license string, score double, matches string")
