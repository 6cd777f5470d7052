"""License scan: winnowed template fingerprints in an inverted index pick candidates, banded alignment decides.

The index (a few thousand fingerprints of the templates below) travels with the task; a text is one linear scan of its
word k-grams against it. Hits of one template on neighbouring diagonals form a candidate region, which is aligned with
the template in a band; the alignment reports how much of the template is covered and where. A map over rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fathomline.llm.wordvec import chunks, column, runs_hash, tokenise

#: Identifiers and notices of public licenses.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "MIT-line": "Released under the MIT License.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution."
    ),
    "BSD-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
        "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
        "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
        "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause-third": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
        "OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire "
        "statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or "
        "derivative works are solely in the form of machine-executable object code generated by a source language processor."
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General "
        "Public License for more details."
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU Affero General Public License for more details."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary.",
}
GRAM, WINNOW, BAND, COVERAGE = 3, 2, 8, 0.8


@dataclass
class Index:
    names: list[str]
    words: list[np.ndarray]  # word hashes of each template
    grams: np.ndarray  # sorted fingerprints
    template: np.ndarray  # and where each comes from
    place: np.ndarray

    def __post_init__(self):
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[(self.grams & np.uint64(0xFFFF)).astype(np.int64)] = True


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Places of the rightmost least of every ``width`` neighbours; all places where there are fewer."""
    if len(grams) <= width:
        return np.arange(len(grams))
    near = np.lib.stride_tricks.sliding_window_view(grams, width)[:, ::-1]
    return np.unique(np.arange(len(near)) + width - 1 - near.argmin(1))


def build_index(templates: dict[str, str], gram: int = GRAM, width: int = WINNOW) -> Index:
    w = tokenise(pa.array(list(templates.values()), pa.string()), lower=True, items=True)
    h = w.hashes()
    words = [h[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    grams, template, place = [], [], []
    for t, x in enumerate(words):
        g = runs_hash(x, gram)
        at = winnow(g, width)
        grams.append(g[at])
        template.append(np.full(len(at), t))
        place.append(at)
    grams, template, place = np.concatenate(grams), np.concatenate(template), np.concatenate(place)
    order = np.lexsort((place, template, grams))
    return Index(list(templates), words, grams[order], template[order], place[order])


def align(template: np.ndarray, text: np.ndarray, shift: int, band: int = BAND) -> tuple[int, int, int]:
    """Most template words matched in order within ``band`` of diagonal ``shift``; first and last text word matched.

    Of equally good alignments the shortest span wins, then the leftmost.
    """
    n = len(text)
    # cell: (matches, -start) reaching text place j; row by row over the template, j in a band around i + shift
    before: dict[int, tuple[int, int, int]] = {}
    best = (0, 0, 0)
    for i, w in enumerate(template.tolist()):
        now: dict[int, tuple[int, int, int]] = {}
        low, high = max(0, i + shift - band), min(n, i + shift + band + 1)
        run = (0, 0, 0)
        for j in range(low, high):
            cell = max(run, before.get(j, (0, 0, 0)))
            if text[j] == w:
                m, s, e = before.get(j - 1, (0, 0, 0))
                start = s if m else -j
                cell = max(cell, (m + 1, start, -(j + 1)))
            now[j] = run = cell
        before = now
        best = max(best, run)
    return best[0], -best[1], -best[2]


def scan(texts: pa.Array, index: Index, coverage: float = COVERAGE, gram: int = GRAM, band: int = BAND) -> list[list[tuple[str, int, int, float]]]:
    """For each text: (template, first byte, one past the last byte, covered share of the template); of overlapping matches
    the one that has as many words and is as well covered."""
    w = tokenise(texts, lower=True, items=True)
    h = w.hashes()
    out: list[list[tuple[str, int, int, float]]] = [[] for _ in range(len(texts))]
    g = runs_hash(h, gram)
    maybe = np.flatnonzero(index.sieve[(g & np.uint64(0xFFFF)).astype(np.int64)])
    low, high = np.searchsorted(index.grams, g[maybe], "left"), np.searchsorted(index.grams, g[maybe], "right")
    maybe, low, high = (x[high > low] for x in (maybe, low, high))
    doc = np.searchsorted(w.first, maybe, "right") - 1
    inside = maybe + gram <= w.first[doc + 1]
    hits: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for p, d, a, b in zip(maybe[inside].tolist(), doc[inside].tolist(), low[inside].tolist(), high[inside].tolist(), strict=True):
        for k in range(a, b):
            hits.setdefault((d, int(index.template[k])), []).append((p - int(index.place[k]), p))
    for (d, t), found in sorted(hits.items()):
        found.sort()
        start, end = int(w.first[d]), int(w.first[d + 1])
        size, done = len(index.words[t]), -1
        near = max(1, min(band, size // 4))  # narrower than the template, so that repeats of a short one stay apart
        k = 0
        while k < len(found):
            shift = found[k][0]
            last = k
            while last + 1 < len(found) and found[last + 1][0] - shift <= near:
                last += 1
            k = last + 1
            at = max(start, shift - near)
            text = h[at : min(end, shift + size + 2 * near)]
            n, a, b = align(index.words[t], text, shift - at, 2 * near)
            if n >= coverage * size and at + a > done:
                done = at + b - 1
                out[d].append((index.names[t], int(w.start[at + a]), int(w.end[at + b - 1]), n / size, n))
    return [_best(x) for x in out]


def _best(found: list[tuple]) -> list[tuple[str, int, int, float]]:
    """Matches in order, without those whose place another one explains better: as much of its template by as many words,
    and more of either. Sister licenses share most of theirs, and some lines begin a longer notice. Matches of one template do not overlap, so few are compared with each other."""
    kept, near, worse = sorted(found, key=lambda m: (m[1], m[0])), [], set()
    better = lambda y, m: y[3] >= m[3] and y[4] >= m[4] and (y[3], y[4]) != (m[3], m[4])
    for k, m in enumerate(kept):
        near = [j for j in near if kept[j][2] > m[1]]
        for j in near:
            if 2 * (min(kept[j][2], m[2]) - m[1]) < min(kept[j][2] - kept[j][1], m[2] - m[1]):
                continue  # they touch: an alignment may reach a word too far
            if better(kept[j], m):
                worse.add(k)
            elif better(m, kept[j]):
                worse.add(j)
        near.append(k)
    return [m[:4] for k, m in enumerate(kept) if k not in worse]


def _scanner(templates: dict[str, str], coverage: float):
    index = build_index(templates)

    def run(batches):
        for batch in chunks(batches):
            texts = column(batch, "text")
            found = scan(texts, index, coverage)
            first = 0
            count, names, spans = [], [], []
            for k, matches in enumerate(found):
                text = (texts[k].as_py() or "").encode()
                # byte places in the chunk become code points in the text
                letters = np.append(0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)) if matches else None
                point = lambda b, letters=letters, first=first: int(letters[b - first])
                count.append(len(matches))
                names.append(",".join(sorted({m[0] for m in matches})))
                spans.append(",".join(f"{n}:{point(a)}:{point(b)}:{c:.4f}" for n, a, b, c in matches))
                first += len(text)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(count, pa.int64()), pa.array(names, pa.string()), pa.array(spans, pa.string())], names=["doc_id", "n_matches", "licenses", "spans"])

    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """Per document: doc_id, n_matches, licenses (distinct, comma-joined), spans (name:start:end:coverage, code points).

    Null, empty and license-free texts have no match and empty strings; matches of one template in a text do not overlap,
    those of different templates may. Repeated rows are each scanned; other columns are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(_scanner(templates or TEMPLATES, coverage), f"doc_id {kind}, n_matches long, licenses string, spans string")
