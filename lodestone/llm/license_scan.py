"""License scans by patience alignment.

A template counts as found where at least ``COVERAGE`` of its words stand in a text in the template's order. A text that
covers it that far must hold one of its few least usual words (one more than may be missing), so only stretches around
these are aligned: words that occur once in the stretch and once in the template are anchors, the longest increasing
subsequence of anchors is kept, and the gaps between them are aligned in the same way. Notices that follow one another
closely are told apart by where their seeds say that they begin.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words as W

COVERAGE = 0.8

# Notices as their licenses or authors word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-2.1": "Licensed under the GNU Lesser General Public License, version 2.1",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "BSD": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "reserved": "All rights reserved",
    "MIT-body": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        'of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
        "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "BSD-3-Clause-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ),
    "BSD-disclaimer": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
        "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
        "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "ISC-body": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        'above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."
    ),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
        "implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
        "FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "Zlib-body": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be "
        "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
    ),
    "Unlicense-body": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
}
# Words of notices that are usual elsewhere, and so tried last as seeds.
USUAL = frozenset("a all any be by can form found free in is of person terms that the this to under use work".split())

_PARTS = np.ones(256, dtype=bool)
_PARTS[48:58] = _PARTS[65:91] = _PARTS[97:123] = _PARTS[128:] = False


def words_of(text: str) -> np.ndarray:
    return W.split(pa.array([text]), _PARTS).hashes()


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        tails[k : k + 1] = [v]
        at[k : k + 1] = [i]
        before[i] = at[k - 1] if k else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched places of two word lists, in order."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {x: i for i, x in enumerate(b[b0:b1], b0) if once_b[x] == 1}
        pairs = [(i, where[x]) for i, x in enumerate(a[a0:a1], a0) if once_a[x] == 1 and x in where]
        chain = [pairs[i] for i in increasing([y for _, y in pairs])]
        if not chain:
            continue
        out += chain
        edges = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
        todo += [(x + 1, p, y + 1, q) for (x, y), (p, q) in zip(edges[:-1], edges[1:], strict=True) if p > x + 1 and q > y + 1]
    return sorted(out)


class Templates:
    def __init__(self, templates: dict[str, str], coverage: float) -> None:
        self.names, self.coverage = list(templates), coverage
        self.words = [words_of(t).tolist() for t in templates.values()]
        self.counts = [Counter(w) for w in self.words]
        self.kinds = [np.unique(words_of(t)) for t in templates.values()]
        seeds: dict[int, list[tuple[int, int]]] = {}
        for k, text in enumerate(templates.values()):
            spoken = text.lower().translate({c: " " for c in range(128) if not chr(c).isalnum()}).split()
            unusual = sorted(range(len(spoken)), key=lambda i: (spoken[i] in USUAL, spoken[i].isdigit(), -len(spoken[i]), i))
            for i in unusual[: int((1 - coverage) * len(spoken) + 1e-9) + 1]:
                same = [j for j, x in enumerate(self.words[k]) if x == self.words[k][i]]
                seeds.setdefault(self.words[k][i], []).extend((k, j) for j in same)
        self.seeds = seeds
        self.sorted = np.array(sorted(seeds), dtype=np.uint64)

    def stretches(self, s: int, length: int, end: int, after: int, behind: int) -> list[tuple[int, int]]:
        """Stretches of a text of ``end`` words that may hold a template of ``length`` words that begins at ``s``.

        The bare one first, then with slack on both sides, but cut where a neighbour begins (``after``) and where the last
        match ended (``behind``): with a neighbour's words in it, no word is there once. Last the uncut one.
        """
        slack = 2 + length // 4
        lo, hi = max(s - slack, 0), min(s + length + slack, end)
        some = [(max(s, 0), min(s + length, end)), (max(lo, behind), min(hi, after)), (lo, hi)]
        return [x for x in dict.fromkeys(some) if x[0] < x[1]]

    def found(self, text: np.ndarray, hits: list[int]) -> list[tuple[int, int, int, float]]:
        """(first word, word after, template, coverage) of the best matches that do not overlap. ``hits``: places of seeds."""
        regions: dict[int, set[int]] = {}
        for at in hits:
            for k, j in self.seeds[int(text[at])]:
                regions.setdefault(k, set()).add(at - j)
        some = []
        for k, begins in regions.items():
            words, starts = self.words[k], sorted(begins)
            need, slack = self.coverage * len(words) - 1e-9, 2 + len(words) // 4
            mine = np.append(0, np.cumsum(np.isin(text, self.kinds[k])))  # words of the template so far
            behind, whole = 0, None
            for i, s in enumerate(starts):
                if whole is not None and s < whole + len(words) - slack:
                    continue  # it would overlap a match that has every word
                nearest = max(len(words) - slack, len(words) // 2 + 1)
                j = bisect_left(starts, s + nearest, i)
                after = starts[j] if j < len(starts) else len(text)
                for lo, hi in self.stretches(s, len(words), len(text), after, behind):
                    if mine[hi] - mine[lo] < need:
                        continue
                    stretch = text[lo:hi].tolist()
                    if sum(self.counts[k][x] for x in self.counts[k].keys() & set(stretch)) < need:
                        continue
                    pairs = patience(stretch, words)
                    if pairs and len(pairs) >= need:
                        first, last = lo + pairs[0][0], lo + pairs[-1][0] + 1
                        some.append((-len(pairs), -len(pairs) / len(words), first, last, k))
                        behind = max(behind, last)
                        if len(pairs) == len(words) == last - first:
                            whole = first
                            break
        out: list[tuple[int, int, int, float]] = []
        taken: list[int] = []  # starts and ends, in turn and ascending: nothing overlaps
        for _, share, a, b, k in sorted(set(some)):
            at = bisect_right(taken, a)
            if at % 2 == 0 and (at == len(taken) or b <= taken[at]):
                taken[at:at] = [a, b]
                out.append((a, b, k, -share))
        return sorted(out)


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, license, start, end, coverage`` for every notice found in ``docs`` (``doc_id, text``), in code points.

    Where matches overlap the one that matches most words stays, the one that covers more of its template of equals. Documents without
    a notice, null texts and empty tables give no rows; repeated rows give theirs each; other columns are not read. Whole
    texts are scanned, in place.
    """
    known = Templates(TEMPLATES if templates is None else templates, coverage)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in W.chunks(texts):
                w = W.split(texts.slice(a, b - a), _PARTS)
                h = w.hashes()
                if not len(h) or not len(known.sorted):
                    continue
                place = np.minimum(np.searchsorted(known.sorted, h), len(known.sorted) - 1)
                hits = np.flatnonzero(known.sorted[place] == h)
                rows = []
                for t in np.unique(w.text[hits]).tolist():
                    lo, hi = int(w.first[t]), int(w.first[t + 1])
                    mine = hits[np.searchsorted(hits, lo) : np.searchsorted(hits, hi)] - lo
                    body = w.data[w.offsets[t] : w.offsets[t + 1]].tobytes()
                    for x, y, k, share in known.found(h[lo:hi], mine.tolist()):
                        first, last = (int(p - w.offsets[t]) for p in (w.start[lo + x], w.end[lo + y - 1]))
                        head = len(body[:first].decode())
                        rows.append((a + t, known.names[k], head, head + len(body[first:last].decode()), share))
                if rows:
                    index, name, start, end, share = (list(c) for c in zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(index)), pa.array(name), pa.array(start), pa.array(end), pa.array(share)],
                        ["doc_id", "license", "start", "end", "coverage"],
                    )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, license string, start bigint, end bigint, coverage double")
