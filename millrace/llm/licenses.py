"""License scans by patience alignment of texts with license templates.

Words that occur once in the text's window and once in the template are anchors; the longest
increasing subsequence of their places is kept, and the gaps between are aligned in the same way.
Where a gap has no such word, its common beginning and end are matched. Coverage is the share of the
template's words that are matched, in order.

Whole texts are searched: a match of coverage c must hold one word at least of any set of template
words that outweighs 1 - c of the template. The rarest-looking such words are looked up in the text,
and each place where one stands gives a window to align; there is no limit on their number.

A match lies in a window of the template's length and a quarter of it on both sides. Null and empty
texts have none, and repeated rows each have theirs. One row a match; matches of one template do not
overlap, the leftmost first, while those of different templates may, so that a whole license shows
its grant too; equal places go by the template's name. Long texts are searched whole. An empty table
gives an empty one.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import need

#: Least share of a template's words that a match has.
COVERAGE = 0.8

_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."


def _gnu(name: str, version: str) -> str:
    """The notice that the GNU licenses ask to put into files."""
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
        f"This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
    )


#: Short notices, grants, and whole texts of common public licenses (those that fit a page).
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "mit": _MIT_GRANT,
    "isc": _ISC_GRANT,
    "bsd": _BSD_GRANT,
    "mit-whole": _MIT_GRANT + " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-whole": _ISC_GRANT + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "bsd-2-clause": f"{_BSD_GRANT} {_DISCLAIMER}",
    "bsd-3-clause": f"{_BSD_GRANT} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_DISCLAIMER}",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. "
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
    "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "cc0-notice": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "lgpl-3.0": _gnu("Lesser General Public License", "3"),
    "agpl-3.0": _gnu("Affero General Public License", "3"),
    "gpl-2.0": _gnu("General Public License", "2"),
    "gpl-3.0-file-notice": _gnu("General Public License", "3"),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
}

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Lower-cased words and their places."""
    found = [m.span() for m in _WORD.finditer(text)]
    return [text[a:b].lower() for a, b in found], found


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience piles with back pointers)."""
    tops: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k:
            before[i] = at[k - 1]
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k], at[k] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        count: dict[str, list[int]] = {}
        for j in range(b0, b1):
            count.setdefault(b[j], [0, 0, 0, j])[1] += 1
        for i in range(a0, a1):
            if (c := count.get(a[i])) is not None:
                c[0] += 1
                c[2] = i
        anchors = sorted((c[2], c[3]) for c in count.values() if c[0] == 1 and c[1] == 1)
        kept = [anchors[i] for i in increasing([y for _, y in anchors])]
        if not kept:
            continue
        x0, y0 = a0, b0
        for x, y in kept:
            out.append((x, y))
            todo.append((x0, x, y0, y))
            x0, y0 = x + 1, y + 1
        todo.append((x0, a1, y0, b1))
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str, coverage: float):
        self.name, self.coverage = name, coverage
        self.words = words_of(text)[0]
        # The longest words first: those that look rarest. Together they outweigh what a match may miss.
        times: dict[str, int] = {}
        for w in self.words:
            times[w] = times.get(w, 0) + 1
        self.keys: dict[str, int] = {}
        left = len(self.words) - self.least
        for w in sorted(times, key=lambda w: (-len(w), w)):
            if left < 0:
                break
            self.keys[w] = self.words.index(w)
            left -= times[w]

    @property
    def least(self) -> int:
        """Matched words that a match has at least."""
        n = len(self.words)
        return next(k for k in range(n + 1) if k >= self.coverage * n)

    def matches(self, words: list[str]):
        """(matched, first word, last word) of each match, from left to right."""
        size, done = len(self.words), 0
        slack = max(3, size // 4)
        for p, w in enumerate(words):
            q = self.keys.get(w)
            if q is None or p < done:
                continue
            a0 = max(done, p - q - slack - (size if self.words.count(w) > 1 else 0))
            window = words[a0 : p - q + size + slack + (size if self.words.count(w) > 1 else 0)]
            found = align(window, self.words)
            if len(found) >= self.least:
                first, last = a0 + found[0][0], a0 + found[-1][0]
                yield len(found), first, last
                done = last + 1


def scanner(templates: dict[str, str], coverage: float):
    held = [Template(k, v, coverage) for k, v in templates.items()]
    every = sorted({w for t in held for w in t.keys})

    def scan(text: str | None) -> list[tuple[str, float, int, int, int]]:
        """(template, coverage, start, end, matched words) of each match; places in characters."""
        if not text:
            return []
        low = text.lower()
        if not any(k in low for k in every):
            return []
        words, at = words_of(text)
        have = set(words)
        out = []
        for t in held:
            if any(k in have for k in t.keys) and sum(w in have for w in t.words) >= t.least:
                out += [(t.name, n / len(t.words), at[i][0], at[j][1], n) for n, i, j in t.matches(words)]
        return sorted(out, key=lambda m: (m[2], m[3], m[0]))

    return scan


_KIND = "license string, coverage double, start long, end long, matched long"


def _run(templates: dict[str, str], coverage: float):
    def run(batches):
        scan = scanner(templates, coverage)
        for batch in batches:
            ids, rows = [], []
            names = batch.schema.names[:-1]
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                own = scan(text)
                ids += [i] * len(own)
                rows += own
            given = [c.take(pa.array(ids, pa.int64())) for c in batch.columns[:-1]]
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([*given, *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))], names=[*names, "license", "coverage", "start", "end", "matched"])

    return run


def matches(docs: DataFrame, keep: list[str], templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row a match of docs(text, ...): the columns `keep`, license, coverage, start, end (characters, end exclusive), matched."""
    rows = need(docs, *keep, "text")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_run(templates or TEMPLATES, coverage), f"{kind}, {_KIND}")
