"""License scans by patience alignment.

Every template has cues: so many of its rarest words that a text without any of them could not reach COVERAGE. A text
that has a cue (found without Python) is cut to a region round each cue, which reaches as far as a statement with NEAR
words put in would, and then as one with REACH words more, or as many as the template has. In the region the template is aligned: words that occur once in the
region and once in the template are anchors, the longest increasing subsequence of their places is kept, and the gaps
between anchors are aligned the same way, down to gaps without anchors, where equal ends are matched. The share of the
template's words that are aligned is its coverage; COVERAGE or more counts, if a word is among them that no other
license's templates have (where the template has such a word), and each number of the template, which tells versions apart.

Of statements that overlap the one with most words aligned stays; ties go to the higher coverage, then the earlier, the
shorter, the lesser name. Null texts count as empty. Repeated rows are scanned each; an empty table gives no rows; other columns are not
read. Texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import cache
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardcourt.llm.runtime import ship, table
from hardcourt.llm.words import words

COVERAGE, NEAR, REACH = 0.8, 3, 8

_DISCLAIMER = """IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."""

#: Texts of short licenses, and the notices by which texts state their license. Longer license texts are
#: given by the caller.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE " + _DISCLAIMER,
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", _GNU_NOTICE.format(name="GNU General Public License", version=3)),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", _GNU_NOTICE.format(name="GNU General Public License", version=2)),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", _GNU_NOTICE.format(name="GNU Lesser General Public License", version=3)),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", _GNU_NOTICE.format(name="GNU Affero General Public License", version=3)),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-NC-SA-4.0": ("Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "CC-BY-NC-ND-4.0": ("Licensed under CC BY-NC-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        f"{_BSD_CONDITIONS} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_BSD_DISCLAIMER}",
    ),
    "BSD-2-Clause": (f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}",),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "EPL-2.0": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "All-Rights-Reserved": ("All rights reserved.",),
}
#: Names by which texts call a license, with the version where it has one.
CALLED = {
    "MIT": ("MIT License",),
    "Apache-2.0": ("Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License"),
    "GPL-3.0": ("GNU GPL v3", "GPL v3", "GNU GPLv3", "GNU GPL version 3", "GNU General Public License v3", "GNU General Public License version 3"),
    "GPL-2.0": ("GNU GPL v2", "GPL v2", "GNU GPLv2", "GNU GPL version 2", "GNU General Public License v2", "GNU General Public License version 2"),
    "LGPL-3.0": ("GNU LGPL v3", "LGPL v3", "GNU Lesser General Public License v3", "GNU Lesser General Public License version 3"),
    "LGPL-2.1": (
        "GNU LGPL v2.1", "LGPL v2.1", "GNU Lesser General Public License v2.1", "GNU Lesser General Public License version 2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": ("GNU AGPL v3", "AGPL v3", "GNU Affero General Public License v3", "GNU Affero General Public License version 3"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License"),
}
#: Older versions of the Creative Commons licenses are called as the newest one is.
CC_VERSIONS, CC_NEWEST = ("2.0", "2.5", "3.0"), "4.0"


def of_every_version(texts: dict[str, tuple[str, ...]]) -> dict[str, tuple[str, ...]]:
    """texts with what CALLED adds, and each text of a newest version with the older numbers in its place."""
    out = {n: (*texts.get(n, ()), *CALLED.get(n, ())) for n in (*texts, *(n for n in CALLED if n not in texts))}
    for name in [n for n in texts if n.startswith("CC-") and n.endswith(CC_NEWEST)]:
        for version in CC_VERSIONS:
            out[name.replace(CC_NEWEST, version)] = tuple(t.replace(CC_NEWEST, version).replace("International", "Unported") for t in texts[name])
    return out


#: Notices that name a license by its identifier, for all of TEMPLATES whose name is one.
BY_NAME = ("SPDX-License-Identifier: {}", "License: {}", "Licence: {}")
#: Words too frequent in any text to be a template's own cues, unless it has no others.
COMMON = {*b"released under the is to any person of this and in without work version program free you can it terms as published by either or at your option later may not use file except with that are code form subject for purpose all copies above notice appear provided following conditions met source 0 1 2 3 4 v".split()}
#: Templates of fewer words than SHORT are looked for as they stand.
SHORT = 5


def increasing(places: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence, by patience piles."""
    tops: list[int] = []
    top_at: list[int] = []
    back: list[int] = []
    for i, p in enumerate(places):
        k = bisect_left(tops, p)
        back.append(top_at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(p)
            top_at.append(i)
        else:
            tops[k], top_at[k] = p, i
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def aligned(a: list, b: list, a0: int = 0, a1: int | None = None, b0: int = 0, b1: int | None = None) -> list[tuple[int, int]]:
    """Pairs of places in a and b that the patience alignment matches."""
    todo, out = [(a0, len(a) if a1 is None else a1, b0, len(b) if b1 is None else b1)], []
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i >= j or k >= m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        at = {w: y for y, w in enumerate(b[k:m], k) if in_b[w] == 1}
        both = [(x, at[w]) for x, w in enumerate(a[i:j], i) if in_a[w] == 1 and w in at]
        if not both:
            continue
        both = [both[x] for x in increasing([y for _, y in both])]
        out += both
        for (x, y), (x2, y2) in zip([(i - 1, k - 1), *both], [*both, (j, m)], strict=True):
            todo.append((x + 1, x2, y + 1, y2))
    return sorted(out)


class Templates:
    """Templates by license, as words, with their cues and the words that tell a license from all others."""

    def __init__(self, texts: dict[str, tuple[str, ...]], least: float):
        named = {n: (*t, *(f.format(n) for f in BY_NAME if n != "All-Rights-Reserved")) for n, t in texts.items()}
        self.all = [(n, words(t)) for n, ts in named.items() for t in ts]
        of = {w: len({n for n, t in self.all if w in t}) for _, t in self.all for w in t}
        ranked = [sorted({*t}, key=lambda w: (w in COMMON or w.isdigit(), of[w], -len(w), w)) for _, t in self.all]
        lacks = [len(t) - ceil(least * len(t) - 1e-9) for _, t in self.all]
        self.cues = [frozenset(r[: n + 1]) for r, n in zip(ranked, lacks, strict=True)]
        self.numbers = [{w for w in t if w.isdigit() or (w[:1] == b"v" and w[1:].isdigit())} for _, t in self.all]
        self.own = [{w for w in t if of[w] == 1} for _, t in self.all]
        self.distinct = [max(1, len({*t}) - n) for (_, t), n in zip(self.all, lacks, strict=True)]
        self.wanted = frozenset().union(*self.cues)

    def gate(self) -> str:
        """What a text with any cue matches."""
        return rf"(?i)(?<![a-z0-9])(?:{'|'.join(sorted(re.escape(w.decode()) for w in self.wanted))})(?![a-z0-9])"


@cache
def standard(least: float) -> Templates:
    return Templates(of_every_version(TEMPLATES), least)


def scan(text: str | None, least: float = COVERAGE, templates: Templates | None = None) -> list[tuple[str, float, int, int]]:
    """(license, coverage, first word, last word exclusive): the best template per stretch of text, in text order."""
    known = templates or standard(least)
    found = words(text)
    places: dict[bytes, list[int]] = {}
    for i, w in enumerate(found):
        if w in known.wanted:
            places.setdefault(w, []).append(i)
    hits = []
    for (name, template), cues, own, numbers, distinct in zip(known.all, known.cues, known.own, known.numbers, known.distinct, strict=True):
        here = sorted((i, w) for w in cues if w in places for i in places[w])
        n, past = len(template), -1
        for cue, word in here:
            if cue < past:
                continue
            at = [i for i, w in enumerate(template) if w == word]
            # near the cue first: where statements follow each other, a wide region has each word more than once
            for slack in (1,) if n < SHORT else (NEAR, max(REACH, n)):
                a, b = max(0, cue - at[-1] - slack), min(len(found), cue + n - at[0] + slack)
                if len({*template}.intersection(found[a:b])) < distinct:
                    continue
                pairs = aligned(found[a:b], template)
                # matches far from the rest (a stray common word) do not stretch the span beyond the template's length
                inside = [(x, y) for x, y in pairs if any(abs((x + a - cue) - (y - k)) <= slack for k in at)]
                share = len(inside) / n
                # a version's numbers are never among the words that may be missing
                if share >= least and (not own or any(template[y] in own for _, y in inside)) and numbers <= {template[y] for _, y in inside}:
                    first, last = a + inside[0][0], a + inside[-1][0] + 1
                    if n >= SHORT or last - first == n:
                        hits.append((-len(inside), -share, first, last, name))
                        past = last
                        break
    out: list[tuple[str, float, int, int]] = []
    for _, share, first, last, name in sorted({*hits}):
        if all(last <= f or first >= e for _, _, f, e in out):
            out.append((name, round(-share, 4), first, last))
    return sorted(out, key=lambda x: (x[2], x[0]))


def licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = COVERAGE, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(key, license, coverage, first_word, last_word): one row per license statement found.

    templates: license to texts; these replace TEMPLATES, which may be among them.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    known = Templates(templates, least) if templates else None

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, *hit) for k, t in enumerate(batch.column(1).to_pylist()) for hit in scan(t, least, known)]
            at, *rest = [*zip(*rows, strict=True)] if rows else [[]] * 5
            kinds = (pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(rest, kinds, strict=True))], [key, "license", "coverage", "first_word", "last_word"])

    return docs.select(key, docs[text].alias("text")).filter(F.col("text").rlike((known or standard(least)).gate())).mapInArrow(step, f"{key} {kind}, license string, coverage double, first_word long, last_word long")


def op4_license_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per statement one row; documents without one have none."""
    return licenses(table(spark, sf_dir, "documents"))
