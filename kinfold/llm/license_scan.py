"""License scans: normalised text against licence templates by the Dice coefficient of word bigrams."""

from __future__ import annotations

import bisect
import pkgutil
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_of

# Fixed texts: lines and notices as licences word them, and whole licences (-text).
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "BSD-2-Clause-line": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause-line": "Released under the BSD 3-Clause License.",
    "BSD-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "LGPL-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT-line": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
_GNU = (
    "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License {2}"
    "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General Public License for more details."
)
_LATER = "as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version. "
_ONLY = "version {} as published by the Free Software Foundation. "
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. {}"
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES |= {
    "BSD-2-Clause": _BSD.format(""),
    "BSD-3-Clause": _BSD.format(
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission. "
    ),
    "GPL-1.0": _GNU.format("program", "", _LATER.format("1")),
    "GPL-2.0": _GNU.format("program", "", _LATER.format("2")),
    "GPL-2.0-only": _GNU.format("program", "", _ONLY.format("2")),
    "GPL-3.0-only": _GNU.format("program", "", _ONLY.format("3")),
    "LGPL-2.0": _GNU.format("library", "Library ", _LATER.format("2")),
    "LGPL-2.1": _GNU.format("library", "Lesser ", _LATER.format("2.1")),
    "LGPL-2.1-only": _GNU.format("library", "Lesser ", _ONLY.format("2.1")),
    "LGPL-3.0": _GNU.format("library", "Lesser ", _LATER.format("3")),
    "LGPL-3.0-program": _GNU.format("program", "Lesser ", _LATER.format("3")),
    "AGPL-3.0": _GNU.format("program", "Affero ", _LATER.format("3")),
    "AGPL-3.0-only": _GNU.format("program", "Affero ", _ONLY.format("3")),
    "ISC-text": TEMPLATES["ISC"] + (
        ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "MIT-text": TEMPLATES["MIT"] + (
        ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
}
# Whole licences, as they are published.
TEMPLATES |= {
    f"{name}-text": pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode()
    for name in ("AGPL-3.0", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")
}
WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Library:
    """Templates as multisets of word bigrams, sorted by size, with an index from bigram to templates."""

    def __init__(self, templates: Mapping[str, str], threshold: float):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold lies above 0 and is at most 1")
        self.threshold = threshold
        grams = {}
        for name, text in templates.items():
            w = words_of(text)
            if len(w) < 2:
                raise ValueError(f"template {name} has fewer than two words")
            grams[name] = Counter(zip(w, w[1:]))
        self.items = sorted(((sum(c.values()), name, c) for name, c in grams.items()), key=lambda x: x[:2])
        self.sizes = [n for n, _, _ in self.items]
        self.known = {g for _, _, c in self.items for g in c}

    def candidates(self, size: int) -> range:
        """Templates whose size lets the coefficient reach the threshold: within t / (2 - t) of each other."""
        t = self.threshold
        low, high = size * t / (2 - t), size * (2 - t) / t
        return range(bisect.bisect_left(self.sizes, low - 1e-9), bisect.bisect_right(self.sizes, high + 1e-9))

    @property
    def widest(self) -> float:
        t = self.threshold
        return self.sizes[-1] * (2 - t) / t if self.sizes else 0

    def matches(self, words: list[str]) -> list[tuple[str, float]]:
        """Templates that a whole unit of text equals by the coefficient."""
        n = len(words) - 1
        near = self.candidates(n) if n > 0 else range(0)
        if not len(near):
            return []
        have = Counter(g for g in zip(words, words[1:]) if g in self.known)
        if not have:
            return []
        out = []
        for i in near:
            size, name, c = self.items[i]
            common = sum(min(k, have[g]) for g, k in c.items() if g in have)
            if 2 * common >= self.threshold * (n + size):
                out.append((name, 2 * common / (n + size)))
        return out

    def windows(self, words: list[str]) -> list[tuple[str, float, int, int]]:
        """Best coefficient of each template over all stretches of its own number of bigrams, by sliding counts; where it starts, its bigrams."""
        pairs = list(zip(words, words[1:]))
        hits = [i for i, g in enumerate(pairs) if g in self.known]
        out = []
        for size, name, c in self.items if hits else []:
            if len(hits) < self.threshold * size:
                break  # the others are larger
            mine = [i for i in hits if pairs[i] in c]
            if len(mine) < self.threshold * size:
                continue
            best, at, have, common, left = 0.0, 0, Counter(), 0, 0
            for i in mine:  # the best stretch ends at one of the template's own bigrams
                have[pairs[i]] += 1
                common += have[pairs[i]] <= c[pairs[i]]
                while mine[left] <= i - size:
                    common -= have[pairs[mine[left]]] <= c[pairs[mine[left]]]
                    have[pairs[mine[left]]] -= 1
                    left += 1
                if common > best:
                    best, at = common, max(0, i - size + 1)
            dice = 2 * best / (size + min(size, len(pairs)))
            if dice >= self.threshold:
                out.append((name, dice, at, min(size, len(pairs))))
        return out


def text_matches(text: str, library: Library) -> list[tuple[str, float, str, int, int]]:
    """Every template found in a text with its best coefficient, the kind of unit that gave it, its start and bigrams.

    Units are the whole text, each of its lines, and every stretch of as many bigrams as a template has.
    """
    best: dict[str, tuple[float, str, int, int]] = {}

    def note(name: str, dice: float, unit: str, at: int, n: int) -> None:
        if name not in best or dice > best[name][0]:
            best[name] = (dice, unit, at, n)

    words: list[str] = []
    lines = text.split("\n")
    for line in lines:
        w = words_of(line)
        if len(lines) > 1:
            for name, dice in library.matches(w):
                note(name, dice, "line", len(words), len(w) - 1)
        words += w
    for name, dice in library.matches(words):
        note(name, dice, "text", 0, len(words) - 1)
    for name, dice, at, n in library.windows(words):
        note(name, dice, "stretch", at, n)
    return sorted((name, *found) for name, found in best.items())


def winners(matches: list[tuple[str, float, str, int, int]], size: Mapping[str, int]) -> list[tuple[str, float]]:
    """Of matches that share half of the shorter one's stretch, the best: by coefficient, longer template, name."""
    taken: list[tuple[int, int]] = []
    out = []
    for name, dice, _, at, n in sorted(matches, key=lambda x: (-x[1], -size[x[0]], x[0])):
        if all(2 * (min(at + n, b) - max(at, a)) < min(n, b - a) for a, b in taken):
            taken.append((at, at + n))
            out.append((name, dice))
    return sorted(out)


def scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = 0.8,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: ``id, n_licenses, best_license, best_dice, licenses, winners`` (as ``name:dice``).

    ``licenses`` has all templates that match and ``n_licenses`` their number; ``winners`` has the best of those that match
    the same stretch, so one for each licence that the text holds.

    Dice is twice the common word bigrams (with repeats) over the sum of both numbers. The template set
    is a fixed, small parameter and is held by every task; size bounds rule out templates that a unit
    cannot match. Ties for the best go to the longer template, then to the name. Null text is empty text;
    texts of fewer than two words match nothing (no licences, null best). Rows that repeat an id or a text
    are each returned. An empty table gives no rows. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    size = {name: len(words_of(t)) for name, t in templates.items()}

    @F.pandas_udf("n_licenses long, best_license string, best_dice double, licenses string, winners string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        library = Library(templates, threshold)
        for texts in batches:
            out = []
            for text in texts:
                m = text_matches(text, library)
                top = min(m, key=lambda x: (-x[1], -size[x[0]], x[0])) if m else (None, None)
                won = ",".join(f"{n}:{d:.4f}" for n, d in winners(m, size))
                out.append((len(m), top[0], top[1], ",".join(f"{n}:{d:.4f}" for n, d, *_ in m), won))
            yield pd.DataFrame(out, columns=["n_licenses", "best_license", "best_dice", "licenses", "winners"])

    rows = docs.select(F.col(id_col), found(text_of(text_col)).alias("f"))
    return rows.select(id_col, "f.n_licenses", "f.best_license", "f.best_dice", "f.licenses", "f.winners")
