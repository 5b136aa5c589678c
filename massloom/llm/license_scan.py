"""License scan by conditional compression.

Regions of a text that hold a word of license notices are candidates. Templates
of which a region lacks too many words are out. With each of the others as a raw
zstandard dictionary the region is compressed, and alone; those that save bytes
are aligned with the region word by word, and the exact differences in wording
confirm or refuse them. A confirmed notice is
taken out and the rest is looked at again, until nothing more is confirmed.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.shared import map_batches, whole_text

# Short names of licenses, and wordings that declare them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    ("proprietary", "All rights reserved."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License v3.0."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License v3.0."),
    (
        "LGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-3.0-or-later",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-2.0-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("MPL-2.0", "Licensed under the Mozilla Public License 2.0."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("EPL-2.0", "Licensed under the Eclipse Public License 2.0."),
    ("ISC", "Released under the ISC License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "This work is licensed under a Creative Commons CC0 1.0 Universal License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    (
        "CC-BY-ND-4.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    (
        "CC-BY-NC-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    (
        "CC-BY-NC-ND-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
)
# Whole texts of the short licenses.
_AS_IS = (
    "IN NO EVENT SHALL THE {who} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
).format(who="COPYRIGHT HOLDER OR CONTRIBUTORS")
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. " + _AS_IS
)
WHOLE_TEXTS = (
    (
        "MIT",
        TEMPLATES[2][1]
        + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    (
        "BSD-3-Clause",
        _BSD_HEAD
        + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission. " + _BSD_TAIL,
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
        "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
        "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
        "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The "
        "origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this "
        "software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered "
        "source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice "
        "may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the "
        "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do "
        "so, all subject to the following:",
    ),
    ("GPL-2.0", "Licensed under the GPLv2."),
    ("GPL-3.0", "Licensed under the GPLv3."),
    ("LGPL-3.0", "Licensed under the LGPLv3."),
    ("AGPL-3.0", "Licensed under the AGPLv3."),
)
# Identifiers of licenses; a ``+`` behind a version is another spelling of or-later.
IDENTIFIERS = """
MIT Apache-2.0 ISC 0BSD BSD-2-Clause BSD-3-Clause BSD-4-Clause Zlib BSL-1.0 MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 CDDL-1.0 EUPL-1.2
Unlicense WTFPL Artistic-2.0 PSF-2.0 Python-2.0 PostgreSQL OFL-1.1 MS-PL
GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later
LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later
AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later
CC0-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0
""".split()
TAG = "SPDX-License-Identifier: "
TEMPLATES += WHOLE_TEXTS
TEMPLATES += tuple((name, TAG + name) for name in IDENTIFIERS)
TEMPLATES += tuple((name, TAG + name.replace("-or-later", "+")) for name in IDENTIFIERS if name.endswith("-or-later"))
#: Every template holds one of these.
CUES = re.compile(r"licen[sc]|copyright|rights reserved|permission (?:is|to use)|redistribut|free software|public domain", re.IGNORECASE)

#: The part of a template's words that may differ.
DIFFERENT = 0.1
LEVEL = 12
#: Words that say which license it is: where one of them differs, it is another license or version.
_NAMING = re.compile(
    r"^v?\d|^(?:mit|isc|mpl|epl|lesser|affero|mozilla|eclipse|boost|apache|creative|commons|zero)$"
    r"|gpl|bsd|cc0|^(?:cc-)?by-|attribution|non-?commercial|no-?deriv|share-?alike"
)
_WORD = re.compile(r"[^\W_]+(?:[-./'][^\W_]+)*\+?")


@dataclass
class Notice:
    """``missing`` words of the template and ``added`` words of the text, in order."""

    license: str
    start: int
    end: int
    missing: list[str]
    added: list[str]
    saved: int


def _words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    found = list(_WORD.finditer(text))
    return [m[0].lower().replace("licence", "license") for m in found], [m.span() for m in found]


_WORDINGS = [(name, text, _words(text)[0]) for name, text in TEMPLATES]
_COUNTS = [Counter(words) for _, _, words in _WORDINGS]
_BUDGETS = [int(len(words) * DIFFERENT) for _, _, words in _WORDINGS]
#: Words that the longest notice may have: those of its template and as many more as may differ. So many on either
#: side of a cue belong to its region, and parts of a long region overlap by as many.
REACH = max(len(words) + budget for (_, _, words), budget in zip(_WORDINGS, _BUDGETS, strict=True))
_engines: list[zstandard.ZstdCompressor] = []


def _compressors() -> list[zstandard.ZstdCompressor]:
    """Without a dictionary, then with each template; made once per worker."""
    if not _engines:
        _engines.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
        for _, text, _ in _WORDINGS:
            data = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            _engines.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False))
    return _engines


def possible(words: list[str]) -> list[int]:
    """Templates that may be confirmed: a word that is not in the text is an edit at least."""
    there = Counter(words)
    return [
        k
        for k, (needed, budget) in enumerate(zip(_COUNTS, _BUDGETS, strict=True))
        # Most templates fail by their distinct words alone.
        if len(needed.keys() - there.keys()) <= budget and (needed - there).total() <= budget
    ]


def ranked(block: str, templates: list[int]) -> list[tuple[int, int]]:
    """(bytes saved, template); first those that save most for their length."""
    if not templates:
        return []
    alone, *given = _compressors()
    # The last bytes of an input are never matched, so some that do not matter stand behind it.
    data = block.encode("utf-8", "replace") + b"\n" * 16
    plain = len(alone.compress(data))
    saved = [(plain - len(given[k].compress(data)), k) for k in templates]
    return sorted(saved, key=lambda x: (-x[0] / len(TEMPLATES[x[1]][1]), x[1]))


def aligned(template: list[str], words: list[str]) -> tuple[int, int, int]:
    """Fewest word edits of the template against a run of ``words``, with the run's borders (the shortest of equals)."""
    count = len(words)
    code = {w: k for k, w in enumerate(dict.fromkeys(template))}
    text = np.array([code.get(w, -1) for w in words])
    # Edits count in the high part, so that the latest start wins among equals.
    one = np.int64(1) << 32
    places = np.arange(count + 1)
    cost = (count - places).astype(np.int64)
    for word in template:
        now = np.empty_like(cost)
        now[0] = cost[0] + one
        now[1:] = np.minimum(cost[:-1] + np.where(text == code[word], 0, one), cost[1:] + one)
        cost = np.minimum.accumulate(now - places * one) + places * one
    end = int(cost.argmin())
    return int(cost[end] >> 32), count - int(cost[end] & (one - 1)), end


def differences(template: list[str], words: list[str]) -> tuple[list[str], list[str]]:
    """Words only in the template and only in the text, each in order and as often as they are more."""

    def more(a: list[str], b: list[str]) -> list[str]:
        left = list(b)
        out = []
        for word in a:
            if word in left:
                left.remove(word)
            else:
                out.append(word)
        return out

    return more(template, words), more(words, template)


def _behind(text: str, at: int) -> int:
    """Where the ``REACH`` words from ``at`` on end, or the text."""
    end = len(text)
    for number, word in enumerate(_WORD.finditer(text, at), 1):
        if number == REACH:
            end = word.end()
            break
    return end


def _before(text: str, at: int) -> int:
    """Where the last ``REACH`` words in front of ``at`` begin, or the text."""
    length = 8 * REACH
    while length < at:
        # The first word may be cut.
        starts = [m.start() for m in _WORD.finditer(text, at - length, at)][1:]
        if len(starts) >= REACH:
            return starts[-REACH]
        length *= 2
    return 0


def _regions(text: str) -> list[tuple[int, int]]:
    """Regions of ``REACH`` words around the cues, merged where they meet, in parts of four times as many words.

    A notice holds a cue and at most ``REACH`` words, whatever stands between
    them, and parts overlap by ``REACH`` words: it lies within one part.
    """
    merged: list[list[int]] = []
    for cue in CUES.finditer(text):
        high = _behind(text, cue.start())
        low = 0 if merged and cue.start() <= merged[-1][1] else _before(text, cue.end())
        if merged and low <= merged[-1][1]:
            merged[-1][1] = high
        else:
            merged.append([low, high])
    parts = []
    for low, high in merged:
        spans = [m.span() for m in _WORD.finditer(text, low, high)]
        for at in range(0, max(1, len(spans) - REACH), 3 * REACH):
            parts.append((spans[at][0], spans[min(at + 4 * REACH, len(spans)) - 1][1]))
    return parts


def notices(text: str) -> list[Notice]:
    """License notices of one text in order; of overlapping ones the one that agrees in most words.

    Of an expression of several identifiers only the first is a notice.
    """
    found: list[tuple[int, Notice]] = []
    for low, high in _regions(text):
        block = text[low:high]
        while True:
            words, spans = _words(block)
            good = []
            for saved, k in ranked(block, possible(words)):
                name, _, template = _WORDINGS[k]
                if saved <= 0 or not words:
                    continue
                edits, first, last = aligned(template, words)
                if edits > _BUDGETS[k] or first >= last:
                    continue
                missing, added = differences(template, words[first:last])
                if not any(_NAMING.search(w) for w in missing + added):
                    good.append((edits - len(template), edits, spans[first][0], spans[last - 1][1], name, saved, missing, added))
            if not good:
                break
            unlike, _, start, end, name, saved, missing, added = min(good)
            found.append((unlike, Notice(name, low + start, low + end, missing, added, saved)))
            block = block[:start] + "\n" * (end - start) + block[end:]
    # Where parts overlap a notice may be found twice, or a piece of it beside the whole.
    kept: list[Notice] = []
    for _, one in sorted(found, key=lambda x: (x[0], len(x[1].missing) + len(x[1].added), x[1].start)):
        if all(one.end <= other.start or other.end <= one.start for other in kept):
            kept.append(one)
    return sorted(kept, key=lambda n: n.start)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, license, start, end (code points, end exclusive), missing, added, saved_bytes: a row for each notice.

    A null text counts as empty; texts without a notice give no row. Repeated
    rows give repeated rows. Other columns of ``docs`` are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [
            (doc_id, n)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for n in notices(text)
        ]
        words = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _ in got], pa.int64()),
                pa.array([n.license for _, n in got], pa.string()),
                pa.array([n.start for _, n in got], pa.int64()),
                pa.array([n.end for _, n in got], pa.int64()),
                pa.array([n.missing for _, n in got], words),
                pa.array([n.added for _, n in got], words),
                pa.array([n.saved for _, n in got], pa.int64()),
            ],
            names=["doc_id", "license", "start", "end", "missing", "added", "saved_bytes"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return map_batches(
        rows,
        run,
        "doc_id long, license string, start long, end long, missing array<string>, added array<string>, saved_bytes long",
    )
