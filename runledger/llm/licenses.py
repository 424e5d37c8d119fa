"""License scans by conditional compression, confirmed by exact wording differences.

Words are compared in lower case, with one spelling of `license` and of version numbers (v2, 2.0). A match has at most a seventh of its wording's
words edited (one at least, none below four words). An edit removes one word at most, so of any more distinct words of the wording one stays: these,
of eight letters or more that most wordings share, else the longest, are its cues. A wording may also name words (in braces below: names and versions)
that must stay; then one such word is the cue. Texts without any cue have no match: this filter loses nothing. Around each cue lies a candidate block, wide enough for every match through it.
A block is compressed alone and with every wording as raw dictionary, whether the wording holds this cue or not; wordings are ranked by size reduction, then fewer edits, and confirmed
by their fewest word edits against a stretch of the block that holds the cue (a wording that lacks more words of the block than may be edited needs no alignment: that is a lower bound).
Of confirmed findings that overlap, the larger reduction stays, then the earlier, then the license of lesser name. Besides grants, notices and tags the wordings are the paragraphs of
the short public licenses (MIT, ISC, BSD, Zlib, Boost, Unlicense, 0BSD) and of the notices of the long ones.
Null or empty texts and empty tables give no rows; very long texts are searched whole, block by block; other columns are ignored; repeated rows give repeated findings; rows without an id give theirs under a null id.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache, reduce
from operator import or_

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.shared import id_and_text

# License names and public wordings; braces mark words that must stay.
WORDINGS = [
    ("MIT", "Released under the {MIT} {License}"),
    ("MIT", "This project is licensed under the terms of the {MIT} {license}"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("Apache-2.0", "Licensed under the {Apache} License, Version {2.0}"),
    ("Apache-2.0", "This project is released under the {Apache} {2.0} license"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://{www.apache.org}/licenses/LICENSE-2.0"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD", "Released under the {BSD} {License}"),
    ("BSD-3-Clause", "Released under the {BSD} {3-Clause} License"),
    ("BSD-2-Clause", "Released under the {BSD} {2-Clause} License"),
    ("GPL-3.0", "This work is licensed under the {GNU} {General} {Public} License, version {3}"),
    ("GPL-2.0", "This work is licensed under the {GNU} {General} {Public} License, version {2}"),
    ("GPL", "you can redistribute it and/or modify it under the terms of the {GNU} {General} {Public} License as published by the Free Software Foundation"),
    ("LGPL", "you can redistribute it and/or modify it under the terms of the {GNU} {Lesser} {General} {Public} License as published by the Free Software Foundation"),
    ("AGPL", "you can redistribute it and/or modify it under the terms of the {GNU} {Affero} {General} {Public} License as published by the Free Software Foundation"),
    ("LGPL-2.1", "This work is licensed under the {GNU} {Lesser} {General} {Public} License, version {2.1}"),
    ("LGPL-3.0", "This work is licensed under the {GNU} {Lesser} {General} {Public} License, version {3}"),
    ("AGPL-3.0", "This work is licensed under the {GNU} {Affero} {General} {Public} License, version {3}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the {Mozilla} Public License, v. {2.0}"),
    ("MPL-2.0", "Licensed under the {Mozilla} Public License, version {2.0}"),
    ("EPL-2.0", "This program is made available under the terms of the {Eclipse} Public License {2.0}"),
    ("BSL-1.0", "Distributed under the {Boost} {Software} License, Version {1.0}"),
    ("Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"),
    ("Unlicense", "This is free and {unencumbered} software released into the public domain"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("all-rights-reserved", "All {rights} {reserved}"),
    ("MIT", "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software"),
    ("ISC", "The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. The software is provided as is"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("BSD", "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("BSD", "In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an as is basis, without warranties or conditions of any kind, either express or implied. See the License for the specific language governing permissions and limitations under the License"),
    ("GPL", "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the {GNU} {General} {Public} License for more details"),
    ("LGPL", "This library is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the {GNU} {Lesser} {General} {Public} License for more details"),
    ("AGPL", "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the {GNU} {Affero} {General} {Public} License for more details"),
    ("GPL", "You should have received a copy of the {GNU} {General} {Public} License along with this program"),
    ("MPL-2.0", "If a copy of the {MPL} was not distributed with this file, You can obtain one at https://{mozilla.org}/MPL/2.0/"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("Zlib", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required"),
    ("Zlib", "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"),
    ("Zlib", "This notice may not be removed or altered from any source distribution"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"),
    ("Unlicense", "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"),
]
CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
VERSIONS = ("4.0", "3.0")
WORDINGS += [(f"CC-{k}-{v}", w) for k, name in CC.items() for v in VERSIONS for w in (f"{{Licensed}} under {{CC}} {{{k}}} {{{v}}}", f"This work is licensed under a {{Creative}} Commons {{{name}}} {{{v}}} International License")]
TAGS = {k for k, _ in WORDINGS} - {"all-rights-reserved", "GPL", "LGPL", "AGPL", "BSD"}
WORDINGS += [(k, f"{{SPDX-License-Identifier}}: {{{k}{end}}}") for k in sorted(TAGS) for end in (("", "-only", "-or-later") if "GPL" in k else ("",))]

WORD = re.compile(r"[A-Za-z0-9]+(?:[.\-][A-Za-z0-9]+)*")
VERSION = re.compile(r"v?(\d+(?:\.\d+)*?)(?:\.0)?")
SCHEMA = "doc_id long, license string, start long, n_words int, differences int, saved_bytes long, wording string"


def distances(pattern: list[str], words: list[str], anchored: bool) -> list[int]:
    """Bit-parallel fewest word edits of the pattern against stretches that end after each word; they start anywhere or at the first word."""
    match: dict[str, int] = {}
    for i, w in enumerate(pattern):
        match[w] = match.get(w, 0) | 1 << i
    full, last, out = (1 << len(pattern)) - 1, 1 << len(pattern) - 1, []
    up, down, distance = full, 0, len(pattern)
    for w in words:
        m = match.get(w, 0)
        d = (((m & up) + up) ^ up) | m | down
        plus, minus = down | ~(d | up) & full, up & d
        distance += bool(plus & last) - bool(minus & last)
        plus = plus << 1 | anchored
        up, down = (minus << 1 | ~(d | plus)) & full, plus & d & full
        out.append(distance)
    return out


def best_stretch(pattern: list[str], words: list[str]) -> tuple[int, int, int]:
    """(fewest differences, start, end) of the earliest best stretch, as short as may be."""
    ends = distances(pattern, words, False)
    least = min(ends)
    end = ends.index(least) + 1
    length = distances(pattern[::-1], words[:end][::-1], True).index(least) + 1
    return least, end - length, end


def spelled(word: str) -> str:
    """Lower case, `license` for `licence`, and version numbers without v or a last .0."""
    word = word.lower()
    version = VERSION.fullmatch(word)
    return version[1] if version else word.replace("licenc", "licens")


class Scanner:
    """Wordings with their cues and dictionaries; blocks that recur are judged once."""

    def __init__(self, wordings=tuple(WORDINGS), level: int = 3):
        self.plain = zstandard.ZstdCompressor(level=level)
        self.wordings: list[tuple] = []
        self.by_cue: dict[str, dict[int, tuple[int, int]]] = {}
        parts = [(name, [spelled(w) for w in WORD.findall(text)], {spelled(w) for part in re.findall(r"\{(.*?)\}", text) for w in WORD.findall(part)}) for name, text in wordings]
        holders = Counter(w for _, words, marked in parts for w in marked or set(words))
        rank = lambda w: (len(w) < 8, -holders[w] if len(w) >= 8 else 0, -len(w), w)
        for i, (name, words, marked) in enumerate(parts):
            most = 0 if len(words) < 4 else max(1, len(words) // 7)
            raw = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=level)
            self.wordings.append((name, words, marked, most, zstandard.ZstdCompressor(level=level, dict_data=raw)))
            for cue in sorted(marked or set(words), key=rank)[: 1 if marked else most + 1]:
                self.by_cue.setdefault(cue, {})[i] = len(words) - 1 - words[::-1].index(cue) + most, len(words) - words.index(cue) + most
        self.reach = max((len(words) + most for _, words, _, most, _ in self.wordings), default=0)
        self.judge = lru_cache(4096)(self._judge)

    def _judge(self, cue: str, p: int, block: str) -> list[tuple]:
        """The confirmed wordings around the cue, word p of the block, by rank: (bytes saved, differences, start, end, name)."""
        words, alone, ranked = block.split(" "), {}, []
        for i, (_, pattern, _, most, given) in enumerate(self.wordings):
            before, after = self.by_cue[cue].get(i, (len(pattern) + most,) * 2)
            first, end = max(0, p - before), min(len(words), p + after)
            data = " ".join(words[first:end]).encode()
            if (first, end) not in alone:
                alone[first, end] = len(self.plain.compress(data))
            ranked.append((len(given.compress(data)) - alone[first, end], i, first, end))
        confirmed = []
        for saved, i, first, end in sorted(ranked):
            name, pattern, marked, most, _ = self.wordings[i]
            own = words[first:end]
            if marked <= set(own) and len(set(pattern).difference(own)) <= most:
                least, a, b = best_stretch(pattern, own)
                if least <= most and a <= p - first < b and marked <= set(own[a:b]):
                    confirmed.append((saved, least, first + a - p, first + b - p, name))
        return sorted(confirmed)

    def scan(self, text: str) -> list[tuple]:
        spans = [m.span() for m in WORD.finditer(text)]
        words = [spelled(text[a:b]) for a, b in spans]
        found = set()
        for p, cue in enumerate(words):
            if cue in self.by_cue:
                first = max(0, p - self.reach)
                for saved, least, start, end, name in self.judge(cue, p - first, " ".join(words[first : p + self.reach])):
                    found.add((saved, p + start, name, p + end, least))
        kept, taken = [], set()
        for saved, start, name, end, least in sorted(found):
            if taken.isdisjoint(range(start, end)):
                taken.update(range(start, end))
                kept.append((name, start, end - start, least, -saved, text[spans[start][0] : spans[end - 1][1]]))
        return sorted(kept, key=lambda r: r[1])


def has_cue(text: str, wordings=tuple(WORDINGS)):
    """Whether the column holds a cue in either spelling, whatever its case; the text is lowered once. A cue that holds another one needs no search of its own."""
    cues = Scanner(wordings).by_cue
    spellings = sorted({c for cue in cues for c in (cue, cue.replace("licens", "licenc"))})
    spellings = [c for c in spellings if not any(d != c and d in c for d in spellings)]
    return F.transform(F.array(F.lower(text)), lambda low: reduce(or_, (F.contains(low, F.lit(c)) for c in spellings)))[0]


def find_licenses(docs: DataFrame, wordings=tuple(WORDINGS)) -> DataFrame:
    """One row for each license wording found: where it starts (in words), its length, its differences and its text."""

    def run(batches):
        scanner = Scanner(wordings)
        for pdf in batches:
            out = [(doc, *found) for doc, text in zip(pdf["doc_id"].astype(object), pdf["text"]) for found in scanner.scan(text)]
            frame = pd.DataFrame(out, columns=["doc_id", "license", "start", "n_words", "differences", "saved_bytes", "wording"])
            yield frame.assign(doc_id=pd.array([None if pd.isna(d) else int(d) for d in frame["doc_id"]], "Int64"))

    return id_and_text(docs).filter(has_cue("text", wordings)).mapInPandas(run, SCHEMA)
