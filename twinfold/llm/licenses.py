"""Licence scan by Dice coefficient over word bigrams."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import map_pandas
from .common import table

#: Public licence texts and notices, without their copyright lines.
_WARRANTY = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
_BSD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_BSD_3 = "3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_END = "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
TEMPLATES = {
    "MIT": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software " + _WARRANTY,
    "ISC": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "BSD-2-Clause": f"{_BSD} {_BSD_END}",
    "BSD-3-Clause": f"{_BSD} {_BSD_3} {_BSD_END}",
    "Zlib": "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required 2 altered source versions must be plainly marked as such and must not be misrepresented as being the original software 3 this notice may not be removed or altered from any source distribution",
    "Apache-2.0": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "GPL-3.0": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details you should have received a copy of the gnu general public license along with this program if not see http www gnu org licenses",
    "AGPL-3.0": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu affero general public license for more details you should have received a copy of the gnu affero general public license along with this program if not see http www gnu org licenses",
    "LGPL-2.1": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public license for more details",
    "MPL-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "EPL-2.0": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at http www eclipse org legal epl 2 0",
    "BSL-1.0": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following the copyright notices in the software and this entire statement including the above license grant this restriction and the following disclaimer must be included in all copies of the software in whole or in part and all derivative works of the software unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose title and non infringement in no event shall the copyright holders or anyone distributing the software be liable for any damages or other liability whether in contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "Unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law " + _WARRANTY.replace("authors or copyright holders", "authors"),
    "CC0-1.0 notice": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "MIT notice": "released under the mit license",
    "MIT notice (licensed)": "licensed under the mit license",
    "Apache-2.0 notice": "licensed under the apache license version 2 0",
    "GPL-3.0 notice": "this work is licensed under the gnu general public license version 3",
    "CC-BY-NC-4.0 notice": "licensed under cc by nc 4 0",
    "CC-BY-4.0 notice": "this work is licensed under a creative commons attribution 4 0 international license",
}
_TOKEN = re.compile(r"[A-Za-z0-9]+")
_COPYRIGHT = re.compile(r"(?im)^[^\n\w]*copyright\b.*$")
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n")


def normal_words(text: str) -> list[str]:
    return [w.lower() for w in _TOKEN.findall(_COPYRIGHT.sub(" ", text))]


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def segments(text: str):
    """(start, end) of the whole text, its paragraphs and its lines, each span once."""
    seen = {(0, len(text))}
    yield 0, len(text)
    for cut in (_PARAGRAPH, re.compile("\n")):
        at = 0
        for m in [*cut.finditer(text), None]:
            span = (at, m.start() if m else len(text))
            if span not in seen and span[0] < span[1]:
                seen.add(span)
                yield span
            at = m.end() if m else at


def scan_text(text: str, templates: dict[str, set], least: float) -> list[tuple[int, int, str, float]]:
    """Best licence of every segment, of runs of lines and of windows of words where nothing says as much, that reaches the least Dice coefficient.

    A template whose bigram count n is outside least/(2-least)..(2-least)/least times that of the segment can't reach
    it, and isn't compared.
    """
    held = bigrams(normal_words(text))
    # whatever a part of the text has in common with a template, the whole has
    templates = {name: t for name, t in templates.items() if len(held & t) >= len(t) * least / (2 - least) - 1e-9}
    if not templates:
        return []
    ratio, found = (2 - least) / least, []
    sizes = [len(x) for x in templates.values()]
    low, high = min(sizes) / ratio, max(sizes) * ratio
    for start, end in segments(text):
        if end - start < 2 * low:
            continue
        grams = bigrams(normal_words(text[start:end]))
        if not low <= len(grams) <= high:
            continue
        best = max(((dice(grams, t), name) for name, t in templates.items() if len(t) / ratio <= len(grams) <= len(t) * ratio), default=(0.0, ""))
        if best[0] >= least:
            found.append((start, end, best[1], round(best[0], 9)))
    found += run_matches(text, templates, least, found)
    return found + window_matches(text, templates, least, found)


def run_matches(text: str, templates: dict[str, set], least: float, known: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """Best licences of runs of two or more consecutive lines, and so of paragraphs too. known: matches of segments.

    Of overlapping runs the one with the largest coefficient counts, the longest among equals. A run that a known match
    explains as well (of the same licence and overlapping, or around it) is left out. Runs start at lines that have a bigram of
    the template, as others only lower the coefficient, and not behind a line whose bigrams are all the template's, as with
    that line the coefficient is no smaller; after half a template of such lines one starts anew, for a licence that follows
    another. Of one start the best end counts. So the work is that of a few words for each word, however short lines are.
    """
    if "\n" not in text:
        return []
    held = bigrams(normal_words(text))
    lines, at = [], 0
    for line in text.split("\n"):
        if found := normal_words(line):
            lines.append((at, at + len(line), found))
        at += len(line) + 1
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for name, t in templates.items():
        most = len(held & t)
        skipped = len(t)
        for i, (start, _, first) in enumerate(lines):
            onward = (first[-1], lines[i + 1][2][0]) if i + 1 < len(lines) else None
            if onward not in t and t.isdisjoint(zip(first, first[1:], strict=False)):
                continue
            before = lines[i - 1][2] if i else []
            if before and skipped < len(t) / 2 and (before[-1], first[0]) in t and all(x in t for x in zip(before, before[1:], strict=False)):
                skipped += len(before)
                continue
            grams, last, common, n_words, skipped = set(), [], 0, 0, 0
            found: tuple[float, int] = (0.0, 0)
            for j in range(i, len(lines)):
                words = last + lines[j][2]
                new = {x for x in zip(words, words[1:], strict=False) if x not in grams}
                grams |= new
                more = len(new & t)
                common += more
                n_words += len(lines[j][2])
                last = words[-1:]
                if len(grams) > len(t) * (2 - least) / least:
                    break
                d = 2 * common / (len(grams) + len(t))
                if j > i and (more or not new) and d >= least:
                    found = max(found, (d, lines[j][1]))
                if common == most and n_words > 2 * len(t):  # no larger coefficient can follow
                    break
            if found[1]:
                best[start, found[1]] = max(best.get((start, found[1]), (0.0, "")), (found[0], name))
    taken: list[tuple[int, int, str, float]] = []
    for (start, end), (d, name) in sorted(best.items(), key=lambda x: (-x[1][0], x[0][0] - x[0][1], x[0])):
        d = round(d, 9)
        explained = any(e >= d and s0 < end and start < s1 and (n == name or s0 <= start and end <= s1) for s0, s1, n, e in known)
        if not explained and all(end <= s0 or s1 <= start for s0, s1, *_ in taken):
            taken.append((start, end, name, d))
    return taken


def window_matches(text: str, templates: dict[str, set], least: float, known: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """Best licences of windows of words, wherever they begin and end: a licence inside a line, or set in prose.

    A window has as many bigrams as the template; its distinct bigrams and those in common are counted as it slides.
    Of overlapping windows the one with the largest coefficient counts, the first among equals; bigrams at its ends that
    the template doesn't have are cut off, those beyond them that it has are added. Windows that a match explains as well
    (of the same licence and overlapping, or around it) are left out.
    """
    blank = _COPYRIGHT.sub(lambda m: " " * len(m[0]), text)
    places = [(m.start(), m.end()) for m in _TOKEN.finditer(blank)]
    words = [blank[a:b].lower() for a, b in places]
    pairs = list(zip(words, words[1:], strict=False))
    best = []
    for name, t in templates.items():
        n = min(len(t), len(pairs))
        seen: Counter = Counter(pairs[:n])
        common = sum(x in t for x in seen)
        before, last_kept = 0.0, -n
        for i in range(len(pairs) - n + 1):
            if i:
                old, new = pairs[i - 1], pairs[i + n - 1]
                seen[old] -= 1
                if not seen[old]:
                    del seen[old]
                    common -= old in t
                common += new in t and new not in seen
                seen[new] += 1
            d = 2 * common / (len(seen) + len(t)) if seen else 0.0
            rises, before = d > before, d
            # where the coefficient doesn't rise, a window in every eighth of a template is enough
            if d >= least - 1e-9 and (rises or i - last_kept >= n // 8):
                first, last, last_kept = i, i + n - 1, i
                while pairs[first] not in t:
                    first += 1
                while pairs[last] not in t:
                    last -= 1
                # a licence says some things twice, so its text is longer than its set of bigrams
                while first > max(0, i - n) and pairs[first - 1] in t:
                    first -= 1
                while last + 1 < min(len(pairs), i + 2 * n) and pairs[last + 1] in t:
                    last += 1
                best.append((-dice(set(pairs[first : last + 1]), t), first, last, name))
    taken: list[tuple[int, int, str, float]] = []
    for d, first, last, name in sorted(best):
        start, end, d = places[first][0], places[last + 1][1], round(-d, 9)
        if d >= least and not any(x >= d and s < end and start < e and (n == name or s <= start and end <= e) for s, e, n, x in known + taken):
            taken.append((start, end, name, d))
    return taken


def read_templates(folder: str) -> dict[str, str]:
    """Templates from the files of a folder of the driver, by file name: for full licence texts, which are too long to list here."""
    return {f.name: f.read_text(errors="replace") for f in sorted(Path(folder).iterdir()) if f.is_file()}


def scan(docs: DataFrame, least: float = 0.8, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id and matches, an array of (start, end, licence, dice) in code points of the whole text, in order.

    Segments are the whole text, its paragraphs and its lines; then come the best runs of consecutive lines, and the
    best windows of words. Null and empty texts have no matches; ties go to the name later in the alphabet, between
    windows to the first; texts of any length are taken whole; repeated rows are each scanned. An empty table gives an
    empty result. Only doc_id and matches come back, so extra columns can't clash. templates: TEMPLATES if not given.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(parts):
        known = {name: bigrams(normal_words(t)) for name, t in (templates or TEMPLATES).items()}
        for part in parts:
            got = [[{"start": a, "end": b, "license": n, "dice": d} for a, b, n, d in sorted(scan_text(t or "", known, least))] for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "matches": pd.Series(got, index=part.index, dtype=object)})

    return map_pandas(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, matches array<struct<start:int,end:int,license:string,dice:double>>")


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    found = F.col("matches")
    best = F.element_at(F.array_sort(found, lambda a, b: F.when(a["dice"] != b["dice"], F.when(a["dice"] > b["dice"], -1).otherwise(1)).otherwise(a["start"] - b["start"])), 1)
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size(found).cast("long").alias("n_matches"), F.when(F.size(found) > 0, best["license"]).alias("license"), F.when(F.size(found) > 0, best["dice"]).alias("dice"),
        F.array_join(F.transform(found, lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string"))), ",").alias("spans"),
    )
