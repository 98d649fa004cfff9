"""License scan by conditional compression.

A built-in regular expression keeps texts with a trigger, a word of the templates or the name of a license. A block is what
stands within reach of triggers: as many words on both sides as the longest template may take. Every template's wording is looked for in the whole block, by word
alignment; only a template that lacks too many of its words in the block is left out unaligned. A wording is met
if at most a fifth as many words differ as the template has, none of which names the license (its name, its version, NC, ND, SA,
Lesser, Affero, a further clause). Each license whose wording is
met gives a row of its own, and what is left is looked through again. Paragraphs that hold triggers outside confirmed
licenses (as far as the block goes) are compressed with zstandard plain and with each template as raw dictionary, and go, unconfirmed, to the template that
saves the greatest share of bytes. That share is also given for confirmed licenses.

Defined cases: a null or empty text has no blocks; a block of any length is compared whole with every
template; repeated rows give the same findings again; other columns are ignored; ties in the saving go to the
template with the most of the block's naming words, then to the first by name.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of

#: Words of every template's wording and names of licenses; MIT and ISC only in capitals or after "under".
TRIGGERS = (
    r"(?i:licen[cs]|licen\u00e7|lizen[zs]|copyright|spdx|warrant|rights[\W_]+(?:\w+[\W_]+){0,3}reserved|creative[\W_]+commons|public[\W_]+domain|unencumbered|redistribution|\bhereby\b"
    r"|\b[al]?gpl|\bmpl\b|\bcc0|\bcc[\W_]+by|\bapache\b|\bbsd\b|\bgnu\b|\bmozilla\b|under[\W_]+(?:the[\W_]+)?(?:mit|isc)\b)|\b(?:MIT|ISC)\b"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution."
)


def _gnu(kind: str, version: str, name: str) -> tuple[str, ...]:
    """The notices of a license of the GNU family; kind is "", "Lesser " or "Affero "."""
    short, number = name.rsplit("-", 1)
    header = (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by "
        f"the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope "
        "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        f"See the GNU {kind}General Public License for more details."
    )
    return (
        f"This work is licensed under the GNU {kind}General Public License, version {version}.",
        f"Released under the GNU {kind}General Public License v{version}.",
        f"Released under {short} v{version}.",
        f"Released under {short}v{version}.",
        header,
        header.replace("This program", "This library"),
        f"SPDX-License-Identifier: {short}-{number}",
        f"SPDX-License-Identifier: {short}-{number}-only",
        f"SPDX-License-Identifier: {short}-{number}-or-later",
    )


def _cc(short: str, full: str) -> tuple[str, ...]:
    return (
        f"Licensed under CC {short} 4.0.",
        f"This work is licensed under a Creative Commons {full} 4.0 International License.",
        f"SPDX-License-Identifier: CC-{short}-4.0",
    )


#: The usual wordings of public licenses, headers and notices.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "AGPL-3.0": _gnu("Affero ", "3", "AGPL-3.0"),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", _BSD, "SPDX-License-Identifier: BSD-2-Clause"),
    "BSD-3-Clause": (
        "Released under the BSD License.",
        "Released under the BSD 3-Clause License.",
        f"{_BSD} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY-4.0": _cc("BY", "Attribution"),
    "CC-BY-NC-4.0": _cc("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-NC-ND-4.0": _cc("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _cc("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0": _cc("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-SA-4.0": _cc("BY-SA", "Attribution-ShareAlike"),
    "CC0-1.0": ("Released under CC0.", "Released under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"),
    "GPL-2.0": _gnu("", "2", "GPL-2.0"),
    "GPL-3.0": _gnu("", "3", "GPL-3.0"),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "LGPL-2.1": _gnu("Lesser ", "2.1", "LGPL-2.1"),
    "LGPL-3.0": _gnu("Lesser ", "3", "LGPL-3.0"),
    "MIT": (
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "Proprietary": ("All rights reserved.", "Copyright. All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}

SCHEMA = "doc_id long, start int, end int, license string, reduction double, n_differences int, differences string, confirmed boolean"
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*", re.UNICODE)
#: Words as the aligner compares them: parts of a hyphenated name are words of their own.
_PART = re.compile(r"[^\W_]+(?:\.[^\W_]+)*", re.UNICODE)
_EMPTY = re.compile(r"(?:\A|\n)[^\S\n]*(?:\n|\Z)")
_ID = r"[A-Za-z0-9][A-Za-z0-9.+-]*"
_SPDX = re.compile(rf"(?i:SPDX-License-Identifier):[ \t]*\(*{_ID}(?:[ \t]*\)*[ \t]+(?:OR|AND|WITH)[ \t]+\(*{_ID})*")
#: Words that tell a license from its relatives, as every word with a digit does: a difference in one is never passed over.
NAMING = frozenset(
    "mit bsd isc apache gnu gpl lgpl agpl lesser library affero mozilla mpl cc nc nd sa cc0 attribution noncommercial noderivatives noderivs sharealike "
    "commercial derivatives unlicense unencumbered spdx only later not no neither endorse advertising sublicense sell clause eclipse epl public domain rights reserved hereby redistributions".split()
)
#: Words right after a license that make it another one, and words before it that deny it.
GOES_ON = {"BSD-2-Clause": frozenset(("neither", "endorse", "advertising"))}
DENIED = frozenset(("not", "never", "no", "nicht", "non"))
#: What stands for a word that a confirmed license has taken, and a cost beyond any bound on differences.
TAKEN, NEVER = "", 1000


def paragraph(text: str, start: int, end: int) -> tuple[int, int]:
    """The span widened to whole lines up to the next empty ones."""
    before, after = [m.end() for m in _EMPTY.finditer(text, 0, start)], _EMPTY.search(text, end)
    return before[-1] if before else 0, after.start() if after else len(text)


def differences(block: str, template: str) -> tuple[list[str], int, int]:
    """Wording differences where the template's words meet the block's, the template's words found, and its words.
    Words of the block before and after that place are no differences."""
    a, b = [x.lower() for x in _WORD.findall(template)], [x.lower() for x in _WORD.findall(block)]
    match = difflib.SequenceMatcher(None, a, b, autojunk=False)
    runs = [m for m in match.get_matching_blocks() if m.size]
    if not runs:
        return [f"-{' '.join(a)}"], 0, len(a)
    low, high = max(0, runs[0].b - runs[0].a), min(len(b), runs[-1].b + runs[-1].size + len(a) - runs[-1].a - runs[-1].size)
    out, i, j = [], 0, runs[0].b - min(runs[0].a, runs[0].b - low)
    for m in [*runs, None]:
        x, y = (m.a, m.b) if m else (len(a), high)
        if i < x:
            out.append("-" + " ".join(a[i:x]))
        if m and j < y or not m and i < x and j < y:
            out.append("+" + " ".join(b[j:y]))
        if m:
            i, j = m.a + m.size, m.b + m.size
    return out, sum(m.size for m in runs), len(a)


def _plain(word: str) -> str:
    """Versions in one form: v3, 3.0 and 3 are the same."""
    return re.sub(r"^v(?=\d)|(?<=\d)(?:\.0)+$", "", word) if any(c.isdigit() for c in word) else word


class Words:
    """The words of a text with their places, as the aligner compares them, and what one more of them costs: list numbers
    nothing, naming words and words that a confirmed license has taken more than any license may differ by."""

    def __init__(self, text: str):
        found = list(_PART.finditer(text))
        self.text, self.raw, self.at = text, [m.group().lower() for m in found], [m.span() for m in found]
        self.words = [_plain(w) for w in self.raw]
        self.extra = [0 if self._numbers(k) else NEVER if w in NAMING or any(c.isdigit() for c in w) else 1 for k, w in enumerate(self.words)]

    def _numbers(self, k: int) -> bool:
        """Whether word k is the number of a list's item, as in "2. Redistributions" and not in "version 2. You"."""
        after = self.text[self.at[k][1] : self.at[k][1] + 2]
        return len(self.raw[k]) < 3 and self.raw[k].isdigit() and after[:1] in (".", ")") and after[1:].isspace() and not (k and self.raw[k - 1] in ("version", "v", "gpl"))

    def __len__(self) -> int:
        return len(self.words)


def _costs(a: Words, b: Words, ids: dict[str, int]) -> Iterator[np.ndarray]:
    """For 0, 1, ... all words of a: least cost of the word differences between them and some run of b that ends before each
    place of b."""
    codes, extra = np.array([ids.setdefault(w, len(ids)) for w in b.words], np.int64), np.array(b.extra, np.int64)
    step = np.concatenate([[0], np.cumsum(extra)])
    row = np.zeros(len(b) + 1, np.int64)
    yield row
    for w, lost in zip(a.words, a.extra, strict=True):
        after = row + lost
        np.minimum(after[1:], row[:-1] + np.where(codes == ids.setdefault(w, len(ids)), 0, np.maximum(extra, lost)), out=after[1:])
        row = np.minimum.accumulate(after - step) + step
        yield row


def _aligned(a: Words, b: Words, lo: int, hi: int) -> tuple[int, list[str]]:
    """Where the run of b that ends at hi begins, not before lo, and its wording differences from a."""
    piece = Words("")
    piece.words, piece.raw, piece.extra = b.words[lo:hi], b.raw[lo:hi], b.extra[lo:hi]
    table = np.array(list(_costs(a, piece, {})))
    i, j, moves = len(a), hi - lo, []
    while i:
        if j and a.words[i - 1] == piece.words[j - 1] and table[i, j] == table[i - 1, j - 1]:
            i, j = i - 1, j - 1
            moves.append(((), ()) if a.raw[i] == piece.raw[j] else ((a.raw[i],), (piece.raw[j],)))
        elif j and table[i, j] == table[i - 1, j - 1] + max(a.extra[i - 1], piece.extra[j - 1]):
            i, j = i - 1, j - 1
            moves.append(((a.raw[i],), (piece.raw[j],)))
        elif table[i, j] == table[i - 1, j] + a.extra[i - 1]:
            i -= 1
            moves.append(((a.raw[i],), ()))
        else:
            j -= 1
            moves.append(((), (piece.raw[j],)))
    out: list[str] = []
    less: list[str] = []
    more: list[str] = []
    for gone, come in [*moves[::-1], ((), ())]:
        less, more = [*less, *gone], [*more, *come]
        if not gone and not come:
            out += ["-" + " ".join(less)] * bool(less) + ["+" + " ".join(more)] * bool(more)
            less, more = [], []
    return lo + j, out


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, ...]], share: float = 0.8, level: int = 9):
        self.plain = zstandard.ZstdCompressor(level=level, write_checksum=False)
        made = lambda t: zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        self.templates = [(name, t, made(t)) for name in sorted(templates) for t in templates[name]]
        self.words = [Words(t) for _, t, _ in self.templates]
        self.bags = [Counter(w.words) for w in self.words]
        self.most = [int((1 - share) * len(w) + 1e-9) for w in self.words]
        self.reach = max((2 * len(w) + m for w, m in zip(self.words, self.most, strict=True)), default=0)
        self.spdx = {t.split()[1].lower(): k for k, (_, t, _) in enumerate(self.templates) if t.startswith("SPDX-License-Identifier: ")}

    def saved(self, block: str, k: int) -> float:
        raw = block.encode()
        return 1 - len(self.templates[k][2].compress(raw)) / len(self.plain.compress(raw))

    def ranked(self, block: str) -> list[tuple[float, str, str]]:
        """(reduction, license, template), most saved first; of equals the one with the most of the block's naming words."""
        raw = block.encode()
        base, naming = len(self.plain.compress(raw)), NAMING & set(Words(block).words)
        by = [(1 - len(z.compress(raw)) / base, -len(naming & self.bags[k].keys()), name, t) for k, (name, t, z) in enumerate(self.templates)]
        return [(saved, name, t) for saved, _, name, t in sorted(by, key=lambda x: (-x[0], *x[1:3]))]

    def _found(self, b: Words) -> list[tuple[int, int, int, int, list[str]]]:
        """(words met, negative; template; first word; end; differences) of every place where a template's wording stands.
        A template that lacks more words in b than it may differ by is left out: each is one difference at least."""
        bag, ids, out = Counter(b.words), {}, []
        for k, a in enumerate(self.words):
            if not len(a) or sum((self.bags[k] - bag).values()) > self.most[k]:
                continue
            *_, cost = _costs(a, b, ids)
            near = np.flatnonzero((cost <= self.most[k]) & (cost <= np.append(cost[1:], len(a) + 1)) & (cost <= np.insert(cost[:-1], 0, len(a) + 1)))
            for end in near.tolist():
                first, diff = _aligned(a, b, max(0, end - 2 * len(a) - 40), end)
                if first < end and self._stands(k, b, first, end):
                    out.append((int(cost[end]) - len(a), k, first, end, diff))
        return sorted(out)

    def _stands(self, k: int, b: Words, first: int, end: int) -> bool:
        """Whether the place is the license itself: neither a part of a longer name (MIT-0, GPL-2.0+), nor denied, nor
        gone on with what makes it another license."""
        low, high = b.at[first][0], b.at[end - 1][1]
        if b.text[high : high + 1] == "+" or re.match(r"-\w", b.text[high : high + 2]) or b.text[max(0, low - 1) : low] == "-":
            return False
        return not DENIED & set(b.raw[max(0, first - 2) : first]) and not GOES_ON.get(self.templates[k][0], DENIED - DENIED) & set(b.raw[end : end + 12])

    def _expressions(self, text: str) -> list[tuple[int, int, int, list[str]]]:
        """The known licenses of SPDX expressions; the first one's place begins with the tag."""
        out = []
        for m in _SPDX.finditer(text):
            tag, joint = m.start(), ""
            for x in re.finditer(_ID, m.group()[m.group().index(":") :]):
                low = m.start() + m.group().index(":") + x.start()
                if x.group() not in ("OR", "AND", "WITH") and joint != "WITH" and x.group().lower() in self.spdx:
                    out.append((low if out and out[-1][0] >= tag else tag, low + len(x.group()), self.spdx[x.group().lower()], []))
                joint = x.group()
        return out

    def confirmed(self, block: str) -> list[tuple[int, int, int, list[str]]]:
        """(start, end, template, differences) of all licenses in the block whose wording is met, longest first; what is
        left of the block after them is looked through again until nothing more is found."""
        b, spans = Words(block), self._expressions(block)
        for x, y, _, _ in spans:
            first, end = bisect_left(b.at, (x, 0)), bisect_left(b.at, (y, 0))
            b.words[first:end], b.extra[first:end] = [TAKEN] * (end - first), [NEVER] * (end - first)
        while True:
            taken = []
            for _, k, first, end, diff in self._found(b):
                if all(end <= x or y <= first for x, y in taken):
                    taken.append((first, end))
                    spans.append((b.at[first][0], b.at[end - 1][1], k, diff))
            if not taken:
                return sorted(spans, key=lambda x: x[:2])
            for first, end in taken:
                b.words[first:end], b.extra[first:end] = [TAKEN] * (end - first), [NEVER] * (end - first)

    def scan(self, text: str) -> list[tuple[int, int, str, float, list[str], bool]]:
        """(start, end, license, reduction, differences, confirmed) of all that is found in the text: each confirmed license,
        and for triggers outside them the template that saves most, unconfirmed."""
        triggers = [m.span() for m in re.finditer(TRIGGERS, text)]
        if not triggers:
            return []
        at = [m.span() for m in _PART.finditer(text)]
        begins = [x for x, _ in at]
        word = lambda x: max(0, bisect_right(begins, x) - 1)
        near = [(at[max(0, word(x) - self.reach)][0], at[min(len(at) - 1, word(y - 1) + self.reach)][1]) for x, y in triggers]
        out: list[tuple] = []
        for low, high in _joined(near):
            out += [(low + x, low + y, self.templates[k][0], self.saved(text[low + x : low + y], k), diff, True) for x, y, k, diff in self.confirmed(text[low:high])]
        sure = sorted(r[:2] for r in out)
        ends = [y for _, y in sure]
        rest = []
        for (x, y), (low, high) in zip(triggers, near, strict=True):
            k = bisect_right(ends, x)
            if k < len(sure) and sure[k][0] < y:
                continue
            p, q = paragraph(text, x, y)
            gap = (ends[k - 1] if k else 0, sure[k][0] if k < len(sure) else len(text))
            rest.append((max(p, low, gap[0]), min(q, high, gap[1])))
        for x, y in _joined(rest):
            x, y = x + len(text[x:y]) - len(text[x:y].lstrip(" \t\n.,;:-*/#")), x + len(text[x:y].rstrip())
            saved, name, template = self.ranked(text[x:y])[0]
            out.append((x, y, name, saved, differences(text[x:y], template)[0], False))
        return sorted(out, key=lambda r: r[:2])


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they overlap."""
    out: list[tuple[int, int]] = []
    for x, y in sorted(spans):
        if out and x < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], y))
        else:
            out.append((x, y))
    return out


def license_scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, share: float = 0.8) -> DataFrame:
    """One row for each license and each unconfirmed block of each document of docs (doc_id, text): doc_id, start, end
    (characters), license, reduction, n_differences, differences, confirmed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, share)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                for start, end, name, saved, diff, sure in scanner.scan(text):
                    rows.append((doc, start, end, name, round(saved, 6), len(diff), " ".join(diff), sure))
            types = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.string(), pa.bool_())
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").rlike(TRIGGERS))
    return found.mapInArrow(run, SCHEMA)
