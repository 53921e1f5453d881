"""Licences in texts: which template, given as a dictionary, shortens a block most.

Texts are cut into lines and sentences. Neighbouring units that use the templates'
words and hold a cue are a candidate block. Each template is a raw Zstandard
dictionary; templates are ranked by how much smaller the block becomes with them, and
the first whose exact wording differs in few enough words is the licence. In long blocks,
and where none saves enough of a whole block, the same is done in each part of the block
that has enough of a template's words, so that what stands beside a notice does not hide it.

Names, versions and numbers of clauses tell licences apart: they must not differ, however
few the words are. A notice after a negation is none.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstar.llm.common import by_batch

# A template is tried if it saves this share; it is confirmed if at most this share of
# its words differs.
LEAST_SAVING = 0.2
MOST_DIFFERENT = 0.15
# Templates whose savings are this close are told apart by their wording alone.
SIMILAR_SAVING = 0.15
# Share of a unit's words that templates must use.
SHARED_WORDS = 0.6
# Words of blocks remembered before a task starts anew, and of the longest block remembered.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 400
CUE = r"licen[sc]|copyright|permission|redistribut|warrant|public domain|rights reserved|(?:released|distributed|available) under|governed by"

# Names of licences as notices write them.
NAMES = (
    ("MIT", "MIT License"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License 2.0"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL-3.0", "GNU General Public License, version 3"),
    ("GPL-3.0", "GNU General Public License v3.0"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("Zlib", "zlib License"),
    ("Unlicense", "Unlicense"),
    ("CC0-1.0", "CC0 1.0 Universal license"),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("GPL-2.0", "GNU General Public License v2.0"),
    ("GPL-2.0", "GNU GPL version 2"),
    ("GPL-3.0", "GNU GPL version 3"),
    ("EPL-1.0", "Eclipse Public License, version 1.0"),
    ("EPL-2.0", "Eclipse Public License, version 2.0"),
    ("EPL-2.0", "Eclipse Public License 2.0"),
    ("MPL-2.0", "Mozilla Public License 2.0"),
    ("BSD-4-Clause", "BSD 4-Clause License"),
)
# Identifiers that tag lines name.
IDENTIFIERS = (
    "MIT ISC Zlib Unlicense CC0-1.0 0BSD BSL-1.0 Apache-2.0 MPL-2.0 EPL-1.0 EPL-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause "
    "GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later "
    "LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0"
).split()
# How notices begin.
FORMS = ("Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This software is distributed under the {}.", "Distributed under the {}.", "Available under the terms of the {}.", "Governed by the {}.")
# Grants and headers of licences.
TEXTS = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You '
        "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
        "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely.",
    ),
    (
        "BSD-4-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. All advertising materials mentioning features or use of this "
        "software must display the following acknowledgement: This product includes software developed by the organization. Neither the name of "
        "the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission.",
    ),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
)
# Words by which licences are named.
NAME_WORDS = frozenset(
    "mit apache gnu gpl lgpl agpl lesser affero library mozilla mpl eclipse epl bsd isc zlib unlicense cc cc0 by by-sa by-nc by-nd by-nc-sa "
    "by-nc-nd creative commons attribution attribution-sharealike attribution-noncommercial attribution-noderivatives universal "
    "2-clause 3-clause 4-clause clear artistic boost new modified".split()
)
VERSION_WORDS = frozenset("version versions v".split())
# Words that deny what follows, alone or as the last two.
DENIALS = frozenset({("not",), ("never",), ("cannot",), ("isn", "t"), ("aren", "t"), ("wasn", "t"), ("no", "longer"), ("not", "be"), ("not", "been"), ("never", "been")})
# Templates of up to so many words are notices: no number may be added to them.
NOTICE = 16

UNIT = re.compile(r"[^\n.!?]*(?:[.!?]+(?!\s)[^\n.!?]*)*[.!?]*\n?")
WORD = re.compile(r"\w+(?:[.-]\w+)*")
HAS_CUE = re.compile(CUE, re.I)


def _tells(word: str) -> bool:
    """Whether a word tells licences apart."""
    return word in NAME_WORDS or any(map(str.isdigit, word))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Finder:
    """Templates as dictionaries, and what was found in blocks seen before."""

    def __init__(self) -> None:
        notices = [(name, form.format(title)) for name, title in NAMES for form in FORMS]
        tags = [(name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS]
        self.templates = [(name, words_of(text)) for name, text in (*notices, *tags, *TEXTS)]
        self.longest = max(len(words) for _, words in self.templates)
        self.vocabulary = {w for _, words in self.templates for w in words}
        settings = {"format": zstandard.FORMAT_ZSTD1_MAGICLESS, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        parameters = zstandard.ZstdCompressionParameters.from_level(19, **settings)
        self.plain = zstandard.ZstdCompressor(compression_params=parameters)
        self.primed = [
            zstandard.ZstdCompressor(
                compression_params=parameters,
                dict_data=zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for _, words in self.templates
        ]
        self.known: dict[tuple[str, ...], list] = {}
        self.kept = 0
        # Words of each template and how often, those of few templates first.
        spread = Counter(w for _, words in self.templates for w in set(words))
        self.counts = [sorted(Counter(words).items(), key=lambda c: (spread[c[0]], c[0])) for _, words in self.templates]

    def savings(self, words: list[str]) -> list[tuple[float, int]]:
        """Templates that save enough, the largest saving first."""
        block = " ".join(words).encode()
        size = len(self.plain.compress(block))
        saved = [(1 - len(c.compress(block)) / size, -n) for n, c in enumerate(self.primed)]
        return [(s, -n) for s, n in sorted(saved, reverse=True) if s >= LEAST_SAVING]

    def difference(self, words: list[str], template: list[str]) -> tuple[int, int, int]:
        """Words that differ between the template and the part of the block it covers,
        and that part; all of the template's if a word differs that tells licences apart."""
        none = len(template), 0, 0
        changes = SequenceMatcher(None, words, template, autojunk=False).get_opcodes()
        while changes and changes[0][0] == "delete":
            changes = changes[1:]
        while changes and changes[-1][0] == "delete":
            changes = changes[:-1]
        if not any(c[0] == "equal" for c in changes):
            return none
        different, first, last = 0, changes[0][1], changes[-1][2]
        for kind, a, b, c, d in changes:
            if kind != "equal":
                if any(_tells(word) for word in template[c:d]) or self._adds(words, a, b, template):
                    return none
                different += max(b - a, d - c)
        return different, first, last

    def _adds(self, words: list[str], low: int, high: int, template: list[str]) -> bool:
        """Whether words that the block has in place of the template's, or besides, name
        another licence or version, or deny it."""
        for place in range(low, high):
            word = words[place]
            if word in NAME_WORDS or word in ("not", "never"):
                return True
            numbered = any(map(str.isdigit, word))
            if numbered and (len(template) <= NOTICE or (place and words[place - 1] in VERSION_WORDS)):
                return True
        return False

    def _confirmed(self, words: list[str], low: int, high: int, number: int) -> tuple[int, int, int] | None:
        """``(words that differ, first, last)`` in the block, if few enough differ and
        nothing denies the notice."""
        template = self.templates[number][1]
        different, first, last = self.difference(words[low:high], template)
        if not last or different > MOST_DIFFERENT * len(template):
            return None
        first, last = low + first, low + last
        if len(template) <= NOTICE and any(tuple(words[first - n : first]) in DENIALS for n in (1, 2) if first >= n):
            return None
        return different, first, last

    def in_words(self, words: list[str]) -> list[tuple[str, int, int, int, float]]:
        """``(licence, first word, word after the last, words that differ, saving)``;
        what stands before and after a licence is searched again."""
        if len(words) > LONGEST_REMEMBERED:
            return self._search(words)
        found = self.known.get(tuple(words))
        if found is None:
            if self.kept >= REMEMBERED:
                self.known.clear()
                self.kept = 0
            found = self.known[tuple(words)] = self._search(words)
            self.kept += len(words)
        return found

    def _search(self, words: list[str]) -> list:
        found, todo = [], [(0, len(words))]
        while todo:
            low, high = todo.pop()
            if low >= high or not HAS_CUE.search(" ".join(words[low:high])):
                continue
            winner = self._winner(words, low, high) if high - low <= 2 * self.longest else None
            if winner:
                found.append(winner)
                todo += [(low, winner[1]), (winner[2], high)]
                continue
            hidden = self._hidden(words, low, high)
            found += hidden
            ends = [low, *[h[2] for h in hidden]]
            todo += [gap for gap in zip(ends, [*[h[1] for h in hidden], high], strict=True) if hidden]
        return sorted(found, key=lambda f: f[1])

    def _hidden(self, words: list[str], low: int, high: int) -> list[tuple[str, int, int, int, float]]:
        """Confirmed templates of which no two share a word of the block, in order. Parts
        of the block are ranked by the bytes their template saves; words that are taken
        are looked at no more."""
        ranked = []
        for number, windows in self._windows(words, low, high):
            possible = [c for c in (self._confirmed(words, first, last, number) for first, last in windows) if c]
            if not possible:
                continue
            _, first, last = min(possible)
            block = " ".join(words[first:last]).encode()
            size = len(self.plain.compress(block))
            saved = size - len(self.primed[number].compress(block))
            if saved >= LEAST_SAVING * size:
                ranked.append((-saved, first, number, last))
        taken, chosen = bytearray(high - low), []
        for saved, first, number, last in sorted(ranked):
            while first < last and taken[first - low]:
                first += 1
            while first < last and taken[last - 1 - low]:
                last -= 1
            confirmed = self._confirmed(words, first, last, number) if last > first else None
            if confirmed:
                different, first, last = confirmed
                if not any(taken[first - low : last - low]):
                    taken[first - low : last - low] = b"\1" * (last - first)
                    size = len(self.plain.compress(" ".join(words[first:last]).encode()))
                    chosen.append((self.templates[number][0], first, last, different, min(1.0, -saved / size)))
        return sorted(chosen, key=lambda c: c[1])

    def _windows(self, words: list[str], low: int, high: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Templates with the parts ``(first word, word after the last)`` at one place that
        could be confirmed: as long as the template and the words that may differ, with all
        its words but those, beginning with one of them. Of parts that overlap, those with
        the most words in common."""
        places = defaultdict(list)
        for place in range(low, high):
            if words[place] in self.vocabulary:
                places[words[place]].append(place)
        for number, counts in enumerate(self.counts):
            length = len(self.templates[number][1])
            spare = may_differ = int(MOST_DIFFERENT * length)
            for word, wanted in counts:
                spare -= max(0, wanted - len(places.get(word, ())))
                if spare < 0:
                    break
            if spare < 0:
                continue
            wanted = dict(counts)
            at = sorted(p for word in wanted for p in places.get(word, ()))
            inside, common, end = Counter(), 0, 0
            most, parts = 0, []
            for begin, first in enumerate(at):
                while end < len(at) and at[end] < first + length + may_differ:
                    inside[words[at[end]]] += 1
                    common += inside[words[at[end]]] <= wanted[words[at[end]]]
                    end += 1
                if common >= length - may_differ:
                    if parts and first >= parts[0][0] + length - may_differ:
                        yield number, parts
                        most, parts = 0, []
                    if common > most:
                        most, parts = common, []
                    if common == most:
                        parts.append((first, at[end - 1] + 1))
                common -= inside[words[at[begin]]] <= wanted[words[at[begin]]]
                inside[words[at[begin]]] -= 1
            if parts:
                yield number, parts

    def _winner(self, words: list[str], low: int, high: int) -> tuple[str, int, int, int, float] | None:
        """The confirmed template with the fewest differing words among those that save
        about as much as the first one confirmed."""
        best, bound = None, 0.0
        for saving, number in self.savings(words[low:high]):
            if best and saving < bound:
                break
            confirmed = self._confirmed(words, low, high, number)
            if confirmed:
                different, first, last = confirmed
                bound = bound or saving - SIMILAR_SAVING
                if best is None or different < best[3]:
                    best = (self.templates[number][0], first, last, different, saving)
        return best

    def blocks(self, text: str) -> list[list[tuple[str, int, int]]]:
        """Runs of units that use the templates' words, as words with their places."""
        runs: list[list[tuple[str, int, int]]] = [[]]
        cued = False
        for unit in UNIT.finditer(text):
            words = [(m.group().lower(), unit.start() + m.start(), unit.start() + m.end()) for m in WORD.finditer(unit.group())]
            if not words:
                continue
            cue = bool(HAS_CUE.search(unit.group()))
            if cue or sum(w in self.vocabulary for w, _, _ in words) >= SHARED_WORDS * len(words):
                runs[-1] += words
                cued = cued or cue
            else:
                if not cued:
                    runs.pop()
                runs.append([])
                cued = False
        if not cued:
            runs.pop()
        return runs

    def in_text(self, text: str) -> list[dict]:
        found = []
        for block in self.blocks(text):
            for name, first, last, different, saving in self.in_words([w for w, _, _ in block]):
                found.append(
                    {
                        "license": name,
                        "start": block[first][1],
                        "end": block[last - 1][2],
                        "n_words": last - first,
                        "n_different": different,
                        "saving": round(saving, 4),
                    }
                )
        return found


@lru_cache(maxsize=1)
def finder() -> Finder:
    return Finder()


def scan_licenses(documents: DataFrame) -> DataFrame:
    """One row per licence found: ``doc_id, license, start, end`` (code points of its
    words), ``n_words, n_different`` (words unlike the template's), ``saving`` and
    ``exact``.

    Null and empty texts, and texts without a cue, have no rows. Ids may be null or
    repeat; each row is scanned by itself, whole, whatever its length. Of templates that
    differ in equally many words the one that saves more is the licence. An empty table
    gives an empty one. Other columns, also ones named like the result's, are not read.
    """
    kind = "license string, start bigint, end bigint, n_words bigint, n_different bigint, saving double"

    def make():
        own = finder()
        row = pa.struct(
            [("license", pa.string()), *[(n, pa.int64()) for n in ("start", "end", "n_words", "n_different")], ("saving", pa.float64())]
        )

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [own.in_text(t) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(row))], ["doc_id", "found"])

        return run

    text = F.col("text").cast("string")
    source = documents.select("doc_id", text.alias("text")).where(text.rlike(f"(?i){CUE}"))
    id_type = documents.schema["doc_id"].dataType.simpleString()
    fields = ",".join(f.replace(" ", ":") for f in kind.split(", "))
    found = by_batch(source, make, f"doc_id {id_type}, found array<struct<{fields}>>")
    return found.select("doc_id", F.inline("found")).withColumn("exact", F.col("n_different") == 0)
