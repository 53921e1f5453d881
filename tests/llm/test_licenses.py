"""Licences: every template in every surrounding, and what must not be taken for one."""

from __future__ import annotations

import random
import time

import pytest

from sensorstar.llm import license_scan

DOC = "doc_id long, text string, license string, start int, found string"
FINDER = license_scan.Finder()


def names(text):
    return [r["license"] for r in FINDER.in_text(text)]


@pytest.mark.parametrize("number", range(len(FINDER.templates)))
def test_every_template_in_every_surrounding(number):
    name, words = FINDER.templates[number]
    notice = " ".join(words) + "."
    spdx = notice.startswith("spdx")
    for before, after in (("", ""), ("Copyright 2020 the authors. All rights reserved.\n", "\nThe software has no warranty."), ("Hello there.\n", "\n\nBye.")):
        found = FINDER.in_text(before + notice + after)
        assert [r["license"] for r in found] == [name] and found[0]["n_different"] <= (1 if before else 0)
        assert (before + notice + after)[found[0]["start"] : found[0]["end"]].startswith(words[0][:4]) or spdx


@pytest.mark.parametrize("number", [n for n, (_, words) in enumerate(FINDER.templates) if len(words) > 30])
def test_changed_words_within_the_bound(number):
    """A few other words stay within the bound; more, or one that tells licences apart, do not."""
    name, words = FINDER.templates[number]
    rng = random.Random(number)
    free = [n for n, w in enumerate(words) if not license_scan._tells(w) and 2 < n < len(words) - 2]
    few, many = int(license_scan.MOST_DIFFERENT * len(words)), int(0.4 * len(words))
    for count, expected in ((few // 2, [name]), (many, [])):
        changed = list(words)
        for n in rng.sample(free, count):
            changed[n] = f"other{'x' * (n % 5)}"
        found = FINDER.in_text("Permission and licence: " + " ".join(changed))
        assert [r["license"] for r in found if r["n_words"] > 20] == expected


@pytest.mark.parametrize("text", [
    "Licensed under the Mozilla Public License, version 1.1.", "Licensed under the Apache License, Version 1.0.", "Apache License, Version 1.0",
    "This work is licensed under the GNU General Public License, version 1.", "This is not licensed under the MIT License.",
    "This isn't licensed under the MIT License.", "It is no longer released under the MIT License.", "Never distributed under the MIT License.",
    "Licensed under the Apache Software License.", "My driving license is old.", "Licensed under the BSD 5-Clause License.",
])
def test_other_versions_and_denials(text):
    assert names(text) == []


@pytest.mark.parametrize(("text", "expected"), [
    ("// SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"),
    ("Distributed under the MIT license.", "MIT"), ("The code is available under the terms of the MIT License", "MIT"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007", "GPL-3.0"), ("Licensed under the Eclipse Public License, version 2.0.", "EPL-2.0"),
    ("No warranty. Licensed under the MIT License.", "MIT"), ("It is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
])
def test_common_notices(text, expected):
    assert names(text) == [expected]


@pytest.mark.parametrize("mark", [" * ", "// ", "# ", "; ", "-- ", "> "])
def test_comment_marks(mark):
    for name, text in license_scan.TEXTS[:10]:
        words, lines = text.split(), []
        while words:
            lines.append(mark + " ".join(words[:9]))
            words = words[9:]
        assert names("/*\n" + "\n".join(lines) + "\n */") == [name]


def test_long_lists_of_notices():
    start = time.perf_counter()
    text = "\n".join(f"Released under the MIT License {n}." for n in range(4000))
    assert names(text) == ["MIT"] * 4000
    mixed = [license_scan.TEXTS[n % 10] for n in range(200)]
    assert names("\n\n".join(f"{text}\nFile {n}, Copyright {n} me." for n, (_, text) in enumerate(mixed))) == [name for name, _ in mixed]
    assert time.perf_counter() - start < 30


def test_awkward_rows(spark):
    text = "Released under the MIT License."
    rows = [(1, text, "clash", 1, "x"), (1, text, "clash", 1, "x"), (None, text, "clash", 1, "x"), (2, None, None, None, None), (3, "", None, None, None)]
    rows.append((4, "word " * 400_000 + "\n" + text, None, None, None))
    found = license_scan.scan_licenses(spark.createDataFrame(rows, DOC))
    assert found.columns == ["doc_id", "license", "start", "end", "n_words", "n_different", "saving", "exact"]
    got = [(r["doc_id"], r["license"], r["start"], r["end"], r["exact"]) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(1, "MIT", 0, 30, True), (1, "MIT", 0, 30, True), (None, "MIT", 0, 30, True), (4, "MIT", 2_000_001, 2_000_031, True)], key=str)
    assert license_scan.scan_licenses(spark.createDataFrame([], DOC)).count() == 0
