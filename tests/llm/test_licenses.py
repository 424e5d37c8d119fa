"""License findings against a plain search over every stretch of every text."""

import random
import re

import pytest
from pyspark.sql import SparkSession

from runledger.llm.licenses import WORD, Scanner, WORDINGS, best_stretch, distances, find_licenses, spelled

COLUMNS = "doc_id long, text string, license string, start int, wording string"


@pytest.fixture(scope="module")
def spark():
    return SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_best_stretch_equals_every_stretch():
    pick = random.Random(3)
    for _ in range(150):
        pattern, words = pick.choices("abcd", k=pick.randint(1, 7)), pick.choices("abcd", k=pick.randint(1, 12))
        least, start, end = best_stretch(pattern, words)
        every = {(s, e): edits(pattern, words[s:e]) for e in range(1, len(words) + 1) for s in range(e)}
        assert every[start, end] == least == min(every.values())


def plain(text):
    return text.replace("{", "").replace("}", "")


def test_every_wording_is_found_in_prose():
    pick = random.Random(4)
    prose = ["".join(pick.choices("abdehnrst", k=6)) for _ in range(400)]
    scanner = Scanner()
    for name, text in WORDINGS:
        got = scanner.scan(" ".join(prose) + "\n" + plain(text).upper() + ".\n" + " ".join(prose))
        assert [(g[0], g[3]) for g in got] == [(name, 0)], name
        assert got[0][1:3] == (400, len(WORD.findall(plain(text))))


def test_rows(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    data = [(1, None), (2, ""), (3, f"prose\n{mit}"), (3, f"prose\n{mit}"), (4, f"{gpl} {mit} {gpl}"), (5, gpl.replace("work", "text")), (6, "mit der license of a reader, rights and duties"), (None, mit), (7, "x " * 200_000 + mit), (8, gpl.replace("3", "9")), (9, "license " * 3000)]
    got = find_licenses(spark.createDataFrame([(d, t, "x", 1, "y") for d, t in data], COLUMNS)).collect()
    short = sorted(((r["doc_id"] or 0, r["start"], r["license"], r["differences"]) for r in got))
    assert short == [(0, 0, "MIT", 0), (3, 1, "MIT", 0), (3, 1, "MIT", 0), (4, 0, "GPL-3.0", 0), (4, 12, "MIT", 0), (4, 17, "GPL-3.0", 0), (5, 0, "GPL-3.0", 1), (7, 200_000, "MIT", 0)]
    assert all(r["wording"] for r in got)
    assert find_licenses(spark.createDataFrame([], COLUMNS)).collect() == []


def test_planted_lines(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"] for r in find_licenses(docs).collect()}
    assert got == {r["doc_id"] for r in docs.filter("text rlike '(?i)licen[sc]e|all rights reserved'").collect()}


def test_spelling_versions_and_tags():
    scanner = Scanner()
    for text, name in [
        ("Released under the MIT Licence", "MIT"),
        ("Licenced under the Apache Licence, Version v2.0", "Apache-2.0"),
        ("This work is licensed under the GNU General Public License, version 3.0", "GPL-3.0"),
        ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
        ("SPDX-License-Identifier: AGPL-3.0-only", "AGPL-3.0"),
        ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "LGPL"),
    ]:
        assert [g[0] for g in scanner.scan(f"some prose {text} and more prose")] == [name], text
    assert scanner.scan("SPDX-License-Identifier: GPL-9.0-only") == scanner.scan("Released under the House License") == []


def test_as_many_edits_as_allowed_anywhere():
    """Any words but those in braces may be the edited ones, cues among them."""
    pick = random.Random(8)
    scanner = Scanner()
    for name, text in WORDINGS:
        n = len(WORD.findall(plain(text)))
        most = 0 if n < 4 else max(1, n // 7)
        spans = [m.span() for m in WORD.finditer(text)]
        free = [(a, b) for a, b in spans if not re.search(r"\{[^}]*$", text[:a])]
        longest = sorted(free, key=lambda ab: ab[0] - ab[1])[:most]
        for chosen in [longest, *(pick.sample(free, min(most, len(free))) for _ in range(5))]:
            edited = text
            for a, b in sorted(chosen, reverse=True):
                edited = edited[:a] + "qqq" + edited[b:]
            got = scanner.scan("before it " * 30 + plain(edited) + " after it" * 30)
            assert len(got) == 1 and got[0][3] <= len(chosen), (name, edited, got)


def test_filter_keeps_every_text_with_a_cue(spark):
    data = [(i, plain(t).upper().replace("LICENS", "LICENC"), "x", 1, "y") for i, (_, t) in enumerate(WORDINGS)]
    got = find_licenses(spark.createDataFrame(data, COLUMNS)).collect()
    assert {r["doc_id"] for r in got} == set(range(len(WORDINGS)))


def test_scan_equals_every_wording_aligned_with_every_text():
    """Whole texts, every wording, no cue and no compression: each wording within its edits overlaps a finding, and each finding is such a wording."""
    pick = random.Random(12)
    prose = ["".join(pick.choices("abdehnrst", k=5)) for _ in range(60)] + ["license", "software", "rights", "warranty", "the", "use", "copy"]
    scanner, n_found, n_matches = Scanner(), 0, 0
    for k in range(40):
        words = pick.choices(prose, k=80)
        for _ in range(k % 3):
            own = [w for w in WORD.findall(plain(pick.choice(WORDINGS)[1]))]
            for _ in range(pick.randint(0, 1 + len(own) // 6)):
                own[pick.randrange(len(own))] = pick.choice(prose)
            at = pick.randrange(len(words))
            words[at:at] = own
        text = " ".join(words)
        low = [spelled(w) for w in words]
        got = scanner.scan(text)
        matches = []
        for name, wording in WORDINGS:
            pattern = [spelled(w) for w in WORD.findall(wording)]
            marked = {spelled(w) for part in re.findall(r"\{(.*?)\}", wording) for w in WORD.findall(part)}
            most = 0 if len(pattern) < 4 else max(1, len(pattern) // 7)
            least, start, end = best_stretch(pattern, low)
            if least <= most and marked <= set(low[start:end]):
                matches.append((name, start, end))
        for name, start, n, least, *_ in got:
            of = [[spelled(w) for w in WORD.findall(t)] for m, t in WORDINGS if m == name]
            assert any(min(distances(p, low[start : start + n], True)) <= max(1, len(p) // 7) for p in of)
        for name, start, end in matches:
            assert any(s < end and start < s + n for _, s, n, *_ in got), (name, text)
        n_found, n_matches = n_found + len(got), n_matches + len(matches)
    assert n_found >= 20 and n_matches >= 20
