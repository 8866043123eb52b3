"""Bands against all shingles, and what settles versions of a license."""

import random
import re

import pytest

from claimbrook.llm import license_table, licenses

WORDS = [f"w{i}" for i in range(400)]
FSF = "under the terms of the GNU General Public License as published by the Free Software Foundation; version {}."


def grams(text):
    w = re.findall("[a-z0-9]+", text.lower())
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def planted():
    """Every notice and header within random words, some with words changed."""
    rng = random.Random(3)
    noise = lambda n: " ".join(rng.choices(WORDS, k=n))
    rows = []
    for name, text in list(licenses.TEMPLATES.items()) + license_table.HEADERS:
        for case in range(12):
            words = text.split()
            if case % 3 == 2:
                words[rng.randrange(len(words))] = "changed"
            rows.append((name, text, f"{noise(rng.randrange(90))} {' '.join(words)} {noise(rng.randrange(90))}"))
    return rows


def test_bands_miss_no_notice(spark):
    rows = planted()
    df = spark.createDataFrame([(i, r[2]) for i, r in enumerate(rows)], "doc_id int, text string")
    got = {r.doc_id: r.licenses for r in licenses.find_licenses(df).collect()}
    whole = 0
    for i, (name, text, doc) in enumerate(rows):
        own = set(grams(text))
        if len(own & set(grams(doc))) == len(own):
            whole += 1
            assert name in got[i], (name, doc)
    assert whole > 300


def test_given_templates_match_all_places(spark):
    """Own templates of 1 to 700 shingles; what the bands retrieve is all there is."""
    rng = random.Random(4)
    lengths = [5, 6, 7, 8, 11, 12, 20, 29, 30, 40, 100, 259, 260, 700]
    templates = {f"t{n}": " ".join(f"x{rng.randrange(10**6)}" for _ in range(n)) for n in lengths}
    rows = []
    for i in range(300):
        words = templates[f"t{rng.choice(lengths)}"].split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(rng.choices(WORDS, k=rng.randrange(400)) + words + rng.choices(WORDS, k=rng.randrange(400)))))
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: r.licenses for r in licenses.find_licenses(df, templates=templates).collect()}
    for i, doc in rows:
        have = set(grams(doc))
        want = [n for n, t in templates.items() if len(set(grams(t)) & have) >= 0.8 * len(set(grams(t)))]
        assert got[i] == want, i


def test_sketch_is_the_least_of_each_bin():
    rng = random.Random(5)
    for size, window, bins in [(1, 1, 1), (6, 8, 128), (40, 32, 64), (300, 32, 8), (300, 256, 32)]:
        hashes = [rng.randrange(-(2**63), 2**63) for _ in range(size)]
        want = set()
        for at in range(max(1, size - window + 1)):
            cut = hashes[at : at + window]
            want |= {min(h for h in cut if h % bins == b) for b in {h % bins for h in cut}}
        assert licenses.sketch(hashes, window, bins) == want


@pytest.mark.parametrize(
    "text, want",
    [
        (FSF.format(2), ["gpl-2.0"]),
        (FSF.format(3), ["gpl-3.0"]),
        ("Licensed under the Apache License 2.0", ["apache-2.0"]),
        ("# SPDX-License-Identifier: Apache-2.0", ["apache-2.0"]),
        ("// SPDX-License-Identifier: GPL-2.0-only", ["gpl-2.0"]),
        ("// SPDX-License-Identifier: LGPL-2.1-or-later", ["lgpl-2.1"]),
        ("Licensed under the EUPL, Version 1.2 or later", ["eupl-1.2"]),
        ("This is licensed under a Creative Commons Attribution 4.0 License.", ["cc-by-4.0"]),
        ("", []),
        (None, []),
        ("the Apache helicopter landed", []),
    ],
)
def test_notices(spark, text, want):
    df = spark.createDataFrame([(1, text, "old"), (1, text, None)], "doc_id int, text string, licenses string")
    assert [r.licenses for r in licenses.find_licenses(df).collect()] == [want, want]
