import pytest

from claimbrook.llm import license_table, licenses

GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
HEADERS = {
    GNU.format("", 2): ["gpl-2.0"],
    GNU.format("", 3): ["gpl-3.0"],
    GNU.format("Lesser ", 3): ["lgpl-3.0"],
    GNU.format("Affero ", 3): ["agpl-3.0"],
    GNU.format("", 2) + " word" * 90 + " " + GNU.format("", 3): ["gpl-2.0", "gpl-3.0"],
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.": ["isc"],
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["cc-by-sa-4.0"],
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": ["mpl-2.0"],
    "This is free and unencumbered software released into the public domain.": ["unlicense"],
    "Released under the MIT License": ["mit"],
    "a free program that anyone may use under the terms of the public library": [],
}


@pytest.fixture(scope="module")
def found(spark):
    # Whole texts without their first fifteenth and with a word changed now and then.
    cut = lambda t: [w if i % 60 else "changed" for i, w in enumerate(t.split())][len(t.split()) // 15 :]
    rows = [(t, "before it " + t + " and after") for t in HEADERS] + [(n, "x " * 500 + " ".join(cut(t))) for n, t in license_table.bodies()]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    return {r.doc_id: r.licenses for r in licenses.find_licenses(df).collect()}


@pytest.mark.parametrize("text", HEADERS)
def test_headers(found, text):
    assert found[text] == HEADERS[text]


@pytest.mark.parametrize("name", license_table.NAMES.values())
def test_whole_texts(found, name):
    assert name in found[name]
