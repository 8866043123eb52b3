"""License notices and texts: MinHash bands over text windows, then exact shingle containment.

Five-word shingles are hashed once. A window's sketch is one-permutation MinHash: hashes fall
into bins by their low bits, and the least hash of each bin is a band of one row (empty bins
make no band). Templates are sketched by windows of the same lengths, at every offset where a
template is longer. A window of the text retrieves the templates it shares a band with, and
only these are verified. LEVELS gives window, stride and bins for templates of 1, up to 7, up
to 255 and more shingles. Windows overlap by three quarters, so a notice shorter than a
window's first three quarters lies whole in one of them. With k shingles of the template among
w in the window and B bins, each is the least of its bin with a probability of about
(1 - exp(-x)) / x for x = (w - k) / B, so all bands miss with: 0 for one shingle, 6e-4 for two
of 8, 2e-5 for three, 4e-6 for 7 of 32 (eight less one), and (1 - J) ** 32 in a window of 256 of
Jaccard J, which is 1e-9 at the J of 0.48 that 0.65 shared shingles leave. Shingles of a text that are
in no template's sketch match no band, so only the bins of the others are looked at.

A notice or header counts if 0.8 or more of its shingles stand around a place retrieved, a whole
text if they stand in the document. Of headers, and of texts, that share half of their shingles
only the best covered count, such as one version of a license.

Null and empty texts hold no notice; texts of fewer than five words are one shingle, long ones
are scanned whole; repeated rows are scanned each; an empty table gives no rows; a column
`licenses` of the table is replaced, its others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimbrook.llm.license_table import HEADERS, bodies

SHINGLE = 5
STRIDE = 4
LEAST = 0.8
# Window, stride and bins, for templates of at least so many shingles.
LEVELS = [(1, 1, 1), (8, 2, 128), (32, 8, 64), (256, 64, 32)]
FROM = [1, 2, 8, 256]
# Usual short notices of public licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
}


def shingles(text: Column) -> Column:
    """Hashes of all five-word shingles, in order; fewer words are one shingle."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    empty = F.array().cast("array<bigint>")
    # The words are bound once, as the only element of an array.
    return F.flatten(
        F.transform(
            F.array(words),
            lambda w: F.when(F.size(w) == 0, empty).otherwise(
                F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - SHINGLE + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, F.lit(SHINGLE))))
            ),
        )
    )


def level_of(count: int) -> int:
    return sum(count >= least for least in FROM) - 1


def sketch(hashes: list[int], window: int, bins: int) -> set[int]:
    """The bands of all windows of a template: hashes that are the least of their bin in one.

    Such a hash has room for a window between the nearest smaller ones of its bin.
    """
    window = min(window, len(hashes))
    rows: dict[int, list[int]] = {}
    for at, h in enumerate(hashes):
        rows.setdefault(h & (bins - 1), []).append(at)
    out = set()
    for places in rows.values():
        for n, at in enumerate(places):
            left = next((p for p in reversed(places[:n]) if hashes[p] < hashes[at]), -1)
            right = next((p for p in places[n + 1 :] if hashes[p] < hashes[at]), len(hashes))
            if right - left - 1 >= window:
                out.add(hashes[at])
    return out


def _among(place: str, values: set[int]) -> str:
    return f"get(__shingles, {place} - 1) in ({','.join(f'{v}L' for v in sorted(values))})"


def _is_band(place: Column, window: int, stride: int, bins: int) -> Column:
    """Whether the hash at a place is a band of one of the text's windows that hold it."""
    all_ = F.col("__shingles")
    last = place - F.pmod(place - 1, F.lit(stride))
    first = F.greatest(last - (window - stride), F.lit(1))
    own = F.get(all_, place - 1)
    smaller = lambda x: (x.bitwiseAND(F.lit(bins - 1)) == own.bitwiseAND(F.lit(bins - 1))) & (x < own)
    return F.exists(F.sequence(first, last, F.lit(stride)), lambda s: ~F.exists(F.slice(all_, s, F.lit(window)), smaller))


def _set(values: list[int]) -> Column:
    """The values as one constant array, which is folded when the plan is made."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _rivals(sets: list[tuple[str, list[int]]]) -> list[list[int]]:
    """For each set the sets of other licenses that hold half of it."""
    return [
        [j for j, (other, b) in enumerate(sets) if other != name and 2 * len(set(a) & set(b)) >= len(a)]
        for name, a in sets
    ]


def find_licenses(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """`docs` with `licenses`, the names of what is found, each once: first the templates in
    their order, then, unless `templates` are given, headers and whole texts of others."""
    spark = docs.sparkSession
    given = list((templates or TEMPLATES).items())
    short, whole = (given, []) if templates else (given + HEADERS, bodies())
    # Hashes of the fixed texts, by the same expressions.
    rows = [(i, t) for i, (_, t) in enumerate(short + whole)]
    made = {
        r["i"]: r["s"]
        for r in spark.createDataFrame(rows, "i int, text string").select("i", shingles(F.col("text")).alias("s")).collect()
    }
    named = [(name, sorted(set(made[i]))) for i, (name, _) in enumerate(short + whole)]
    heads, texts = named[: len(short)], named[len(short) :]
    levels = [level_of(len(made[i])) for i in range(len(named))]
    bands = [sketch(made[i], LEVELS[at][0], LEVELS[at][2]) if made[i] else set() for i, at in enumerate(levels)]
    by_level = {at: set().union(*[bands[i] for i, n in enumerate(levels) if n == at]) for at in sorted(set(levels)) if at >= 0}

    all_ = F.col("__shingles")
    found = docs.withColumn("__shingles", shingles(F.col(text)))
    known = set().union(*by_level.values())
    hits = F.expr(f"filter(sequence(1, size(__shingles)), i -> {_among('i', known)})")
    found = found.withColumn("__hits", F.when(F.size(all_) > 0, hits).otherwise(F.array().cast("array<int>")))
    for at, keys in by_level.items():
        own = F.expr(f"filter(__hits, i -> {_among('i', keys)})")
        found = found.withColumn(f"__bands{at}", F.filter(own, lambda i: _is_band(i, *LEVELS[at])))

    def around(k: int) -> Column:
        """The most shingles of a notice that stand around a place that retrieves it."""
        wanted, span = _set(heads[k][1]), len(made[k]) + STRIDE
        own = F.filter(f"__bands{levels[k]}", lambda i: F.array_contains(_set(sorted(bands[k])), F.get(all_, i - 1)))
        places = F.array_distinct(F.transform(own, lambda i: i - F.pmod(i - 1, F.lit(STRIDE))))

        def count(i: Column) -> Column:
            start = F.greatest(i - span, F.lit(1))
            return F.size(F.array_intersect(F.slice(all_, start, i - start + span), wanted))

        return F.coalesce(F.array_max(F.transform(places, count)), F.lit(0)) / len(heads[k][1])

    none = lambda n: F.array_repeat(F.lit(0.0), n)
    usable = [k for k in range(len(heads)) if made[k]]
    shares = [around(k) if made[k] else F.lit(0.0) for k in range(len(heads))]
    any_head = F.lit(False)
    for at in sorted({levels[k] for k in usable}):
        any_head = any_head | (F.size(f"__bands{at}") > 0)
    found = found.withColumn("__heads", F.when(any_head, F.array(*shares)).otherwise(none(len(heads))))
    if texts:

        def inside(k: int) -> Column:
            i, (_, own) = len(short) + k, texts[k]
            keys = F.transform(f"__bands{levels[i]}", lambda p: F.get(all_, p - 1))
            retrieved = F.arrays_overlap(keys, _set(sorted(bands[i])))
            return F.when(retrieved, F.size(F.array_intersect(all_, _set(own))) / len(own)).otherwise(0.0)

        some = F.lit(False)
        for at in sorted(set(levels[len(short) :])):
            some = some | (F.size(f"__bands{at}") > 0)
        found = found.withColumn("__texts", F.when(some, F.array(*map(inside, range(len(texts))))).otherwise(none(len(texts))))

    def best(column: str, sets: list[tuple[str, list[int]]], first: int) -> list[Column]:
        """Names found; from the set `first` on, only where no rival is covered better."""
        share, rivals, out = F.col(column), _rivals(sets), []
        for k, (name, _) in enumerate(sets):
            held = share[k] >= LEAST
            if k >= first:
                for j in rivals[k]:
                    held = held & (share[j] <= share[k])
            out.append(F.when(held, F.lit(name)))
        return out

    names = best("__heads", heads, len(given)) + (best("__texts", texts, 0) if texts else [])
    return found.withColumn("licenses", F.array_distinct(F.array_compact(F.array(*names)))).drop(
        "__shingles", "__hits", "__heads", "__texts", *[f"__bands{at}" for at in by_level]
    )
