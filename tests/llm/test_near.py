import numpy as np
import xxhash

from claimbrook.llm import simhash, vectors


def reach(nodes, linked):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def brute_print(text):
    words = (text or "").lower().split()
    sh = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def test_simhash_components(spark):
    rng = np.random.default_rng(1)
    base = [" ".join(rng.choice(["ab", "cd", "ef", "gh", "ij"], 60)) for _ in range(20)]
    texts = [None, "", "  \t", "one"] + base + [t + " x" for t in base] + [t.upper() for t in base]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(4, texts[4], 0)]
    out = simhash.digest(simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp long"))).collect()
    assert len(out) == len(rows)
    prints = {i: brute_print(t) for i, t in enumerate(texts)}
    pairs = [(i, j) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 4]
    low = reach(prints, pairs)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out} == {i: (f"{p:016x}", low[i]) for i, p in prints.items()}


def test_links_are_complete(spark):
    rng = np.random.default_rng(2)
    seeds = [int(x) for x in rng.integers(0, 2**63, 30)]
    prints = set(seeds)
    for s in seeds:
        for _ in range(8):
            flips = rng.choice(64, rng.integers(1, 7), replace=False)
            prints.add(s ^ sum(1 << int(b) for b in flips))
    signed = sorted(simhash._signed(p) for p in prints)
    got = [tuple(r) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()]
    want = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert sorted(got) == sorted(want)


def vec_rows():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((120, 16))
    near = x[:40] + 0.2 * rng.standard_normal((40, 16))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate([*x, *near, *x[:10], *x[:10]])]
    n = len(rows)
    return rows + [(n, None), (n + 1, [0.0] * 16), (n + 2, [float("nan")] * 16), (n + 3, [1.0, None]), (n + 4, []), (n + 5, [1.0, 2.0])]


def brute_cos(rows):
    good = {i: np.array(v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    return {
        (a, b): float((x * y).sum() / np.sqrt((x * x).sum()) / np.sqrt((y * y).sum()))
        for a, x in good.items() for b, y in good.items() if a != b and len(x) == len(y)
    }


def test_vector_duplicates(spark):
    rows = vec_rows()
    cos = brute_cos(rows)
    linked = [p for p, c in cos.items() if c >= 0.95]
    low = reach([r[0] for r in rows], linked)
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicate_vectors(df).collect()}
    assert got == {i: (sum(a == i for a, _ in linked), low[i], low[i] == i) for i, _ in rows}


def test_nearest_is_exact(spark):
    rows = vec_rows()
    cos = brute_cos(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in vectors.nearest(df, every=7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    want = {}
    for q in sorted({a for a, _ in cos if a % 7 == 0}):
        best = sorted(((-round(c, 12), b) for (a, b), c in cos.items() if a == q))[:5]
        if best:
            want[q] = [(b, round(-c, 9)) for c, b in best]
    assert got == want


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_duplicate_vectors(none).count() == 0
    assert vectors.nearest(none).count() == 0
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_norms_of_any_size_link(spark):
    """Parallel vectors, from the smallest components to the largest."""
    rows = [(i, [c, 0.0]) for i, c in enumerate([1e-200, 2e-200, 1e200, 1.0, 2.0, 5e-324, 1.7e308], 1)] + [(50, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicate_vectors(df).collect()}
    assert got == {i: (6, 1) for i in range(1, 8)} | {50: (0, 50)}
    best = vectors.nearest(df).orderBy("rank").collect()
    assert [r.vec_id for r in best] == [1, 2, 3, 4, 5] and all(abs(r.score - 0.5**0.5) < 1e-15 for r in best)


def test_repeated_and_null_keys(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.99, 0.01]), (3, [0.01, 0.99]), (None, [1.0, 0.0]), (3, [0.01, 0.99]), (4, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in vectors.near_duplicate_vectors(df).collect() if r.vec_id is not None)
    assert got == [
        (1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True),
    ]
    assert [tuple(r) for r in vectors.near_duplicate_vectors(df).where("vec_id is null").collect()] == [(None, 0, None, True)]
    # The least vector of a repeated query counts: [0, 1], next to 3.
    best = vectors.nearest(df, every=1).where("query_id = 1").orderBy("rank").collect()
    assert [r.vec_id for r in best] == [3, 2]
