import hashlib

import numpy as np
import pyarrow as pa

from claimbrook.llm import codes


def brute(rows, parts=16, entries=64, rounds=2):
    good = [(i, v, g) for i, v, g in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v, _ in good), default=0) // parts)
    from fractions import Fraction

    vec = []
    for _, v, _ in good:
        x = [int(Fraction(c) * 256 // 1) for c in v] + [0] * (parts * width - len(v))
        vec.append([x[p * width : (p + 1) * width] for p in range(parts)])
    books = [[v[p] for v in vec[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            hit = {}
            for v in vec:
                hit.setdefault(near(v[p], books[p])[1], []).append(v[p])
            books[p] = [[sum(c) // len(hit[e]) for c in zip(*hit[e])] if e in hit else b for e, b in enumerate(books[p])]
    out = []
    for (i, _, g), v in zip(good, vec):
        found = [near(v[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), g))
    total = {}
    for _, _, d, g in out:
        total[g] = total.get(g, 0) + d
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    return sorted(((i, c, d, total[g], sha) for i, c, d, g in out), key=key)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, error string")
    return sorted((tuple(r) for r in codes.digest(df).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def rows_of(n, width, seed, scale=0.5):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(c) for c in rng.standard_normal(width) * scale], int(i) % 3 if i % 7 else None) for i in rng.permutation(n)]


def test_codes_beside_brute_force(spark):
    rows = rows_of(150, 48, 1)
    rows += [rows[0], (rows[1][0], rows[2][1], 5), (900, None, 1), (901, [float("nan")] * 48, 1), (902, [1.0, None], 1), (903, [], 1)]
    rows += [(None, [0.25] * 48, 2), (904, [0.1] * 5, None), (905, [-0.0] * 48, 0)]
    assert got(spark, rows) == brute(rows)


def test_wide_values_stay_exact(spark):
    rows = rows_of(80, 32, 2, scale=3e6) + [(1000, [1e9, -1e9] * 16, None)]
    assert got(spark, rows) == brute(rows)


def test_extreme_values_saturate(spark):
    rows = rows_of(70, 16, 3) + [(1000, [1e300] + [0.0] * 15, 9), (1001, [4.25e21] + [0.0] * 15, 8)]
    last = got(spark, rows)[-2:]
    assert [r[0] for r in last] == [1000, 1001] and last[0][1] == last[1][1]
    assert {x for r in last for x in r[2:4]} == {codes.LARGEST}


def test_few_rows_and_none(spark):
    rows = rows_of(3, 20, 4)
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    assert [r[1:3] for r in got(spark, [(1, [], 0)])] == [("00" * 16, 0)]


def test_transform_orders_by_sign_changes():
    for n in (1, 2, 4, 8, 32):
        walsh = codes.transform(np.eye(n, dtype=np.int64)).T
        assert sorted((np.diff(np.sign(w)) != 0).sum() for w in walsh) == [(np.diff(np.sign(w)) != 0).sum() for w in walsh]
        assert (walsh @ walsh.T == n * np.eye(n)).all()


def test_nearest_breaks_ties_low():
    book = np.array([[5, 0, 0], [1, 1, 1], [1, 1, 1], [0, 5, 0]])
    index, far = codes.nearest_entries(np.array([[1, 1, 2], [5, 0, 0], [3, 3, 0]]), book)
    assert index.tolist() == [1, 0, 1] and far.tolist() == [1, 0, 9]


def test_matrix_pads():
    assert codes.matrix(pa.array([[0.5], [], [-0.001, 1.0]], pa.list_(pa.float64())), 1)[:, :2, 0].tolist() == [[128, 0], [0, 0], [-1, 256]]
