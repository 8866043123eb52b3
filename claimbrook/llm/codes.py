"""Product codes of vectors in integers, with codebooks fitted over all rows.

A component x becomes floor(256 * x); vectors are cut into PARTS equal consecutive parts,
each with a codebook of at most ENTRIES entries. The nearest entry is found through an
integer Walsh-Hadamard transform of the parts and entries, padded with zeros to a power of
two N: scaled squared differences add up, coefficient by coefficient in the order of their
number of sign changes, to N times the squared distance, so a running sum above the distance
of an entry already known rules its entry out. Nothing is rounded: sums that could leave 32
bits run in 64, and those that could leave 64 in Python integers.

Vectors that are null or hold a null or non-finite component are left out; an empty vector
is kept and counts as zeros, as do the components that a vector lacks to the longest length
rounded up to a multiple of PARTS. Null keys come after all others; rows with equal keys are
ordered by their vectors, and repeated rows keep a row each. Components beyond 2**80 in
magnitude count as that, and an error above the largest long is given as the largest long.
An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimbrook.llm.common import stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
FURTHEST = 2**80
LARGEST = 2**63 - 1
CELLS = 1 << 20


def kept(vectors: DataFrame, key: str, column: str, label: str | None) -> DataFrame:
    """(id, label, v array<double>) of the rows that are coded."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    mark = F.col(label) if label in vectors.columns else F.lit(None).cast("string")
    return vectors.select(F.col(key).alias("id"), mark.alias("label"), v.alias("v")).where(F.col("v").isNotNull() & ~bad)


def integers(values: np.ndarray) -> np.ndarray:
    """floor(256 * x), as int64 where all fit and as Python integers otherwise."""
    if not len(values) or np.abs(values).max() < 2.0**53:
        return np.floor(values * SCALE).astype(np.int64)
    whole = [int(np.floor(x * SCALE)) if abs(x) < 2.0**53 else int(x) * SCALE for x in values.tolist()]
    return np.array([max(-FURTHEST, min(FURTHEST, x)) for x in whole], dtype=object)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """(rows, PARTS, width) integers of an Arrow list column, with zeros where a vector ends early."""
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = integers(column.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((len(sizes), PARTS * width), dtype=flat.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out.reshape(len(sizes), PARTS, width)


def sequency(n: int) -> np.ndarray:
    """Rows of the n x n Hadamard matrix by their number of sign changes: bit-reversed Gray codes."""
    bits = n.bit_length() - 1
    return np.array([int(format(i ^ i >> 1, f"0{bits}b")[::-1] or "0", 2) if bits else 0 for i in range(n)])


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the rows of x, padded with zeros, by sequency."""
    n = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), n), dtype=x.dtype)
    y[:, : x.shape[1]] = x
    half = 1
    while half < n:
        pair = y.reshape(len(x), -1, 2, half)
        y = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return y[:, sequency(n)]


def nearest_entries(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest row of `book` and its squared distance; ties to the lower index."""
    if not x.shape[1]:
        return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
    n = 1 << (x.shape[1] - 1).bit_length()
    reach = max((int(np.abs(a).max()) for a in (x, book) if a.size), default=0)
    most = n * n * 4 * reach * reach
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    entries = transform(book.astype(kind))
    index, far = np.empty(len(x), dtype=np.int64), np.empty(len(x), dtype=object if kind is object else np.int64)
    step = max(1, CELLS // len(book))
    for at in range(0, len(x), step):
        rows = transform(x[at : at + step].astype(kind))
        part = rows[:, :1] - entries[:, 0]
        part = part * part
        # The entry that starts best is measured to its end; its sum is the one to beat.
        gap = rows - entries[np.argmin(part, axis=1)]
        bound = (gap * gap).sum(axis=1)
        r, e = np.nonzero(part <= bound[:, None])
        part = part[r, e]
        for j in range(1, n):
            gap = rows[r, j] - entries[e, j]
            part = part + gap * gap
            on = part <= bound[r]
            r, e, part = r[on], e[on], part[on]
        first = np.searchsorted(r, np.arange(len(rows)))
        best = np.minimum.reduceat(part, first)
        hit = part == best[r]
        r, e = r[hit], e[hit]
        index[at : at + step] = e[np.searchsorted(r, np.arange(len(rows)))]
        far[at : at + step] = best // n
    return index, far


def _decimals(values: np.ndarray) -> pa.Array:
    return pa.array([Decimal(int(x)) for x in values], pa.decimal128(38, 0))


def refit(rows: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """Every entry replaced by the floor of the mean of its parts; unused ones stay.

    A task returns one sum per (part, entry, position) that it met, so what is shuffled and
    collected is bounded by the number of tasks and of codebook components.
    """
    size = books.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, size, width), dtype=object)
        many = np.zeros((PARTS, size), dtype=np.int64)
        for batch in batches:
            x = matrix(batch.column(0), width)
            for p in range(PARTS):
                index, _ = nearest_entries(x[:, p], books[p])
                many[p] += np.bincount(index, minlength=size)
                order = np.argsort(index, kind="stable")
                used, first = np.unique(index[order], return_index=True)
                if len(used):
                    total[p, used] += np.add.reduceat(x[order, p], first, axis=0).astype(object)
        p, e, j = (a.ravel() for a in np.meshgrid(np.arange(PARTS), np.arange(size), np.arange(width), indexing="ij"))
        on = many[p, e] > 0
        p, e, j = p[on], e[on], j[on]
        names = ["p", "e", "j", "n", "total"]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()) for a in (p, e, j)] + [pa.array(many[p, e]), _decimals(total[p, e, j])], names=names)

    sums = rows.select("v").mapInArrow(run, "p int, e int, j int, n long, total decimal(38,0)")
    new = books.astype(object)
    for row in sums.groupBy("p", "e", "j").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        new[row["p"], row["e"], row["j"]] = int(row["total"]) // row["n"]
    return new


def compress(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str | None = "label", rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """((id, label, codes array<int>, error), final codebooks (PARTS, entries, width))."""
    rows = kept(vectors, key, column, label)
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // PARTS)
    first = rows.orderBy(F.asc_nulls_last("id"), "v").limit(ENTRIES).select("v").collect()
    start = matrix(pa.array([r["v"] for r in first], pa.list_(pa.float64())), width)
    books = np.transpose(start, (1, 0, 2)).astype(object)
    for _ in range(rounds if first else 0):
        books = refit(rows, books, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), width)
            codes = np.zeros((len(x), PARTS), dtype=np.int32)
            error = np.zeros(len(x), dtype=object)
            for p in range(PARTS):
                codes[:, p], far = nearest_entries(x[:, p], books[p])
                error = error + far.astype(object)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(list(codes), pa.list_(pa.int32())),
                    pa.array([min(int(e), LARGEST) for e in error], pa.int64()),
                ],
                names=["id", "label", "codes", "error"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error long"), books


def book_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()


def digest(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str | None = "label") -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every coded row."""
    found, books = compress(vectors, key, column, label)
    coded = stage(found, "codes")
    most = F.lit(LARGEST).cast("decimal(38,0)")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    hexed = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(key), F.array_join(hexed, "").alias("code"), "error", "label_error", F.lit(book_digest(books)).alias("codebooks_sha256")
    )


# The same over 64 entries and 16 parts, with w components to a part.
SQL = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) AS t(p)
), book0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, x FROM parts WHERE r <= 64
), near0 AS MATERIALIZED (
  SELECT a.r, a.p, min(list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + b.e) % 64 AS e
  FROM parts a JOIN book0 b ON a.p = b.p GROUP BY a.r, a.p
), mean0 AS (
  SELECT p, e, list(c ORDER BY j) AS x FROM (
    SELECT a.p, n.e, j, CAST(floor(sum(a.x[j]) / count(*)) AS BIGINT) AS c
    FROM parts a JOIN near0 n ON a.r = n.r AND a.p = n.p, unnest(range(1, len(a.x) + 1)) AS u(j) GROUP BY a.p, n.e, j
  ) GROUP BY p, e
), book1 AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book0 b LEFT JOIN mean0 m ON b.p = m.p AND b.e = m.e
), near1 AS MATERIALIZED (
  SELECT a.r, a.p, min(list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + b.e) % 64 AS e
  FROM parts a JOIN book1 b ON a.p = b.p GROUP BY a.r, a.p
), mean1 AS (
  SELECT p, e, list(c ORDER BY j) AS x FROM (
    SELECT a.p, n.e, j, CAST(floor(sum(a.x[j]) / count(*)) AS BIGINT) AS c
    FROM parts a JOIN near1 n ON a.r = n.r AND a.p = n.p, unnest(range(1, len(a.x) + 1)) AS u(j) GROUP BY a.p, n.e, j
  ) GROUP BY p, e
), book2 AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book1 b LEFT JOIN mean1 m ON b.p = m.p AND b.e = m.e
), near2 AS MATERIALIZED (
  SELECT a.r, a.p, min(list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 64 + b.e) AS m
  FROM parts a JOIN book2 b ON a.p = b.p GROUP BY a.r, a.p
), coded AS (
  SELECT r, string_agg(lpad(lower(hex(CAST(m % 64 AS BIGINT))), 2, '0'), '' ORDER BY p) AS code, CAST(sum(m // 64) AS BIGINT) AS error
  FROM near2 GROUP BY r
), books AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (r), books
"""
