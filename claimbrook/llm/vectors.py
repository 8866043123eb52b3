"""Embeddings: reading, near-duplicates by quantised tiles, and neighbours on curves.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
rows with a null key. Vectors are scaled by a power of two before anything is squared, which
leaves cosines as they are and lets the largest and the smallest finite components take part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimbrook.llm.common import components, stage

BLOCK = 32768
BLOCK_BYTES = 1 << 27
LEAST_BLOCKS = 8
STEP = 1024


def _vectors(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(id, v array<double>, ok) of every row; -0.0 becomes 0.0."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    plain = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    ok = F.col(key).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(key).alias("id"), plain.alias("v"), F.coalesce(ok, F.lit(False)).alias("ok"))


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    return _vectors(vectors, key, column).where("ok").select("id", "v")


def unusable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    return _vectors(vectors, key, column).where("not ok").select("id", "v")


def stacked(values: np.ndarray) -> np.ndarray:
    """Vectors of one length as rows, each scaled so that its largest component is in [0.5, 1)."""
    x = np.stack(values)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows, in double precision, alike for equal rows wherever they stand."""
    a, b = np.ascontiguousarray(a), np.ascontiguousarray(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit rows, their scale, the norm of what they miss and their own norm.

    x = s * q + e, so x.y = s_x * s_y * (q_x.q_y) + e_x.(s_y q_y) + x.e_y, and the last two
    are at most |e_x| * |s_y q_y| + |e_y| by Cauchy-Schwarz.
    """
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, np.sqrt(((x - back) ** 2).sum(axis=1)) + 1e-12, np.sqrt((back**2).sum(axis=1)) + 1e-12


def linked_pairs(x: np.ndarray, y: np.ndarray, least: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with cosine >= least, one slice of the tile at a time.

    Products of int8 codes (sums stay below 2**24, so float32 products are exact) rule out
    most pairs; only those the error bounds leave open are computed in full precision.
    """
    ux = x / np.sqrt((x * x).sum(axis=1))[:, None]
    uy = y / np.sqrt((y * y).sum(axis=1))[:, None]
    qx, sx, ex, _ = quantise(ux)
    qy, sy, ey, ny = quantise(uy)
    width = 2**24 // (127 * 127)
    for i in range(0, len(x), STEP):
        for j in range(i if same else 0, len(y), STEP):
            a, b = slice(i, i + STEP), slice(j, j + STEP)
            product = sum(
                qx[a, k : k + width].astype(np.float32) @ qy[b, k : k + width].astype(np.float32).T
                for k in range(0, x.shape[1], width)
            )
            # The same test as product * sx * sy + bound >= least, arranged so that the tile is passed once.
            bound = ex[a].max() * ny[b].max() + ey[b].max()
            near = np.nonzero(product * sx[a, None].astype(np.float32) * sy[None, b].astype(np.float32) >= least - bound - 1e-4)
            r, c = near[0] + i, near[1] + j
            if same:
                r, c = r[r < c], c[r < c]
            if len(r):
                fine = product[r - i, c - j].astype(np.float64) * sx[r] * sy[c] + ex[r] * ny[c] + ey[c] >= least - 1e-9
                r, c = r[fine], c[fine]
            for at in range(0, len(r), 65536):
                p, q = r[at : at + 65536], c[at : at + 65536]
                ok = exact(x[p], y[q]) >= least
                if ok.any():
                    yield p[ok], q[ok]


def _forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> None:
    """Lower the labels of linked positions until both ends of every link agree."""
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def near_duplicate_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", least: float = 0.95) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Equal vectors form one class and are compared once. Classes are dealt into blocks of
    bounded size by a hash; every pair of blocks is one task's tile. A tile returns a link
    count per class and a spanning forest, never its pairs. Rows that take no part have
    no links and are their own component. Repeated keys keep a row each, linked by its own
    vector; a row with a null key has a null component and is kept. An empty table gives no
    rows; other columns are not read.
    """
    good = usable(vectors, key, column)
    classes = good.groupBy("v").agg(F.min("id").alias("low"), F.count("*").alias("w"))
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    count, longest = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    most = min(BLOCK, max(STEP, BLOCK_BYTES // (8 * (longest or 1))))
    blocks = max(LEAST_BLOCKS, math.ceil(count / most))
    dealt = classes.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    tiles = dealt.select("id", "w", "v", "block", other).select(
        "id", "w", "v", "block", F.least("block", "other").alias("r"), F.greatest("block", "other").alias("c")
    )

    def tile(rows: pd.DataFrame) -> pd.DataFrame:
        r, c = int(rows["r"].iloc[0]), int(rows["c"].iloc[0])
        ids, weight = rows["id"].to_numpy(), rows["w"].to_numpy()
        n, label = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
        sizes = rows["v"].map(len).to_numpy()
        side = rows["block"].to_numpy()
        # Vectors of different lengths never link.
        for size in np.unique(sizes):
            left = np.nonzero((side == r) & (sizes == size))[0]
            right = left if r == c else np.nonzero((side == c) & (sizes == size))[0]
            if not len(left) or not len(right):
                continue
            x = stacked(rows["v"].to_numpy()[left])
            y = x if r == c else stacked(rows["v"].to_numpy()[right])
            for p, q in linked_pairs(x, y, least, r == c):
                p, q = left[p], right[q]
                np.add.at(n, p, weight[q])
                np.add.at(n, q, weight[p])
                _forest(ids, p, q, label)
        hit = n > 0
        return pd.DataFrame({"id": ids[hit], "n": n[hit], "root": ids[label[hit]]})

    part = stage(tiles.groupBy("r", "c").applyInPandas(tile, "id long, n long, root long"), "vector-links")
    counts = part.groupBy("id").agg(F.sum("n").alias("n"))
    joined = components(part.select(F.col("id").alias("a"), F.col("root").alias("b")), "vector-components")
    # The class of a row is found again by a digest of its vector, which is narrower to move.
    mark = lambda c: F.sha2(F.to_json(F.struct(c)), 256)
    named = (
        classes.join(counts, "id", "left")
        .join(joined, classes["id"] == joined["node"], "left")
        .select(
            mark("v").alias("mark"), "low", (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("group"),
        )
    )
    lowest = named.groupBy("group").agg(F.min("low").alias("component_id"))
    by_mark = stage(named.join(lowest, "group").select("mark", "n_links", "component_id"), "vector-marks")
    rows = good.select("id", mark("v").alias("mark")).unionByName(
        unusable(vectors, key, column).select("id", F.lit(None).cast("string").alias("mark"))
    )
    return (
        rows.join(by_mark, "mark", "left")
        .select(
            F.col("id").alias(key),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
    )


# --- neighbours -------------------------------------------------------------------------

CURVES = 4
DIMS = 8
BITS = 7
WINDOW = 256
GROUP = 4096
TILE = 8192
SUB = 256


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows) below 2**bits per dimension.

    Skilling's transform: undo the excess rotations from the high bit down, Gray-encode,
    and interleave the bits.
    """
    x = points.astype(np.uint64).T.copy()
    dims = len(x)
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        p = q - np.uint64(1)
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(on, p, swap)
            x[i] ^= swap
        q >>= np.uint64(1)
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = np.uint64(1 << (bits - 1))
    while q > 1:
        t ^= np.where((x[-1] & q) != 0, q - np.uint64(1), np.uint64(0))
        q >>= np.uint64(1)
    x ^= t
    key = np.zeros_like(x[0])
    for bit in reversed(range(bits)):
        for i in range(dims):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(bit)) & np.uint64(1))
    return key.astype(np.int64)


def curve_keys(unit: np.ndarray, curve: int, seed: int = 7) -> np.ndarray:
    """Keys on one curve: its own projection of the unit vectors, and its own shift."""
    rng = np.random.default_rng([seed, curve, unit.shape[1]])
    basis = rng.standard_normal((unit.shape[1], DIMS))
    shift = rng.uniform(0, 0.25, DIMS)
    at = np.clip((unit @ basis) / 6 + 0.5 + shift, 0, 1 - 1e-9)
    return hilbert_key((at * (1 << BITS)).astype(np.int64))


def _best(q: np.ndarray, c: np.ndarray, score: np.ndarray, top: int) -> pd.DataFrame:
    """The `top` best of each query by (score down, id up), each candidate once."""
    found = pd.DataFrame({"q": q, "c": c, "score": score}).drop_duplicates(["q", "c"])
    return found.sort_values(["q", "score", "c"], ascending=[True, False, True]).groupby("q").head(top)


def nearest(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", every: int = 50, top: int = 5
) -> DataFrame:
    """(query_id, rank, key, score): the `top` nearest by cosine of the rows whose key is
    divisible by `every`, among all other rows; ties go to the smaller key.

    Rows are range-partitioned along several shifted Hilbert curves; each query meets the
    rows beside it on every curve, and the windows merge into a first list. Its last score
    is then a bound: runs of rows along a curve are checked against it by their centre and
    radius, and only those that may hold something nearer are reranked. The list is exact.
    Fewer candidates give fewer rows; without usable queries there are none. Vectors of
    different lengths are never compared. Of a key divisible by `every` that comes with several
    vectors the least one takes part; another key counts with the nearest of its vectors.
    An empty table gives no rows; other columns are not read.
    """
    every_row = usable(vectors, key, column)
    asked = F.col("id") % every == 0
    good = every_row.where(~asked).unionByName(every_row.where(asked).groupBy("id").agg(F.min("v").alias("v")))

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, rows in frame.groupby(frame["v"].map(len)):
                x = stacked(rows["v"].to_numpy())
                unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
                for curve in range(CURVES):
                    yield pd.DataFrame({"size": size, "curve": curve, "key": curve_keys(unit, curve), "id": rows["id"], "v": rows["v"]})

    def beside(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            rows = frame if held is None else pd.concat([held, frame], ignore_index=True)
            for _, run in rows.groupby(["size", "curve"], sort=False):
                asks = np.nonzero(run["id"].to_numpy() % every == 0)[0]
                ids, values = run["id"].to_numpy(), run["v"].to_numpy()
                for k in asks:
                    around = np.arange(max(0, k - WINDOW), min(len(run), k + WINDOW + 1))
                    around = around[ids[around] != ids[k]]
                    if len(around):
                        x = stacked(values[around])
                        score = exact(np.broadcast_to(stacked(values[k : k + 1]), x.shape), x)
                        order = np.lexsort((ids[around], -score))[:top]
                        yield pd.DataFrame({"q": ids[k], "c": ids[around][order], "score": score[order]})
            held = rows.iloc[-2 * WINDOW :]

    schema = "size int, curve int, key long, id long, v array<double>"
    along = good.mapInPandas(keyed, schema)
    parts = int(good.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = stage(
        along.repartitionByRange(parts, "size", "curve", "key", "id").sortWithinPartitions("size", "curve", "key", "id")
        .withColumn("part", F.spark_partition_id()),
        "curves",
    )
    windows = ordered.select("size", "curve", "key", "id", "v", "part")
    first = windows.mapInPandas(
        lambda frames: beside(f.sort_values(["part", "size", "curve", "key", "id"]) for f in frames), "q long, c long, score double"
    )
    rank = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    merged = first.distinct().withColumn("n", F.row_number().over(rank)).where(F.col("n") <= top)
    floor = merged.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("low")).select(
        "q", F.when(F.col("n") >= top, F.col("low")).otherwise(-2.0).alias("low")
    )

    asks = good.where(asked)
    asks = stage(
        asks.join(floor, asks["id"] == floor["q"], "left").select("id", "v", F.coalesce("low", F.lit(-2.0)).alias("low")), "asks"
    )
    groups = max(1, math.ceil(asks.count() / GROUP))
    asks = asks.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    # Runs of one curve are the tiles; within a tile rows are put in curve order again.
    rows = ordered.where("curve = 0").select("key", "id", "v", "part")
    many = max(LEAST_BLOCKS, math.ceil(rows.count() / TILE))
    spread = stage(
        rows.repartitionByRange(many, "key", "id").withColumn("t", F.spark_partition_id()).select("key", "id", "v", "t"), "runs"
    )
    tiles = spread.select(
        "t", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), "key", "id", "v", F.lit(None).cast("double").alias("low")
    ).unionByName(
        asks.select(F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("t"), "g", F.lit(None).cast("long").alias("key"), "id", "v", "low")
    )

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"q": pd.Series(dtype="int64"), "c": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})]
        sizes = rows["v"].map(len)
        for _, same in rows.groupby(sizes):
            q, c = same[same["low"].notna()], same[same["low"].isna()].sort_values(["key", "id"])
            if not len(q) or not len(c):
                continue
            qv, qi, low = stacked(q["v"].to_numpy()), q["id"].to_numpy(), q["low"].to_numpy().copy()
            qu = qv / np.sqrt((qv * qv).sum(axis=1))[:, None]
            cv, ci = stacked(c["v"].to_numpy()), c["id"].to_numpy()
            cu = cv / np.sqrt((cv * cv).sum(axis=1))[:, None]
            best = out[0]
            for at in range(0, len(c), SUB):
                unit = cu[at : at + SUB]
                centre = unit.mean(axis=0)
                radius = np.sqrt(((unit - centre) ** 2).sum(axis=1).max())
                live = np.nonzero(qu @ centre + radius >= low - 1e-9)[0]
                if not len(live):
                    continue
                r, k = np.nonzero(qu[live] @ unit.T >= low[live, None] - 1e-9)
                r, k = live[r], k + at
                r, k = r[qi[r] != ci[k]], k[qi[r] != ci[k]]
                if not len(r):
                    continue
                score = exact(qv[r], cv[k])
                best = _best(
                    np.concatenate([best["q"], qi[r]]), np.concatenate([best["c"], ci[k]]), np.concatenate([best["score"], score]), top
                )
                full = best.groupby("q")["score"].agg(["size", "min"])
                full = full[full["size"] >= top]["min"].reindex(qi).fillna(-2.0).to_numpy()
                low = np.maximum(low, full)
            out.append(best)
        return pd.concat(out, ignore_index=True)

    found = tiles.groupBy("t", "g").applyInPandas(search, "q long, c long, score double")
    last = found.unionByName(merged.select("q", "c", "score")).groupBy("q", "c").agg(F.max("score").alias("score"))
    return (
        last.withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= top)
        .select(F.col("q").alias("query_id"), "rank", F.col("c").alias(key), "score")
    )
