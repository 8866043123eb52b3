"""Packing tokenised documents into windows by non-negative least squares.

Documents are cut at whole windows; what remains of each is an item. Shallow combinations
of lengths that fill a window get repeat counts fitted to the histogram of lengths; rounded
down they are the plan, and the few items left are packed greedily, largest first. The
plan depends on the histogram alone (at most `window` numbers); documents find their place
by their rank among the items of their length.

A null or empty text is one end token; repeated rows are packed each; an empty table gives
no rows; very long texts give many whole windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimbrook.llm.common import stage
from claimbrook.llm.tokens import byte_level, tokenizer_path

WINDOW = 2048
END = 1
FREQUENT = 64


def combinations(hist: np.ndarray, frequent: int = FREQUENT) -> np.ndarray:
    """Rows of two or three lengths (0: none) that sum to a full window."""
    window = len(hist) - 1
    have = np.nonzero(hist)[0]
    have = have[have < window]
    top = np.sort(have[np.argsort(-hist[have], kind="stable")[:frequent]])
    pairs = [(a, window - a, 0) for a in have if 2 * a <= window and hist[window - a]]
    triples = [
        tuple(sorted((a, b, window - a - b), reverse=True))
        for a in top for b in top if a <= b and a + b < window and hist[window - a - b]
    ]
    return np.array(sorted(set(pairs) | set(triples)), dtype=np.int64).reshape(-1, 3)


def repeats(hist: np.ndarray, rows: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative least squares by projected gradient: counts x with A x near hist."""
    x = np.zeros(len(rows))
    if not len(rows):
        return x.astype(np.int64)
    use = rows > 0
    per_length = np.bincount(rows[use], minlength=len(hist)).max()
    step = 1.0 / (3 * per_length)
    ahead, t = x.copy(), 1.0
    for _ in range(rounds):
        made = np.zeros(len(hist))
        np.add.at(made, rows[use], np.broadcast_to(ahead[:, None], rows.shape)[use])
        slope = np.where(use, (made - hist)[rows], 0.0).sum(axis=1)
        new = np.maximum(0.0, ahead - step * slope)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return np.floor(x).astype(np.int64)


def plan(hist: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, [(length, how many)]) patterns that use up `hist` (index: length) exactly."""
    window, left = len(hist) - 1, hist.astype(np.int64).copy()
    out: list[tuple[int, list[tuple[int, int]]]] = []

    def use(pattern: list[tuple[int, int]], times: int) -> None:
        for length, many in pattern:
            left[length] -= many * times
        out.append((times, pattern))

    if left[window]:
        use([(window, 1)], int(left[window]))
    rows = combinations(left)
    for row, times in zip(rows, repeats(left, rows)):
        lengths, many = np.unique(row[row > 0], return_counts=True)
        times = min(int(times), int((left[lengths] // many).min()))
        if times > 0:
            use([(int(n), int(m)) for n, m in zip(lengths[::-1], many[::-1])], times)
    while left.any():
        gap, pattern = window, []
        while gap:
            fits = np.nonzero(left[: gap + 1])[0]
            fits = fits[~np.isin(fits, [p[0] for p in pattern])]
            if not len(fits):
                break
            length = int(fits[-1])
            many = int(min(left[length], gap // length))
            pattern.append((length, many))
            gap -= many * length
        use(pattern, int(min(left[n] // m for n, m in pattern)))
    return out


def slots(hist: np.ndarray) -> np.ndarray:
    """Rows (length, first rank, how many a sequence, first sequence, offset), by length and rank."""
    used, base, out = np.zeros(len(hist), dtype=np.int64), 0, []
    for times, pattern in plan(hist):
        at = 0
        for length, many in pattern:
            out.append((length, used[length], many, base, at))
            used[length] += times * many
            at += length * many
        base += times
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, key: str, text: str, path: str, window: int) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        encoder = byte_level(path)
        for batch in batches:
            row, out = [], []
            for k, t in enumerate(batch.column(1)):
                ids = np.array([*encoder.ids(t.as_py() or ""), END], dtype="<u4")
                for at in range(0, len(ids), window):
                    cut = ids[at : at + window]
                    row.append(k)
                    out.append((at, len(cut), zlib.crc32(cut.tobytes()), len(ids)))
            numbers = np.array(out, dtype=np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *[pa.array(n) for n in numbers]],
                names=["id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select(F.col(key).alias("id"), F.col(text).alias("t")).mapInArrow(run, schema)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, window: int = WINDOW) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    Ranks are counted within written partitions and lengths, and the partitions' counts are
    summed, so that a length shared by many items is never ordered in one task.
    """
    cut = stage(
        pieces(docs, key, text, path or tokenizer_path(), window).withColumn("part", F.spark_partition_id()), "pieces"
    )
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    hist = np.zeros(window + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        hist[row["length"]] = row["n"]
    table = slots(hist)
    inner = Window.partitionBy("part", "length").orderBy("id", "start", "ids_crc32")
    ranked = (
        cut.withColumn("inner", F.row_number().over(inner) - 1)
        .join(counts.select("length", "part", "before"), ["length", "part"])
        .select("id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("inner")).alias("rank"))
    )

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = table[:, 0] * (1 << 44) + table[:, 1]
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            slot = table[np.searchsorted(marks, length * (1 << 44) + rank, side="right") - 1] if len(frame) else table[:0]
            nth = rank - slot[:, 1]
            out = frame.drop(columns="rank")
            out["sequence_id"] = slot[:, 3] + nth // slot[:, 2]
            out["offset"] = slot[:, 4] + nth % slot[:, 2] * length
            yield out

    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ranked.mapInPandas(place, schema).withColumnRenamed("id", key)
