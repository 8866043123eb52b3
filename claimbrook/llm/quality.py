"""Quality by nearest-neighbour voting over labelled latent-semantic vectors.

A text's terms are hashed byte trigrams, hashed runs of four kinds of characters (letters,
capitals, digits, marks; equal neighbours count once) and buckets of its length and of how
often words come back. Logarithms of term counts, weighted by inverse document frequency,
are projected onto the leading singular directions of the labelled sample. Exact cosine
products, a block of documents at a time, find each text's NEIGHBOURS nearest labelled
vectors (all that tie with the last), and their labels vote with similarity ** POWER.

Whole texts are read, never prefixes. A null or empty text has only its length as a term; a
text with no positive similarity gets the sample's share of label 1, and without labelled
rows every score is 0.5. Repeated rows score alike, an empty table gives no rows, and other
columns are not read. A labelled key with several texts counts with its least text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bound of the training sample: documents of each label.
PER_LABEL = 1000
NEIGHBOURS = 9
POWER = 4
DIRECTIONS = 64
GRAMS = 2048
SHAPES = 1024
BUCKETS = 16
TERMS = GRAMS + SHAPES + 2 * BUCKETS + 32
BLOCK = 256
CHUNK = 1 << 20
FACTORS = np.random.default_rng(29).integers(0, 2**31, 4, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _kinds() -> np.ndarray:
    kinds = np.arange(256, dtype=np.uint8)
    for byte in range(256):
        mark = chr(byte)
        if byte >= 128 or "a" <= mark <= "z":
            kinds[byte] = ord("a")
        elif "A" <= mark <= "Z":
            kinds[byte] = ord("A")
        elif "0" <= mark <= "9":
            kinds[byte] = ord("0")
    return kinds


KINDS = _kinds()


def _hashed(codes: np.ndarray, width: int, size: int) -> np.ndarray:
    """How often each bucket of `size` holds a run of `width` codes."""
    total = np.zeros(size, dtype=np.int64)
    for at in range(0, len(codes) - width + 1, CHUNK):
        part = codes[at : at + CHUNK + width - 1].astype(np.uint32)
        mixed = np.zeros(len(part) - width + 1, dtype=np.uint32)
        for i in range(width):
            mixed ^= part[i : len(part) - width + 1 + i] * FACTORS[i]
        mixed ^= mixed >> np.uint32(15)
        mixed *= FACTORS[0]
        mixed ^= mixed >> np.uint32(13)
        total += np.bincount(mixed % np.uint32(size), minlength=size)
    return total


def terms(text: str | None) -> np.ndarray:
    """Term counts of a whole text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    shape = KINDS[raw]
    letters = (shape == ord("a")) | (shape == ord("A")) | (shape == ord("0"))
    if len(shape):
        shape = shape[np.append(True, (shape[1:] != shape[:-1]) | ~letters[1:])]
    words = text.split()
    repeats, buckets = np.zeros(2 * BUCKETS), np.zeros(32)
    if words:
        again = sum(a == b for gap in (1, 2, 3) for a, b in zip(words, words[gap:]))
        repeats[min(BUCKETS - 1, BUCKETS * again // len(words))] = len(words)
        repeats[BUCKETS + min(BUCKETS - 1, BUCKETS * len(set(words)) // len(words))] = len(words)
    buckets[min(31, len(words).bit_length())] = 1
    return np.concatenate([_hashed(raw, 3, GRAMS), _hashed(shape, 4, SHAPES), repeats, buckets])


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def weighted(counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * weight)


def train(counts: np.ndarray, labels: np.ndarray) -> dict | None:
    """Term weights, directions and the labelled vectors; None without rows."""
    if not len(labels):
        return None
    weight = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 0.1
    x = weighted(counts, weight)
    size, along = np.linalg.eigh(x @ x.T)
    leading = size > max(size[-1], 0) * 1e-9
    size, along = size[leading][-DIRECTIONS:], along[:, leading][:, -DIRECTIONS:]
    basis = x.T @ along / np.sqrt(size)
    return {"weight": weight, "basis": basis, "vectors": _unit(x @ basis), "labels": labels.astype(np.float64)}


def vote(similarity: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Score of each row of similarities to the labelled vectors."""
    k = min(NEIGHBOURS, len(labels))
    last = np.partition(similarity, len(labels) - k, axis=1)[:, len(labels) - k]
    weight = np.where(similarity >= last[:, None], np.maximum(similarity, 0.0), 0.0) ** POWER
    total = weight.sum(axis=1)
    return np.divide(weight @ labels, total, out=np.full(len(total), labels.mean()), where=total > 0)


def score_texts(model: dict | None, texts: list[str | None]) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    out = np.empty(len(texts))
    for at in range(0, len(texts), BLOCK):
        counts = np.stack([terms(t) for t in texts[at : at + BLOCK]])
        latent = _unit(weighted(counts, model["weight"]) @ model["basis"])
        out[at : at + BLOCK] = vote(np.round(latent @ model["vectors"].T, 9), model["labels"])
    return np.clip(np.round(out, 9), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> dict | None:
    """A model from labelled rows whose crc32(key as text) mod 3 is not 1.

    PER_LABEL documents of each label at most, by the order of a hash; their terms are counted
    in tasks, so the driver holds 2 * PER_LABEL sparse rows of at most TERMS numbers.
    """
    marks = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("y")).where(
        "y in (0, 1) and crc32(cast(id as string)) % 3 <> 1"
    ).distinct()
    chosen = [marks.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(PER_LABEL) for y in (0, 1)]
    named = docs.select(F.col(key).alias("id"), F.col(text).alias("t")).join(F.broadcast(chosen[0].union(chosen[1])), "id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [terms(t.as_py()) for t in batch.column(1)]
            used = [np.nonzero(r)[0].astype(np.int32) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(used, pa.list_(pa.int32())),
                    pa.array([r[u].astype(np.int64) for r, u in zip(rows, used)], pa.list_(pa.int64())),
                ],
                names=["y", "at", "n"],
            )

    one = named.groupBy("id", "y").agg(F.min("t").alias("t")).select("y", "t", "id")
    found = one.select("y", "t").mapInArrow(count, "y int, at array<int>, n array<long>").orderBy("y", "at", "n").collect()
    counts = np.zeros((len(found), TERMS))
    for row, r in zip(counts, found):
        row[r["at"]] = r["n"]
    return train(counts, np.array([r["y"] for r in found]))


def score(docs: DataFrame, model: dict | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                scores = score_texts(model, [None if t is None else str(t) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["k", "score"])

    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, score double").withColumnRenamed("k", key)
