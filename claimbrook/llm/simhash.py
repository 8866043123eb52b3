"""SimHash near-duplicates: 64-bit fingerprints linked at a few differing bits.

Fingerprints are cut into segments on a ring. If two differ in at most `most` bits, some
start on the ring has every chain of l consecutive segments within l * most / segments
differences. With one segment more than `most`, that start's segment is equal and the
next one differs in at most one bit: this two-segment chain is the join key, the longer
chains prune the candidates, and a full comparison decides.

A null text counts as empty; texts without words have fingerprint zero and link like any
other; repeated rows and ties share a fingerprint and are compared once. An empty table
gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimbrook.llm.common import components, stage

SHINGLE = 4
SEED = 42
MOST = 4
CHUNK = 8192


def hashes(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The hash of every shingle, repeats included; none without words."""
    total = max(1, len(words) - shingle + 1) if words else 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    return np.fromiter((digest(join(words[i : i + shingle]), SEED) for i in range(total)), dtype="<u8", count=total)


def majority(found: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(found), CHUNK):
        part = found[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(found)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    return majority(hashes((text or "").encode("utf-8", "replace").lower().split(), shingle))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), dtype=np.uint64, count=len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["k", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, fp long").withColumnRenamed("k", key)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def ring(most: int = MOST) -> list[list[int]]:
    """Bit masks of most + 1 segments of near-equal width."""
    cuts = [64 * i // (most + 1) for i in range(most + 2)]
    return [list(range(a, b)) for a, b in zip(cuts, cuts[1:])]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def chain(diff: Column, start: int, segments: list[list[int]], most: int) -> Column:
    """All chains that begin at `start` keep within their proportional budgets."""
    held, mask, n = F.lit(True), 0, len(segments)
    for length in range(1, n + 1):
        mask |= _mask(segments[(start + length - 1) % n])
        held = held & (F.bit_count(diff.bitwiseAND(F.lit(_signed(mask)))) <= length * most // n)
    return held


def links(prints: DataFrame, most: int = MOST) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints `fp` at `most` or fewer differing bits.

    A pair is given by the first start on the ring whose chains hold, so it appears once.
    """
    segments = ring(most)
    n = len(segments)
    index, probe = [], []
    for i, segment in enumerate(segments):
        after = segments[(i + 1) % n]
        mask = F.lit(_signed(_mask(segment + after)))
        entry = lambda v, m=mask, i=i: F.struct(F.lit(i).alias("i"), v.bitwiseAND(m).alias("key"))
        index.append(entry(F.col("fp")))
        probe.append(entry(F.col("fp")))
        probe += [entry(F.col("fp").bitwiseXOR(F.lit(_signed(1 << bit)))) for bit in after]
    left = prints.select(F.col("fp").alias("a"), F.inline(F.array(*probe)))
    right = prints.select(F.col("fp").alias("b"), F.inline(F.array(*index)))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(n)
    for i in reversed(range(n)):
        first = F.when(chain(diff, i, segments, most), i).otherwise(first)
    return (
        left.join(right, ["i", "key"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(diff) <= most) & (F.col("i") == first))
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, most: int = MOST
) -> DataFrame:
    """(key, fp, component_id) of every row; component_id is the smallest key reachable."""
    found = stage(fingerprints(docs, key, text, shingle), "simhash")
    classes = stage(found.groupBy("fp").agg(F.min(key).alias("low")), "simhash-classes")
    joined = components(links(classes.select("fp"), most), "simhash-links")
    grouped = classes.join(joined, classes["fp"] == joined["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("group")
    )
    lowest = grouped.groupBy("group").agg(F.min("low").alias("component_id"))
    named = grouped.join(lowest, "group").select("fp", "component_id")
    return found.join(named, "fp").select(key, "fp", "component_id")
def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
