"""Near-duplicate texts by SimHash, then by what lies beyond its bits, checked exactly.

Texts of the same words form one class. A link is an exact Jaccard similarity of 0.8 or more
of five-word shingles. SimHash fingerprints of these shingles name the first candidates:
classes of one fingerprint, and those whose fingerprints link along the ring of segments (see
`simhash`). A class is compared with the least of its fingerprint, and that one with the least
of the linked fingerprints, so a large group takes one comparison for each class.

A similarity of 0.8 often lies beyond SimHash's bits, so classes it leaves apart go on: 32
MinHash bands of 4 rows miss a pair of similarity 0.8 with a probability of
(1 - 0.8**4) ** 32 = 5e-8, and a more similar one still less often. Each class of a bucket is
compared, unless SimHash has joined them, with the one that shares
most buckets with others, which of a group of copies is the text they were made from; that
takes one comparison for each class of a bucket, however large it is. What is left in several components of a bucket goes through an exact
set join: classes are indexed by their rarest shingles, as many as two sets of similarity 0.8
cannot both be without, and only classes of fitting sizes, positions and components meet.
A sketch of fixed size orders shingles by how common they are; any order gives the same pairs.

Every candidate's 128 MinHash values are compared first: fewer than 75 equal ones in a pair of
similarity 0.8 have a probability of 1e-9. The others are checked exactly on their shingles.

Words are cut as for SimHash. A null text counts as empty, and texts without words are alike;
fewer than five words are one shingle; repeated rows are compared once; texts of any length are
read whole. An empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimbrook.llm import simhash
from claimbrook.llm.common import components, stage

SHINGLE = 5
LEAST = (4, 5)
BANDS = 32
ROWS = 4
CHUNK = 8192
PART = 256
EQUAL = 75
SLOTS = 1 << 18
FACTORS = np.random.default_rng(17).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def shingles(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the shingles, sorted."""
    return np.unique(simhash.hashes(words, shingle))


def bands(distinct: np.ndarray) -> tuple[list[int], bytes]:
    """A key of each band, and a byte of each MinHash value; none without shingles."""
    if not len(distinct):
        return [], b""
    low = np.full(len(FACTORS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(distinct), CHUNK):
        part = distinct[at : at + CHUNK]
        low = np.minimum(low, np.fromiter(((part * f).min() for f in FACTORS), dtype=np.uint64, count=len(FACTORS)))
    keys = [xxhash.xxh64_intdigest(low[b * ROWS : (b + 1) * ROWS].tobytes(), b) for b in range(BANDS)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist(), low.astype(np.uint8).tobytes()


def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What `marked` gives of batches (k, t), with the words of one text at a time."""
    for part in (b.slice(at, PART) for b in batches for at in range(0, len(b), PART)):
        own, prints, keys, signs = [], np.empty(len(part), dtype=np.uint64), [], []
        for i, t in enumerate(part.column(1)):
            words = words_of(t.as_py())
            every = simhash.hashes(words, SHINGLE)
            key, sign = bands(np.unique(every))
            own.append(xxhash.xxh3_128_digest(b" ".join(words)))
            prints[i] = simhash.majority(every)
            keys.append(key)
            signs.append(sign)
        columns = [pa.array(own, pa.binary()), pa.array(prints.view(np.int64)), pa.array(keys, pa.list_(pa.int64())), pa.array(signs, pa.binary())]
        yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["k", "mark", "fp", "keys", "sign"])


def marked(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, mark, fp, keys, sign) of every row; texts of the same words have the same mark."""
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(marks, f"k {kind}, mark binary, fp long, keys array<bigint>, sign binary")


def sets(texts: DataFrame) -> DataFrame:
    """(node, n, s) of (node, t): the shingle hashes and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                s = shingles(words_of(batch.column(1)[i].as_py())).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([len(s)], pa.int32()), pa.array([s], pa.list_(pa.int64()))], names=["node", "n", "s"]
                )

    return texts.mapInArrow(run, "node binary, n int, s array<bigint>")


def close(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that SimHash links, each class as b once at most; none without words."""
    worded = classes.where(F.length("sign") > 0).select("mark", "fp")
    least = worded.groupBy("fp").agg(F.min("mark").alias("hub"))
    same = worded.join(least, "fp").where("mark <> hub").select(F.col("hub").alias("a"), F.col("mark").alias("b"))
    nearest = simhash.links(least.select("fp")).groupBy("b").agg(F.min("a").alias("a"))
    side = lambda c: least.select(F.col("fp").alias(c), F.col("hub").alias(f"hub_{c}"))
    apart = nearest.join(side("a"), "a").join(side("b"), "b").select(F.col("hub_a").alias("a"), F.col("hub_b").alias("b"))
    return same.unionByName(apart)


def promising(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes with enough equal MinHash values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint8).reshape(-1, len(FACTORS)) for c in batch.columns[2:])
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= EQUAL))

    side = lambda c: signs.select(F.col("mark").alias(c), F.col("sign").alias(f"sign_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sign_a", "sign_b")
    return both.mapInArrow(run, "a binary, b binary")


def similar(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs (a, b) with a similarity of LEAST or more."""
    up, down = LEAST
    side = lambda c: held.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("s").alias(f"s_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return both.where(common * (up + down) >= (F.col("n_a") + F.col("n_b")) * up).select("a", "b")


def commonness(held: DataFrame) -> np.ndarray:
    """How many sets have a shingle in each of SLOTS slots: a sketch of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy().view(np.uint64) % np.uint64(SLOTS), minlength=SLOTS)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])

    out = np.zeros(SLOTS, dtype=np.int64)
    # At most SLOTS rows.
    for slot, n in held.select("s").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        out[slot] = n
    return out


def rarest(held: DataFrame, order: np.ndarray) -> DataFrame:
    """(shingle, node, n, at, indexed): the rarest shingles of each set, by position.

    Sets of sizes m <= n and a similarity of t have one of the n - ceil(t n) + 1 rarest of the
    larger among the m - ceil(2 t m / (1 + t)) + 1 rarest of the smaller; `indexed` marks these.
    """
    up, down = LEAST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                s = batch.column(2)[i].values.to_numpy()
                u = s.view(np.uint64)
                u = u[np.lexsort((u, order[(u % np.uint64(SLOTS)).astype(np.int64)]))]
                n = len(u)
                probes, index = n - -(-up * n // down) + 1, n - -(-2 * up * n // (up + down)) + 1
                at = np.arange(probes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(u[:probes].view(np.int64)), pa.array([batch.column(0)[i].as_py()] * probes, pa.binary()),
                        pa.array(np.full(probes, n, dtype=np.int32)), pa.array(at.astype(np.int32)), pa.array(at < index),
                    ],
                    names=["shingle", "node", "n", "at", "indexed"],
                )

    return held.select("node", "n", "s").mapInArrow(run, "shingle long, node binary, n int, at int, indexed boolean")


def meeting(rare: DataFrame, placed: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets in different components that may be similar by size and position."""
    up, down = LEAST
    rows = rare.join(placed, "node")
    left = rows.select("shingle", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), F.col("c").alias("c_a"))
    right = rows.where("indexed").select(
        "shingle", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), F.col("c").alias("c_b")
    )
    larger = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") > F.col("b")))
    fits = F.col("n_b") * down >= F.col("n_a") * up
    reach = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) * (up + down) >= (F.col("n_a") + F.col("n_b")) * up
    return left.join(right, "shingle").where((F.col("c_a") != F.col("c_b")) & larger & fits & reach).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, component_id) of every row with a key; component_id is the smallest key reachable."""
    docs = docs.where(F.col(key).isNotNull())
    found = stage(marked(docs, key, text), "overlap")
    classes = stage(
        found.groupBy("mark").agg(F.min("k").alias("low"), *(F.first(c).alias(c) for c in ("fp", "keys", "sign"))), "overlap-classes"
    )
    spread = classes.select(F.col("mark").alias("node"), F.explode("keys").alias("key"))
    many = spread.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = stage(spread.join(many, "key"), "overlap-buckets")
    signs = classes.select("mark", "sign")
    printed = stage(promising(close(classes), signs), "overlap-simhash")

    def named(nodes: DataFrame) -> DataFrame:
        """(node, n, s) of classes; rows of a key may differ, so a row's mark is found again."""
        wanted = classes.select(F.col("mark").alias("node"), "low").join(nodes, "node", "left_semi")
        rows = docs.select(F.col(key).alias("low"), F.col(text).alias("t")).join(wanted, "low").select("node", "t")

        def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = [xxhash.xxh3_128_digest(b" ".join(words_of(t.as_py()))) == m.as_py() for m, t in zip(batch.column(0), batch.column(1))]
                yield batch.filter(pa.array(hit, pa.bool_()))

        return sets(rows.mapInArrow(same, "node binary, t string").dropDuplicates(["node"]))

    nodes = shared.select("node").union(printed.select("a")).union(printed.select("b"))
    held = stage(named(nodes), "overlap-sets")
    joint = stage(similar(printed, held), "overlap-joint")
    # A class is b in one pair at most: two steps up from it lie classes that SimHash has joined with it.
    up = joint.select(F.col("b").alias("node"), F.col("a").alias("up"))
    top = up.join(up.select(F.col("node").alias("up"), F.col("up").alias("top")), "up", "left").select("node", F.coalesce("top", "up").alias("c"))
    apart = shared.join(top, "node", "left").select("node", "key", F.coalesce("c", "node").alias("c"))
    known = shared.groupBy("node").agg(F.sum("size").alias("met"))
    tops = apart.join(known, "node").groupBy("key").agg(F.max(F.struct("met", "node", "c")).alias("top"))
    hubs = apart.join(tops.select("key", F.col("top.node").alias("most"), F.col("top.c").alias("c_most")), "key").where("c <> c_most")
    stars = hubs.select(F.least("node", "most").alias("a"), F.greatest("node", "most").alias("b")).distinct()
    stars = stage(promising(stars, signs), "overlap-stars")
    links = stage(joint.unionByName(similar(stars, held)), "overlap-links")
    first = components(links, "overlap-first")
    placed = shared.join(first, "node", "left").select("node", "key", F.coalesce("component", "node").alias("c"))
    open_ = placed.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("key")
    left = stage(placed.join(open_, "key", "left_semi").select("node", "c").distinct(), "overlap-open")
    rest = held.join(left, "node", "left_semi")
    pairs = stage(promising(meeting(rarest(rest, commonness(rest)), left), signs), "overlap-rest")
    # The components so far stand for their links, so what is new takes few rounds.
    known = first.select(F.col("component").alias("a"), F.col("node").alias("b"))
    joined = components(known.unionByName(similar(pairs, held)), "overlap-all")

    grouped = classes.join(joined, classes["mark"] == joined["node"], "left").select(
        "mark", "low", F.coalesce("component", "mark").alias("group")
    )
    lowest = grouped.groupBy("group").agg(F.min("low").alias("component_id"))
    return found.join(grouped.join(lowest, "group").select("mark", "component_id"), "mark").select(F.col("k").alias(key), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of `docs` that are the first of their component; rows with a null key stay.

    Repeated rows with the same key all are the same document, and one of them stays.
    """
    kept = near_duplicates(docs, key, text).where(F.col(key) == F.col("component_id")).select(key).distinct()
    return docs.where(F.col(key).isNotNull()).dropDuplicates([key]).join(kept, key, "left_semi").unionByName(
        docs.where(F.col(key).isNull())
    ).select(docs.columns)
