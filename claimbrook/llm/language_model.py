"""A bigram model in Elias-Fano tries, one per shard of the vocabulary.

The model is P(w | p) = (c(p, w) + MU * P(w)) / (c(p) + MU), with P(w) the add-half unigram
estimate. Its logarithm falls into a part that needs the counts of w and of its predecessors
and a part that needs the count of p alone, and every p is itself a token of the text. So
one shuffle by word suffices: each shard counts its training pairs, stores them as a trie
(words, monotone pointers, predecessors of each word; quantised log probabilities) and scores
all pairs of all texts against it: a word's pointers bound its predecessors, and the one asked
for is searched inside them. Words that fill a large part of a shard are split by
predecessor, with their totals sent along.

Tokens go to the shards in one message for each chunk of texts and shard, and the sums of a
chunk's texts come back in one message each, so what moves is bounded by the tokens. The
number of distinct training words is exact: it is counted by shard first.

A null or empty text is the end token alone; repeated rows are scored each; without training
texts all counts are zero; an empty table gives no rows; very long texts are cut into several
messages, never truncated.
"""

from __future__ import annotations

import math
import mmap
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from claimbrook.llm.common import stage

MU = 200.0
CHUNK = 400_000
SHARD_BYTES = 12_000_000
LEAST_SHARDS = 8
SALTS = 16
LEVELS = 4096
END = xxhash.xxh64_intdigest(b"\n")
BEGIN = xxhash.xxh64_intdigest(b"\t")
TOTAL = xxhash.xxh64_intdigest(b" ")


# --- Elias-Fano -------------------------------------------------------------------------


def mapped(values: np.ndarray) -> np.ndarray:
    """The same values in a file of their own that is only mapped, and gone when unused."""
    if not values.nbytes:
        return values
    with tempfile.TemporaryFile() as file:
        file.write(np.ascontiguousarray(values).tobytes())
        file.flush()
        held = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    return np.frombuffer(held, dtype=values.dtype)


class EliasFano:
    """A non-decreasing sequence: packed low bits, and high bits in unary."""

    def __init__(self, values: np.ndarray) -> None:
        values = values.astype(np.uint64)
        self.n = len(values)
        top = int(values[-1]) + 1 if self.n else 1
        self.low_bits = max(0, (top // max(1, self.n)).bit_length() - 1)
        width, n = self.low_bits, self.n
        low = values & np.uint64((1 << width) - 1)
        packed = np.zeros((n * width + 7) // 8 + 16, dtype=np.uint8)
        if width:
            for at in range(0, n, 1 << 16):
                part = low[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(part, axis=1, bitorder="little")[:, :width].ravel()
                raw = np.packbits(bits, bitorder="little")
                start = at * width // 8
                packed[start : start + len(raw)] = raw
        self.low = mapped(packed)
        high = (values >> np.uint64(width)).astype(np.int64)
        self.buckets = int(high[-1]) + 1 if n else 0
        bits = np.zeros(((n + self.buckets + 64) // 64) * 64, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        self.high = mapped(words)
        self.ones = mapped(np.append(0, np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        at = i * self.low_bits
        byte, shift = at >> 3, (at & 7).astype(np.uint64)
        out = np.zeros(len(i), dtype=np.uint64)
        for k in range(8):
            out |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        out >>= shift
        over = self.low[byte + 8].astype(np.uint64)
        out |= np.where(shift > 0, over << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        return out & np.uint64((1 << self.low_bits) - 1)

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Position of the k-th (from 0) one or zero."""
        before = self.ones if one else np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.searchsorted(before, k, side="right") - 1
        rest = (k - before[word]).astype(np.int64)
        value = self.high[word] if one else ~self.high[word]
        place = np.zeros(len(k), dtype=np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            part = value & np.uint64((1 << width) - 1)
            ones = np.bitwise_count(part).astype(np.int64)
            go = rest >= ones
            rest -= np.where(go, ones, 0)
            place += np.where(go, width, 0)
            value = np.where(go, value >> np.uint64(width), part)
        return word * 64 + place

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, dtype=np.int64)
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(i)

    def find(self, key: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Index of the first element >= key (its successor), searched inside the key's bucket;
        with bounds, of the first such in [first, last), or last if there is none."""
        key = np.asarray(key, dtype=np.uint64)
        if not self.n or not len(key):
            return np.zeros(len(key), dtype=np.int64)
        high = (key >> np.uint64(self.low_bits)).astype(np.int64)
        far = high >= self.buckets
        high = np.minimum(high, self.buckets - 1)
        low = key & np.uint64((1 << self.low_bits) - 1)
        end = self._select(high, False) - high
        begin = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) - np.maximum(high - 1, 0), 0)
        lo, hi = begin, end.copy()
        if first is not None:
            lo, hi = np.clip(lo, first, last), np.clip(hi, first, last)
        while True:
            open_ = np.nonzero(lo < hi)[0]
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < low[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        return np.where(far, self.n if last is None else last, lo)


class Trie:
    """Words with quantised log10 parts, and below each the predecessors seen in training.

    Children are stored as word rank * contexts + context rank, which grows along the whole
    level, so a search for a predecessor stays relative to its word.
    """

    def __init__(self, w: np.ndarray, p: np.ndarray, n: np.ndarray, totals: dict[int, int], norm: float) -> None:
        """Distinct training pairs (w, p, n), sorted by (w, p); totals of the words split over shards."""
        words, start = np.unique(w, return_index=True)
        count = np.add.reduceat(n, start).astype(np.float64) if len(w) else np.zeros(0)
        if totals:
            extra = np.array(sorted(totals), dtype=np.uint64)
            both = np.union1d(words, extra)
            merged = np.zeros(len(both))
            merged[np.searchsorted(both, words)] = count
            merged[np.searchsorted(both, extra)] = [totals[int(x)] for x in extra]
            words, count = both, merged
        self.words = EliasFano(words)
        self.count = mapped(count.astype(np.float64))
        contexts = np.unique(p)
        self.contexts = EliasFano(contexts)
        rank = np.searchsorted(words, w)
        self.width = max(1, len(contexts))
        self.pointers = EliasFano(np.searchsorted(rank, np.arange(len(words) + 1)))
        self.children = EliasFano(rank.astype(np.uint64) * np.uint64(self.width) + np.searchsorted(contexts, p).astype(np.uint64))
        exact = np.log10(n + MU * (count[rank] + 0.5) / norm) if len(w) else np.zeros(0)
        # Quantised: the middle of 4096 equal steps between the least and the largest value.
        self.base = float(exact.min()) if len(w) else 0.0
        self.step = (float(exact.max()) - self.base) / (LEVELS - 1) or 1.0 if len(w) else 1.0
        self.code = mapped(np.rint((exact - self.base) / self.step).astype(np.uint16))
        self.norm = norm

    def lookup(self, w: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(training count of w, log10 of c(p, w) + MU * P(w)) of each pair."""
        rank = self._place(self.words, w)
        count = np.where(rank >= 0, self.count[np.maximum(rank, 0)], 0.0) if self.words.n else np.zeros(len(w))
        part = np.log10(MU * (count + 0.5) / self.norm)
        context = self._place(self.contexts, p)
        ask = np.nonzero((rank >= 0) & (context >= 0))[0]
        child = self._below(rank[ask], context[ask])
        inside = child >= 0
        part[ask[inside]] = self.base + self.step * self.code[child[inside]]
        return count, part

    def _below(self, rank: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Place of each context among the children that the pointers give its word; -1 if absent."""
        words, back = np.unique(rank, return_inverse=True)
        first, last = self.pointers.get(words).astype(np.int64)[back], self.pointers.get(words + 1).astype(np.int64)[back]
        key = rank.astype(np.uint64) * np.uint64(self.width) + context.astype(np.uint64)
        at = self.children.find(key, first, last)
        there = np.nonzero(at < last)[0]
        out = np.full(len(rank), -1)
        hit = there[self.children.get(at[there]) == key[there]]
        out[hit] = at[hit]
        return out

    def successors(self, w: int) -> np.ndarray:
        """The predecessors stored below a word, by its pointers."""
        rank = self._place(self.words, np.array([w], dtype=np.uint64))
        if rank[0] < 0:
            return np.zeros(0, dtype=np.uint64)
        lo, hi = self.pointers.get(np.array([rank[0], rank[0] + 1])).astype(np.int64)
        inner = self.children.get(np.arange(lo, hi)) - np.uint64(rank[0] * self.width)
        return self.contexts.get(inner.astype(np.int64))

    @staticmethod
    def _place(sequence: EliasFano, key: np.ndarray) -> np.ndarray:
        if not sequence.n:
            return np.full(len(key), -1)
        at = sequence.find(key)
        there = at < sequence.n
        hit = np.zeros(len(key), dtype=bool)
        hit[there] = sequence.get(at[there]) == key[there]
        return np.where(hit, at, -1)


# --- Spark ------------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list]]:
    """(first row id, row offsets, tokens, predecessors, begun) of at most about CHUNK tokens.

    The last bit of an offset marks a training row; `begun` has an Arrow slice (row id, key,
    training) for each row whose first token is in the chunk.
    """
    cache: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        rid, train, texts = batch.column(0).to_numpy(), batch.column(2).to_pylist(), batch.column(1)
        plain = pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), batch.column(2)], names=["rid", "k", "train"])
        rows, tokens, before, begun, held, base = [], [], [], [], 0, 0
        for k in range(len(batch)):
            words = (texts[k].as_py() or "").encode("utf-8", "replace").lower().split()
            if not held:
                base = int(rid[k])
            last = BEGIN
            begun.append(plain.slice(k, 1))
            for at in range(0, len(words) + 1, CHUNK):
                piece = words[at : at + CHUNK]
                for word in piece:
                    if word not in cache:
                        cache[word] = digest(word)
                ids = [cache[word] for word in piece]
                if at + CHUNK > len(words):
                    ids.append(END)
                ids = np.array(ids, dtype=np.uint64)
                tokens.append(ids)
                before.append(np.append(np.uint64(last), ids[:-1]))
                rows.append(np.full(len(ids), (int(rid[k]) - base) * 2 + int(bool(train[k])), dtype=np.uint32))
                last, held = int(ids[-1]), held + len(ids)
                if held >= CHUNK:
                    yield base, np.concatenate(rows), np.concatenate(tokens), np.concatenate(before), begun
                    rows, tokens, before, begun, held, cache, base = [], [], [], [], 0, {}, int(rid[k])
        if held:
            yield base, np.concatenate(rows), np.concatenate(tokens), np.concatenate(before), begun


def _survey(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Of each chunk: token counts (kinds 0, 3), frequent words (1), and for each shard its
    distinct training words (2)."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    names = ["part", "kind", "a", "b", "data"]
    for _, rows, tokens, _, _ in _chunks(batches):
        words, n = np.unique(tokens, return_counts=True)
        hot = n >= max(2, len(tokens) // 4096)
        train = np.unique(tokens[rows & 1 == 1])
        shard = train % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        used, first = np.unique(shard[order], return_index=True)
        parts = np.split(train[order], first[1:]) if len(used) else []
        # Differences of ascending hashes have their high bytes empty; byte planes compress well.
        data = [squeeze(np.diff(x, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()) for x in parts]
        kind = np.concatenate([np.full(hot.sum(), 1), np.full(len(used), 2), [0, 3]]).astype(np.int32)
        a = np.concatenate([words[hot].view(np.int64), used.astype(np.int64), [0, 0]])
        b = np.concatenate([n[hot], [len(x) for x in parts], [int((rows & 1).sum()), len(tokens)]])
        part = np.concatenate([words[hot] % np.uint64(shards), used, np.zeros(2, dtype=np.uint64)]).astype(np.int32)
        blobs = pa.array([None] * int(hot.sum()) + data + [None, None], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(kind), pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), blobs], names=names
        )


def _surveyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(kind, a, b) of a partition: counts and frequent words added up, and how many distinct
    training words its shards hold (kind 2)."""
    expand = zstandard.ZstdDecompressor().decompress
    held: dict[int, np.ndarray] = {}
    sums: Counter = Counter()
    for frame in frames:
        words = frame[frame["kind"] == 2]
        for shard, group in words.groupby("a"):
            parts = [np.cumsum(np.frombuffer(expand(d), np.uint8).reshape(8, -1).T.copy().view("<u8").ravel(), dtype=np.uint64) for d in group["data"]]
            held[shard] = np.unique(np.concatenate([*parts, held.get(shard, np.zeros(0, dtype=np.uint64))]))
        for kind, a, b in frame.loc[frame["kind"] != 2, ["kind", "a", "b"]].itertuples(index=False):
            sums[kind, a] += b
    rows = [(k, a, b) for (k, a), b in sums.items()] + [(2, 0, sum(map(len, held.values())))]
    yield pd.DataFrame(rows, columns=["kind", "a", "b"]).astype("int64")


def _within(values: np.ndarray, few: np.ndarray) -> np.ndarray:
    if not len(few):
        return np.zeros(len(values), dtype=bool)
    few = np.sort(few)
    return few[np.minimum(np.searchsorted(few, values), len(few) - 1)] == values


def by_pair(w: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The order of (w, p), from one sort by their leading bits and a repair where those tie."""
    key = (w >> np.uint64(24) << np.uint64(24)) | (p >> np.uint64(40))
    order = np.argsort(key)
    key, sw, sp = key[order], w[order], p[order]
    lead = key >> np.uint64(24)
    wrong = np.zeros(len(w), dtype=bool)
    for mark, value in ((lead, sw), (key, sp)):
        differ = np.nonzero((mark[1:] == mark[:-1]) & (value[1:] != value[:-1]))[0]
        if len(differ):
            hit = np.unique(mark[differ])
            wrong |= _within(mark, hit)
    at = np.nonzero(wrong)[0]
    order[at] = order[at][np.lexsort((sp[at], sw[at]))]
    return order


def _messages(batches: Iterator[pa.RecordBatch], shards: int, hot: np.ndarray, key: pa.DataType) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for base, rows, w, p, begun in _chunks(batches):
        if begun:
            # The rows themselves go along, to any shard, so that they are numbered once.
            own = pa.Table.from_batches(begun).combine_chunks()
            to = own["rid"].to_numpy() % shards
            blank = pa.nulls(len(own))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(to.astype(np.int32)), own["rid"].combine_chunks(), pa.array(np.zeros(len(own), dtype=np.int32)), blank.cast(pa.binary()),
                    own["k"].combine_chunks(), own["train"].combine_chunks(),
                ],
                names=MESSAGE,
            )
        is_hot = _within(w, hot)
        shard = (w + np.where(is_hot, p % np.uint64(SALTS) * np.uint64(0x9E3779B97F4A7C15), np.uint64(0))) % np.uint64(shards)
        # Totals of the split words go to every shard that holds a part of them.
        words, n = np.unique(w[is_hot & (rows & 1 == 1)], return_counts=True)
        many = np.repeat(words, SALTS)
        salt = np.tile(np.arange(SALTS, dtype=np.uint64), len(words))
        to = (many + salt * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)
        note = np.unique(np.stack([to, many], axis=1), axis=0) if len(many) else np.zeros((0, 2), dtype=np.uint64)
        count = n[np.searchsorted(words, note[:, 1])] if len(words) else np.zeros(0, dtype=np.int64)
        # Near enough in order of (shard, word, predecessor) for equal ones to meet and compress.
        bits = np.uint64(40 - int(shards).bit_length())
        order = np.argsort((shard << np.uint64(24) << bits) | (w >> (np.uint64(64) - bits) << np.uint64(24)) | (p >> np.uint64(40)))
        shard, w, p, rows = shard[order], w[order], p[order], rows[order]
        fresh = np.ones(len(w), dtype=bool)
        fresh[1:] = (w[1:] != w[:-1]) | (p[1:] != p[:-1]) | (rows[1:] != rows[:-1])
        start = np.nonzero(fresh)[0]
        times = np.diff(np.append(start, len(w)))
        shard, w, p, rows = shard[start], w[start], p[start], rows[start]
        cuts = np.append(np.nonzero(np.append(True, shard[1:] != shard[:-1]))[0], len(shard))
        out = []
        for a, b in zip(cuts, cuts[1:]):
            mine = note[:, 0] == shard[a]
            extra = int(mine.sum())
            data = (
                np.append(w[a:b], note[mine, 1]).astype("<u8").tobytes()
                + np.append(p[a:b], np.full(extra, TOTAL, dtype=np.uint64)).astype("<u8").tobytes()
                + np.append(rows[a:b], np.ones(extra, dtype=np.uint32)).astype("<u4").tobytes()
                + np.append(times[a:b], count[mine]).astype("<u4").tobytes()
            )
            out.append((int(shard[a]), base, b - a + extra, squeeze(data)))
        for s in np.setdiff1d(note[:, 0], shard):
            mine = note[:, 0] == s
            m = int(mine.sum())
            data = note[mine, 1].astype("<u8").tobytes() + np.full(m, TOTAL, "<u8").tobytes() + np.ones(m, "<u4").tobytes() + count[mine].astype("<u4").tobytes()
            out.append((int(s), base, m, squeeze(data)))
        columns = list(zip(*out))
        blank = pa.nulls(len(out))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.binary()),
                blank.cast(key), blank.cast(pa.bool_()),
            ],
            names=MESSAGE,
        )


MESSAGE = ["shard", "base", "m", "data", "k", "train"]
# What a shard answers for each row of a chunk: its offset (as a difference), tokens, known tokens,
# base and model sums. Columns are written byte by byte, as their high bytes are alike; the model's
# sums come from quantised values, so single precision adds nothing to their error.
ANSWER = ("<i4", "<i4", "<i4", "<f8", "<f4")


def _packed(columns: list[np.ndarray]) -> bytes:
    columns = [np.diff(columns[0], prepend=0), *columns[1:]]
    return b"".join(c.astype(t).view(np.uint8).reshape(len(c), -1).T.tobytes() for c, t in zip(columns, ANSWER))


def _unpacked(raw: bytes) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in ANSWER]
    m, at, out = len(raw) // sum(widths), 0, []
    for width, t in zip(widths, ANSWER):
        out.append(np.frombuffer(raw, np.uint8, m * width, at).reshape(width, m).T.copy().view(t).ravel())
        at += m * width
    return [np.cumsum(out[0]), *out[1:]]


def _answers(batches: Iterator[pa.RecordBatch], norm: float) -> Iterator[pa.RecordBatch]:
    """(base, data, k, train): for each chunk that asked the shards of a partition the sums of
    its rows, in one value; and the rows themselves as they came."""
    names, held = ["base", "data", "k", "train"], []
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        named = pc.is_null(batch.column("data"))
        yield batch.filter(named).select(names)
        held.append(batch.filter(pc.invert(named)).select(["shard", "base", "m", "data"]).to_pandas())
    if not held:
        return
    asked = pd.concat(held, ignore_index=True)
    del held
    for _, frame in asked.groupby("shard"):
        base, off, sums = _score_shard(frame, norm)
        cuts = np.nonzero(np.append(True, base[1:] != base[:-1]))[0] if len(base) else np.zeros(0, dtype=np.int64)
        for a, b in zip(cuts, np.append(cuts[1:], len(base))):
            data = squeeze(_packed([off[a:b], *sums[a:b].T]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(base[a])], pa.int64()), pa.array([data], pa.binary()), pa.nulls(1).cast(batch.schema.field("k").type), pa.nulls(1).cast(pa.bool_())],
                names=names,
            )


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, k, train, n, known, base, score): rows as they are, and sums of each chunk's rows.

    Chunks come sorted, so one chunk's answers are held at a time.
    """
    kind, expand = None, zstandard.ZstdDecompressor().decompress

    def summed(base: int, parts: list[bytes]) -> pa.RecordBatch:
        off, *values = (np.concatenate(c) for c in zip(*[_unpacked(expand(p)) for p in parts]))
        off, back = np.unique(off, return_inverse=True)
        sums = [np.bincount(back, weights=v) for v in values]
        blank = pa.nulls(len(off))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(base + off.astype(np.int64)), blank.cast(kind), blank.cast(pa.bool_()), pa.array(sums[0].astype(np.int64)),
                pa.array(sums[1].astype(np.int64)), pa.array(sums[2]), pa.array(sums[3]),
            ],
            names=TOTALS,
        )

    now, parts = None, []
    for batch in batches:
        kind = batch.schema.field("k").type
        named = pc.is_null(batch.column("data"))
        rows = batch.filter(named)
        zero = [pa.array(np.zeros(len(rows), dtype=t)) for t in (np.int64, np.int64, np.float64, np.float64)]
        yield pa.RecordBatch.from_arrays([rows.column("base"), rows.column("k"), rows.column("train"), *zero], names=TOTALS)
        rest = batch.filter(pc.invert(named))
        for base, data in zip(rest.column("base").to_pylist(), rest.column("data").to_pylist()):
            if base != now and parts:
                yield summed(now, parts)
                parts = []
            now = base
            parts.append(data)
    if parts:
        yield summed(now, parts)


TOTALS = ["rid", "k", "train", "n", "known", "base", "score"]


def _score_shard(frame: pd.DataFrame, norm: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, offset, sums of tokens, known ones, base and model scores), sorted by base and offset."""
    expand = zstandard.ZstdDecompressor().decompress
    m = frame["m"].to_numpy()
    ends = np.append(0, np.cumsum(m))
    total = int(ends[-1])
    w, p = np.empty(total, dtype="<u8"), np.empty(total, dtype="<u8")
    row, n = np.empty(total, dtype=np.int64), np.empty(total, dtype="<u4")
    bases, place = np.unique(frame["base"], return_inverse=True)
    for k, (at, size, data) in enumerate(zip(place, m, frame["data"])):
        raw, s = expand(data), slice(ends[k], ends[k + 1])
        w[s], p[s] = np.frombuffer(raw, "<u8", size), np.frombuffer(raw, "<u8", size, 8 * size)
        offset = np.frombuffer(raw, "<u4", size, 16 * size).astype(np.int64)
        row[s] = (int(at) << 33) + offset
        n[s] = np.frombuffer(raw, "<u4", size, 20 * size)
    note = p == TOTAL
    totals: dict[int, int] = Counter()
    for a, b in zip(w[note].tolist(), n[note].tolist()):
        totals[a] += b
    w, p, row, n = w[~note], p[~note], row[~note], n[~note]
    order = by_pair(w, p)
    w, p, row, n = w[order], p[order], row[order], n[order]
    first = np.ones(len(w), dtype=bool)
    first[1:] = (w[1:] != w[:-1]) | (p[1:] != p[:-1])
    start = np.nonzero(first)[0]
    pair_w, pair_p = w[start], p[start]
    learnt = np.add.reduceat(n * (row & 1), start) if len(start) else np.zeros(0, dtype=np.int64)
    seen = learnt > 0
    trie = Trie(pair_w[seen], pair_p[seen], learnt[seen], totals, norm)
    count, part = trie.lookup(pair_w, pair_p)
    pair = np.cumsum(first) - 1
    # As a context the token itself pays for c(p) + MU; the end token is never a context.
    owed = np.where(pair_w == np.uint64(END), 0.0, np.log10(count + MU))
    values = np.stack([np.ones(len(start)), count > 0, np.log10(count + 0.5), part - owed], axis=1)
    order = np.argsort(row)
    row, n, pair = row[order] >> 1, n[order], pair[order]
    at = np.nonzero(np.append(True, row[1:] != row[:-1]))[0] if len(row) else np.zeros(0, dtype=np.int64)
    sums = np.add.reduceat(values[pair] * n[:, None], at, axis=0) if len(row) else np.zeros((0, 4))
    row = row[at]
    return bases[row >> 32], row & 0xFFFFFFFF, sums


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows whose crc32(key as text) mod 5 is not 1 are learnt from.
    """
    held = F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 1, F.lit(False))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(text).alias("t"), (~held).alias("train"), F.col(key).alias("k"))
    size, texts_learnt = docs.agg(F.sum(F.octet_length(F.col(text))), F.count_if(~held)).first()
    shards = max(LEAST_SHARDS, math.ceil((size or 0) / SHARD_BYTES))
    survey = rows.mapInArrow(lambda b: _survey(b, shards), "part int, kind int, a long, b long, data binary")
    found = stage(survey.repartitionById(shards, "part").mapInPandas(_surveyed, "kind long, a long, b long"), "lm-survey")
    sums = {r["kind"]: r["b"] for r in found.where("kind <> 1").groupBy("kind").agg(F.sum("b").alias("b")).collect()}
    learnt, types, everything = (sums.get(k, 0) for k in (0, 2, 3))
    # At most 4 * shards words reach the share that makes them worth splitting.
    least = max(1, everything // (4 * shards))
    hot = np.array(
        [r["a"] for r in found.where("kind = 1").groupBy("a").agg(F.sum("b").alias("b")).where(F.col("b") >= least).collect()], dtype=np.int64
    ).view(np.uint64)
    norm = max(0.5, learnt + 0.5 * (types + 1))
    kind, arrow = docs.schema[key].dataType.simpleString(), to_arrow_type(docs.schema[key].dataType)
    asked = rows.mapInArrow(lambda b: _messages(b, shards, hot, arrow), f"shard int, base long, m int, data binary, k {kind}, train boolean")
    answered = asked.repartitionById(shards, "shard").mapInArrow(lambda b: _answers(b, norm), f"base long, data binary, k {kind}, train boolean")
    # Answers of one chunk meet and are added up; a long text's chunks are added up after that.
    chunks = answered.repartition(shards, "base").sortWithinPartitions("base")
    parts = chunks.mapInArrow(_totals, f"rid long, k {kind}, train boolean, n long, known long, base double, score double")
    done = parts.groupBy("rid").agg(
        F.max("k").alias("id"), F.max("train").alias("train"), *[F.sum(c).alias(c) for c in ("n", "known", "base", "score")]
    )
    begin, per_token = math.log10(texts_learnt + MU), math.log10(norm)
    return done.select(
        F.col("id").alias(key), (~F.col("train")).alias("held_out"), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(learnt).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n") * per_token).alias("base_score"),
        (F.col("score") - begin).alias("score"),
    )
