"""Alignment of two tokenizers' tokens by an associative composition of fragments.

Byte offsets where tokens of both end cut a text into groups. A fragment is any byte range of
the two token streams: an open head up to its first such offset, closed groups, and an open
tail after the last. `compose` joins neighbouring fragments and is associative, so fragments
of a very long document, cut at words, are made in many tasks and composed by a tree of
shuffles; other documents are one fragment each and are not moved.

Documents lie in blocks of bounded size. The distinct id pairs of a block are counted before
anything is shuffled, so a pair that every document holds costs a row per block; totals go
back to the blocks the same way.

Texts that are null, empty, or not given back byte for byte by both tokenizers have no tokens:
zeros and an empty digest. Each row is a document of its own, also repeated ones and those
with a null key; an empty table gives no rows; other columns are not read. Runs without a
space are never cut, so a text without any is one fragment.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimbrook.llm.common import stage
from claimbrook.llm.tokens import byte_level, pieces, tokenizer_path

CHUNK = 1 << 16
SLICE = 1 << 19
FAN = 8
BLOCK_PAIRS = 1 << 19
BLOCK_DOCS = 1024
WIDE = 4096
SHIFT = 20
LOW = (1 << SHIFT) - 1
# A space between two other characters: both tokenizers end a token before it.
SAFE = re.compile(r"(?<=\S) (?=\S)")


def chunks(text: str, size: int = CHUNK) -> list[str]:
    """The text with a space before it, cut before spaces at least `size` characters apart."""
    text, out, at = " " + text, [], 0
    while len(text) - at > size and (found := SAFE.search(text, at + size)):
        out.append(text[at : found.start()])
        at = found.start()
    return out + [text[at:]]


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def linked(a: np.ndarray, ga: np.ndarray, b: np.ndarray, gb: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """(owner, pair, times) of all pairs of tokens in the same group, sorted by owner and pair.

    `ga` and `gb` are the tokens' groups, ascending; `owner` is each group's document.
    """
    na, nb = np.bincount(ga, minlength=len(owner)), np.bincount(gb, minlength=len(owner))
    wide = na * nb > WIDE
    on = ~wide[ga]
    reach = nb[ga[on]]
    group, left = np.repeat(ga[on], reach), np.repeat(a[on].astype(np.int64), reach)
    right = b[np.repeat(_starts(nb)[ga[on]], reach) + np.arange(reach.sum()) - np.repeat(_starts(reach), reach)]
    who, pair, times = [owner[group]], [left << SHIFT | right], [np.ones(len(group), dtype=np.int64)]
    # A group of very many tokens is counted by its distinct ids.
    for g in np.nonzero(wide)[0]:
        x, nx = np.unique(a[ga == g], return_counts=True)
        y, ny = np.unique(b[gb == g], return_counts=True)
        pair.append((x.astype(np.int64)[:, None] << SHIFT | y).ravel())
        times.append((nx[:, None] * ny).ravel())
        who.append(np.full(len(x) * len(y), owner[g]))
    return summed(np.concatenate(who), np.concatenate(pair), np.concatenate(times))


def summed(who: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.lexsort((pair, who)) if len(who) and who.max() >= 1 << 62 - 2 * SHIFT else np.argsort(who << 2 * SHIFT | pair, kind="stable")
    who, pair, times = who[order], pair[order], times[order]
    first = np.nonzero(np.append(True, (who[1:] != who[:-1]) | (pair[1:] != pair[:-1])))[0] if len(who) else np.zeros(0, dtype=np.int64)
    return who[first], pair[first], np.add.reduceat(times, first) if len(first) else times


def _spelling() -> list[str]:
    return [f"{mark}{i}" for mark in ",|;" for i in range(1 << 17)]


_spelled: list[str] = []


def spell(a: np.ndarray, ga: np.ndarray, b: np.ndarray, gb: np.ndarray, cuts: np.ndarray) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of each document; `cuts` are the first groups of the documents after the first."""
    if not _spelled:
        _spelled.extend(_spelling())
    place = np.concatenate([ga * 2, gb * 2 + 1])
    order = np.argsort(place, kind="stable")
    place, ids = place[order], np.concatenate([a, b])[order]
    mark = np.where(np.append(-1, place[:-1]) == place, 0, np.where(place & 1, 1, 2))
    words = (mark * (1 << 17) + ids).tolist()
    edges = [0, *np.searchsorted(place, cuts * 2).tolist(), len(words)]
    return ["".join([_spelled[w] for w in words[i:j]])[1:] for i, j in zip(edges, edges[1:])]


@dataclass
class Fragment:
    """Tokens of a byte range: head, closed groups as digest text and pair counts, tail."""

    ok: bool = True
    n_a: int = 0
    n_b: int = 0
    ended: bool = False
    head_a: list[int] = field(default_factory=list)
    head_b: list[int] = field(default_factory=list)
    tail_a: list[int] = field(default_factory=list)
    tail_b: list[int] = field(default_factory=list)
    n_groups: int = 0
    n_links: int = 0
    spelled: str = ""
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))


def fragment(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Fragment:
    """A fragment of the tokens that end in some byte range."""
    a, b = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)
    both = np.intersect1d(a_ends, b_ends, assume_unique=True)
    ga, gb = np.searchsorted(both, a_ends), np.searchsorted(both, b_ends)
    out = Fragment(n_a=len(a), n_b=len(b), ended=len(both) > 0)
    out.head_a, out.head_b = a[ga == 0].tolist(), b[gb == 0].tolist()
    if not out.ended:
        return out
    out.tail_a, out.tail_b = a[ga == len(both)].tolist(), b[gb == len(both)].tolist()
    ka, kb = (ga > 0) & (ga < len(both)), (gb > 0) & (gb < len(both))
    return _closed(out, a[ka], ga[ka] - 1, b[kb], gb[kb] - 1, len(both) - 1)


def _closed(out: Fragment, a: np.ndarray, ga: np.ndarray, b: np.ndarray, gb: np.ndarray, groups: int) -> Fragment:
    if groups:
        _, out.pairs, out.times = linked(a, ga, b, gb, np.zeros(groups, dtype=np.int64))
        out.n_groups, out.n_links = groups, int(out.times.sum())
        out.spelled = spell(a, ga, b, gb, np.zeros(0, dtype=np.int64))[0]
    return out


def _group(a: list[int], b: list[int]) -> Fragment:
    zero = lambda x: np.zeros(len(x), dtype=np.int64)
    return _closed(Fragment(), np.array(a, dtype=np.int64), zero(a), np.array(b, dtype=np.int64), zero(b), 1)


def gathered(parts: list[Fragment]) -> Fragment:
    """Neighbouring fragments as one, from left to right; associative, with Fragment() as its one."""
    out = Fragment()
    closed: list[Fragment] = []
    for part in parts:
        out.ok, out.n_a, out.n_b = out.ok and part.ok, out.n_a + part.n_a, out.n_b + part.n_b
        if not out.ended:
            out.head_a, out.head_b = out.head_a + part.head_a, out.head_b + part.head_b
        elif part.ended:
            closed.append(_group(out.tail_a + part.head_a, out.tail_b + part.head_b))
            out.tail_a, out.tail_b = [], []
        else:
            out.tail_a, out.tail_b = out.tail_a + part.head_a, out.tail_b + part.head_b
        if part.ended:
            closed.append(part)
            out.ended, out.tail_a, out.tail_b = True, part.tail_a, part.tail_b
    closed = [c for c in closed if c.n_groups]
    if closed:
        out.n_groups, out.n_links = sum(c.n_groups for c in closed), sum(c.n_links for c in closed)
        out.spelled = ";".join(c.spelled for c in closed)
        pairs = np.concatenate([c.pairs for c in closed])
        _, out.pairs, out.times = summed(np.zeros(len(pairs), dtype=np.int64), pairs, np.concatenate([c.times for c in closed]))
    return out


def compose(left: Fragment, right: Fragment) -> Fragment:
    return gathered([left, right])


def whole(found: Fragment) -> Fragment:
    """The fragment of a whole document with its head closed; empty if bytes differed."""
    if not found.ok or not found.ended or found.tail_a or found.tail_b:
        return Fragment(ok=False)
    return gathered([Fragment(ended=True), found])


class Aligner:
    """Both tokenizers in a task."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = byte_level(path_a), pieces(path_b)
        self.length_a = np.array([len(x) for x in self.a.bytes])
        self.length_b = np.array([len(x) for x in self.b.bytes])

    def streams(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of texts that begin with a space; None where the bytes are not given back."""
        out: list = []
        for text, b in zip(texts, self.b.ids([t[1:] for t in texts])):
            a, raw = self.a.plain(text), text.encode("utf-8", "replace")
            same = b"".join([self.a.bytes[i] for i in a]) == raw and b"".join([self.b.bytes[i] for i in b]) == raw
            out.append((np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)) if same else None)
        return out

    def fragment(self, text: str) -> Fragment:
        found = self.streams([text])[0]
        if found is None:
            return Fragment(ok=False)
        a, b = found
        return fragment(a, np.cumsum(self.length_a[a]), b, np.cumsum(self.length_b[b]))

    def documents(self, texts: list[str | None]) -> dict[str, list]:
        """Counts, digest, pairs and times of whole texts, all of a slice at once."""
        out = {
            "n_a": np.zeros(len(texts), dtype=np.int64), "n_b": np.zeros(len(texts), dtype=np.int64),
            "n_groups": np.zeros(len(texts), dtype=np.int64), "n_links": np.zeros(len(texts), dtype=np.int64),
            "sha": [""] * len(texts), "pairs": [[]] * len(texts), "times": [[]] * len(texts),
        }
        full = [i for i, t in enumerate(texts) if t]
        good = [(i, s) for i, s in zip(full, self.streams([" " + texts[i] for i in full])) if s is not None]
        if not good:
            return out
        rows = np.array([i for i, _ in good])
        na, nb = np.array([len(s[0]) for _, s in good]), np.array([len(s[1]) for _, s in good])
        a, b = np.concatenate([s[0] for _, s in good]), np.concatenate([s[1] for _, s in good])
        a_ends, b_ends = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        both = np.intersect1d(a_ends, b_ends, assume_unique=True)
        ga, gb = np.searchsorted(both, a_ends), np.searchsorted(both, b_ends)
        # Documents end with a token of both, so each has groups of its own.
        first = np.append(0, np.searchsorted(both, a_ends[np.cumsum(na) - 1])[:-1] + 1)
        owner = np.repeat(np.arange(len(rows)), np.diff(np.append(first, len(both))))
        who, pair, times = linked(a, ga, b, gb, owner)
        edges = np.searchsorted(who, np.arange(len(rows) + 1))
        out["n_a"][rows], out["n_b"][rows] = na, nb
        out["n_groups"][rows] = np.bincount(owner, minlength=len(rows))
        out["n_links"][rows] = np.add.reduceat(times, edges[:-1])
        for k, (i, text) in enumerate(zip(rows.tolist(), spell(a, ga, b, gb, first[1:]))):
            out["sha"][i] = hashlib.sha256(text.encode()).hexdigest()
            out["pairs"][i], out["times"][i] = pair[edges[k] : edges[k + 1]], times[edges[k] : edges[k + 1]]
        return out


COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
NAMES = ["block", "k", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
PARTIAL = "uid long, at long, k {kind}, ok boolean, n_a long, n_b long, ended boolean, head_a array<long>, head_b array<long>, tail_a array<long>, tail_b array<long>, n_groups long, n_links long, spelled string, pairs array<long>, times array<long>"
FIELDS = [c.split()[0] for c in PARTIAL.split(", ")[3:]]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with a bounded number of characters, one row at least."""
    sizes = np.cumsum([0 if t is None else t for t in pc.binary_length(batch.column(column)).to_pylist()])
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _fragments(frame: pd.DataFrame) -> list[Fragment]:
    return [
        Fragment(**{n: getattr(r, n).tolist() if n[:4] in ("head", "tail") else getattr(r, n) for n in FIELDS}) for r in frame.itertuples()
    ]


def aligned(docs: DataFrame, key: str, text: str, path_a: str, path_b: str, size: int = CHUNK) -> DataFrame:
    """(block, k, counts, groups_sha256, pairs, times) of every row, written to the shared folder."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    # Only white space decides where to cut, so both tokenizers must stop there.
    long = F.coalesce(F.char_length("t") > size, F.lit(False))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        block, held, many = TaskContext.get().partitionId() << 24, 0, 0
        for batch in batches:
            for part in _slices(batch, 1):
                found = aligner.documents(part.column(1).to_pylist())
                held, many = held + sum(map(len, found["pairs"])), many + len(part)
                arrays = [pa.array(np.full(len(part), block)), part.column(0)]
                arrays += [pa.array(found[n]) for n in ("n_a", "n_b", "n_groups", "n_links")] + [pa.array(found["sha"], pa.string())]
                arrays += [pa.array(found[n], pa.list_(pa.int64())) for n in ("pairs", "times")]
                yield pa.RecordBatch.from_arrays(arrays, names=NAMES)
                if held >= BLOCK_PAIRS or many >= BLOCK_DOCS:
                    block, held, many = block + 1, 0, 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        can = aligner.a.cuttable and aligner.b.cuttable
        uid = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, whole_text in enumerate(batch.column(1)):
                parts = chunks(whole_text.as_py(), size) if can else [" " + whole_text.as_py()]
                for at in range(0, len(parts), 64):
                    few = parts[at : at + 64]
                    ids = [pa.array([uid] * len(few)), pa.array(np.arange(at, at + len(few)))]
                    keys = pa.concat_arrays([batch.column(0).slice(i, 1)] * len(few))
                    yield pa.RecordBatch.from_arrays([*ids, keys, pa.array(few, pa.string())], names=["uid", "at", "k", "t"])
                uid += 1

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(path_a, path_b)
        for frame in frames:
            for r in frame.itertuples():
                yield as_frame(r.uid, r.at, frame["k"].iloc[r.Index : r.Index + 1], aligner.fragment(r.t))

    def as_frame(uid: int, at: int, keys: pd.Series, found: Fragment) -> pd.DataFrame:
        row = {"uid": [uid], "at": [at], "k": keys.to_numpy()} | {n: [getattr(found, n)] for n in FIELDS}
        return pd.DataFrame(row)

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at")
        return as_frame(frame["uid"].iloc[0], frame["at"].iloc[0] // FAN, frame["k"].iloc[:1], gathered(_fragments(frame)))

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i, found in enumerate(map(whole, _fragments(frame))):
                sha = hashlib.sha256(found.spelled.encode()).hexdigest() if found.n_a else ""
                row = {n: [getattr(found, n)] for n in ("n_a", "n_b", "n_groups", "n_links", "pairs", "times")}
                named = {"block": [-1 - frame["uid"].iloc[i]], "k": frame["k"].iloc[i : i + 1].to_numpy(), "groups_sha256": [sha]} | row
                yield pd.DataFrame(named)[NAMES]

    schema = f"block long, k {kind}, {COLUMNS}"
    pieces_ = stage(rows.where(long).mapInArrow(cut, f"uid long, at long, k {kind}, t string"), "align-chunks")
    last = pieces_.agg(F.max("at")).first()[0]
    most = rows.where(~long).mapInArrow(short, schema)
    if last is None:
        return stage(most, "aligned")
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tree = pieces_.repartition(spread, "uid", "at").mapInPandas(partial, PARTIAL.format(kind=kind))
    while last > 0:
        tree = tree.groupBy("uid", F.expr(f"at div {FAN}")).applyInPandas(join, PARTIAL.format(kind=kind))
        last //= FAN
    return stage(most.unionByName(tree.mapInPandas(finish, schema)), "aligned")


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    found = aligned(docs, key, text, path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model"))
    held = stage(found.select("block", F.explode("pairs").alias("pair")).groupBy("block", "pair").agg(F.count("*").alias("docs")), "align-pairs")
    counts = held.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", SHIFT))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    rated = stage(
        counts.join(highest, "a").select(F.col("pair").alias("of"), "count", (F.col("count") == F.col("highest")).alias("best")), "align-counts"
    )
    back = held.join(rated, F.col("pair") == F.col("of")).select("block", "pair", "count", "best")
    kind = docs.schema[key].dataType.simpleString()

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        order = np.argsort(right["pair"].to_numpy())
        pair, count, best = (right[c].to_numpy()[order] for c in ("pair", "count", "best"))
        sizes = pc.list_value_length(left["pairs"]).to_numpy()
        at = np.searchsorted(pair, pc.list_flatten(left["pairs"]).to_numpy())
        times = pc.list_flatten(left["times"]).to_numpy()
        ends = np.append(0, np.cumsum(sizes))
        sums = [np.append(0, np.cumsum(x))[ends] for x in (times * best[at], times * count[at])]
        out = left.select([n for n in NAMES if n not in ("block", "pairs", "times")])
        return out.append_column("n_best", pa.array(np.diff(sums[0]))).append_column("count_sum", pa.array(np.diff(sums[1])))

    schema = f"k {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    rows = found.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(total, schema)
    return rows.select(F.col("k").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
