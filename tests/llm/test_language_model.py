import math
import zlib
from collections import Counter

import numpy as np
import pytest

from claimbrook.llm import language_model as lm


def test_elias_fano_round_trip():
    rng = np.random.default_rng(0)
    for n, top in [(0, 10), (1, 1), (5, 3), (1000, 100), (3000, 2**40), (500, 2**64 - 1)]:
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        ef = lm.EliasFano(values)
        assert (ef.get(np.arange(n)) == values).all()
        ask = np.concatenate([values, rng.integers(0, top, 200, dtype=np.uint64)])
        assert (ef.find(ask) == np.searchsorted(values, ask)).all() or not n


def test_trie_holds_predecessors():
    w, p = np.array([3, 3, 9], dtype=np.uint64), np.array([1, 7, 7], dtype=np.uint64)
    trie = lm.Trie(w, p, np.array([1, 2, 5]), {}, 10.0)
    assert trie.successors(3).tolist() == [1, 7] and trie.successors(4).tolist() == []


def test_lookup_searches_inside_a_words_pointers():
    rng = np.random.default_rng(2)
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 60, (900, 2))})
    w, p = (np.array(c, dtype=np.uint64) for c in zip(*pairs))
    trie = lm.Trie(w, p, rng.integers(1, 9, len(pairs)), {}, 100.0)
    place = {pair: i for i, pair in enumerate(pairs)}
    words, contexts = sorted({a for a, _ in pairs}), sorted({b for _, b in pairs})
    rank, context = (c.ravel() for c in np.meshgrid(np.arange(len(words)), np.arange(len(contexts))))
    want = [place.get((words[r], contexts[c]), -1) for r, c in zip(rank, context)]
    assert trie._below(rank, context).tolist() == want
    # With pointers that leave a word without children nothing is found below it.
    trie.pointers = lm.EliasFano(np.zeros(len(words) + 1, dtype=np.uint64))
    assert set(trie._below(rank, context).tolist()) == {-1}


def test_order_by_pair():
    rng = np.random.default_rng(4)
    w = rng.choice(np.array([1, 2, 1 << 40, (1 << 40) + 5, 1 << 63], dtype=np.uint64), 500)
    p = rng.choice(np.array([0, 7, 1 << 39, 1 << 41, (1 << 64) - 1], dtype=np.uint64), 500)
    got, want = lm.by_pair(w, p), np.lexsort((p, w))
    assert (w[got] == w[want]).all() and (p[got] == p[want]).all()


def brute(rows):
    tok = {i: [w for w in (t or "").encode().lower().split()] + [None] for i, (_, t) in enumerate(rows)}
    train = {i for i, (d, _) in enumerate(rows) if zlib.crc32(str(d).encode()) % 5 != 1}
    c, pair, ctx = Counter(), Counter(), Counter()
    for i in train:
        last = "begin"
        for w in tok[i]:
            c[w] += 1
            pair[last, w] += 1
            ctx[last] += 1
            last = w
    total, types = sum(c.values()), len(c)
    z = total + 0.5 * (types + 1)
    out = {}
    for i, (d, _) in enumerate(rows):
        base = score = known = 0
        last = "begin"
        for w in tok[i]:
            base += math.log10((c[w] + 0.5) / z)
            score += math.log10((pair[last, w] + lm.MU * (c[w] + 0.5) / z) / (ctx[last] + lm.MU))
            known += c[w] > 0
            last = w
        out.setdefault(d, []).append((len(tok[i]), known, total, round(base, 6), score))
    return out


@pytest.mark.parametrize("chunk", [60, 400_000])
def test_scores_match_brute_force(spark, chunk, monkeypatch):
    rng = np.random.default_rng(1)
    words = ["the"] * 30 + [f"w{k}é" for k in range(60)]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 80)))) for i in range(80)] + [(80, None), (81, ""), (82, "The \t w1É\n"), (82, "again")]
    monkeypatch.setattr(lm, "CHUNK", chunk)
    df = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, score double")
    got = {}
    for r in lm.score(df).collect():
        got.setdefault(r.doc_id, []).append(r)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    for d, want in brute(rows).items():
        mine = sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got[d])
        assert mine == sorted(x[:4] for x in want)
        for a, b in zip(sorted(r.score for r in got[d]), sorted(x[4] for x in want)):
            assert abs(a - b) < 0.002 * 80
    assert lm.score(df.where("false")).count() == 0
