"""The pipeline's near duplicates come through SimHash first, and MinHash takes what it leaves apart."""

import numpy as np

import corpus_pipeline as cp
from claimbrook.llm import overlap, simhash


def long_texts(groups, copies):
    """Groups of long texts with a word changed, whose fingerprints stay within SimHash's bits."""
    rng = np.random.default_rng(6)
    texts = []
    for _ in range(groups):
        base = [f"w{i}" for i in rng.integers(0, 10**6, 3000)]
        for c in range(copies):
            texts.append(" ".join([*base[: 100 * c], f"x{c}", *base[100 * c + 1 :]]))
    return texts


def test_simhash_links_without_any_band(spark, monkeypatch):
    plain = overlap.bands
    monkeypatch.setattr(overlap, "bands", lambda distinct: ([], plain(distinct)[1]))
    texts = long_texts(4, 5) + ["", None, "one two", "one three"]
    prints = [simhash.fingerprint(t, 5) for t in texts[:20]]
    assert len(set(prints)) > 4 and all((prints[i] ^ prints[i // 5 * 5]).bit_count() <= 4 for i in range(20))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in overlap.near_duplicates(df).collect()}
    assert got == {i: i // 5 * 5 for i in range(20)} | {20: 20, 21: 20, 22: 22, 23: 23}
    assert sorted(r.doc_id for r in cp.drop_near_duplicates(spark, df, "").collect()) == [0, 5, 10, 15, 20, 22, 23]


def test_what_simhash_joined_is_not_compared_again(spark, monkeypatch):
    """A comparison for each class, though all fingerprints of a group link with each other."""
    compared, plain = [], overlap.similar
    monkeypatch.setattr(overlap, "similar", lambda pairs, held: compared.append(pairs.count()) or plain(pairs, held))
    df = spark.createDataFrame(list(enumerate(long_texts(3, 12))), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in overlap.near_duplicates(df).collect()}
    assert got == {i: i // 12 * 12 for i in range(36)}
    assert compared[0] >= 33 and sum(compared) <= 2 * 36


def test_close_fingerprints_of_unlike_texts_stay_apart(spark):
    """Two texts of one shingle repeated have the fingerprint of that shingle, whatever else they hold."""
    a = " ".join(["k"] * 60 + [f"a{i}" for i in range(40)])
    b = " ".join(["k"] * 60 + [f"b{i}" for i in range(40)])
    assert (simhash.fingerprint(a, 5) ^ simhash.fingerprint(b, 5)).bit_count() <= 4
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in overlap.near_duplicates(df).collect()} == {1: 1, 2: 2}
