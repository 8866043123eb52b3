import numpy as np

import corpus_pipeline as cp
from claimbrook.llm import overlap
from tests.llm.test_near import reach


def shingled(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def alike(a, b):
    a, b = shingled(a), shingled(b)
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def test_stage_finds_every_similar_pair(spark):
    rng = np.random.default_rng(4)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    texts = [None, "", " \t", "one", "One", "one two"]
    for _ in range(40):
        base = word(int(rng.integers(5, 300)))
        chain = list(base)
        texts.append(" ".join(base))
        # Copies with a few words changed, each from the one before, so groups are chains.
        for _ in range(4):
            chain = list(chain)
            for i in rng.integers(0, len(chain), max(1, len(chain) // 60)):
                chain[i] = word(1)[0]
            texts.append(" ".join(chain))
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (None, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if alike(texts[i], texts[j])]
    low = reach(range(len(texts)), linked)
    assert {r.doc_id: r.component_id for r in overlap.near_duplicates(df).collect()} == low
    out = [r.doc_id for r in cp.drop_near_duplicates(spark, df, "").collect()]
    assert sorted(x for x in out if x is not None) == sorted(set(low.values())) and out.count(None) == 1


def test_a_large_group_costs_few_pairs(spark, monkeypatch):
    """Copies of one text that are linked with it but not with each other."""
    rng = np.random.default_rng(5)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    base, shared = word(400), word(80)
    texts = [" ".join(base)]
    for _ in range(120):
        copy = list(base)
        for i in rng.choice(400, 6, replace=False):
            copy[i] = word(1)[0]
        texts.append(" ".join(copy))
    # Texts that share a passage and have a similarity below 0.8.
    texts += [" ".join(word(16) + shared) for _ in range(120)]
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if alike(texts[i], texts[j])]
    assert len(linked) < 120 * 119 / 4
    compared, plain = [], overlap.similar
    monkeypatch.setattr(overlap, "similar", lambda pairs, held: compared.append(pairs.count()) or plain(pairs, held))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in overlap.near_duplicates(df).collect()} == reach(range(len(texts)), linked)
    assert sum(compared) < 4 * len(texts)
