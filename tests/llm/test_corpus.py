import re
import zlib

import numpy as np
import pytest

from claimbrook.llm import mixing, packing, toxicity
from claimbrook.llm.tokens import byte_level

ROWS = [(i, " ".join(["w"] * (i % 17)), f"s{i % 5 % 4}" if i % 7 else None) for i in range(300)] + [(300, None, "s0"), (301, "", "s9"), (5, "a b", "s1")]


def test_targets_stop_and_are_dealt_again():
    got = mixing.targets([100, 1000, 1000], [5, 2, 1])
    assert got[0] == 200 and abs(sum(got) - 3150) < 1e-6 and max(got[1:]) <= 2000
    assert mixing.targets([], []) == []
    assert mixing.targets([0, 0], [5, 2]) == [0, 0]


def test_flow_prefers_first_uses_and_reroutes():
    a, b = frozenset([0]), frozenset([0, 1])
    assert mixing.flow([(a, 100), (b, 100)], [150, 50]) == [100, 100]
    assert mixing.flow([(b, 10)], [30, 0]) == [20]
    assert mixing.flow([(a, 100), (b, 100)], [100, 100]) == [100, 100]


def test_mix_meets_targets(spark):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, source string, size int")
    out = [tuple(r) for r in mixing.mix(df).collect()]
    assert len(out) == len(ROWS)
    names = sorted({r[2] for r in ROWS}, key=lambda s: (s is None, s or ""))
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = [sum(count(t) for _, t, s in ROWS if s == n) for n in names]
    due = mixing.targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(names))])
    taken = dict.fromkeys(due, 0)
    for _, size, _, target, took in out:
        assert 0 <= took <= 2 * size
        taken[target] += took
    # Sources of the same weight may have the same target.
    assert all(abs(t * due.count(t) - n) <= due.count(t) for t, n in taken.items())
    assert sorted(out) == sorted(tuple(r) for r in mixing.mix(df.repartition(3)).collect())
    assert mixing.mix(df.where("false")).count() == 0


def test_overlapping_sources(spark):
    df = spark.createDataFrame([(1, "a b c", ["x"]), (2, "d e", ["x", "y"]), (3, "f", None)], "doc_id long, text string, source array<string>")
    assert sum(r.taken for r in mixing.mix(df).collect()) > 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_the_histogram_up(seed):
    rng = np.random.default_rng(seed)
    hist = np.zeros(65, dtype=np.int64)
    hist[1:] = rng.integers(0, 40, 64) * (rng.random(64) < 0.5)
    made = np.zeros_like(hist)
    sequences = 0
    for times, pattern in packing.plan(hist):
        assert times > 0 and sum(n * m for n, m in pattern) <= 64
        sequences += times
        for n, m in pattern:
            made[n] += times * m
    assert (made == hist).all()
    assert sequences <= 1.15 * (hist * np.arange(65)).sum() / 64 + 2


def test_texts_encode_to_the_librarys_ids():
    import random

    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    whole, encoder = Tokenizer.from_file(path), byte_level(path)
    rng = random.Random(4)
    parts = [*" \n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u2028\u3000\u200b\u1680", "  ", "a", "word", "don't", "'s", "12", "é", "中文", "...", "<|endoftext|>", "|", "_", "ÿ", "Ā", "\U0001f600", "\u0301"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert encoder.ids(text) == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_pack_places_every_id_once(spark):
    from tokenizers import Tokenizer

    texts = [None, "", "a", "word " * 5000] + ["some text here " * k for k in range(1, 120)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(2, "a", 0)], "doc_id long, text string, start int")
    out = packing.pack(df).toPandas()
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        own = out[out.doc_id == i].sort_values(["start", "sequence_id"])
        for r in own.itertuples():
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        assert own.length.sum() == len(ids) * (2 if i == 2 else 1)
    for _, seq in out.sort_values("offset").groupby("sequence_id"):
        assert (seq.offset.to_numpy() == np.append(0, seq.length.cumsum()[:-1])).all() and seq.length.sum() <= 2048
    assert sorted(out.sequence_id.unique()) == list(range(out.sequence_id.nunique()))
    assert packing.pack(df.where("false")).count() == 0


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in toxicity.fresh(10).items()}
    x = rng.standard_normal((3, toxicity.LENGTH, 6 * toxicity.SIZE))
    y = np.array([0.0, 1.0, 1.0])
    loss = lambda: float(sum(np.log1p(np.exp(o)) - t * o for o, t in zip(toxicity.forward(p, x), y)))
    keep = {}
    out = toxicity.forward(p, x, keep)
    g, dx = toxicity.gradients(p, keep, 1 / (1 + np.exp(-out)) - y)
    for name, at in [("back0", (2, 3)), ("back1", (1, 20)), ("mix", (4, 5)), ("ask", (3,)), ("out", (7,)), ("shift", (0,))]:
        old, eps = p[name][at], 1e-2
        p[name][at] = old + eps
        up = loss()
        p[name][at] = old - eps
        down = loss()
        p[name][at] = old
        assert abs((up - down) / (2 * eps) - g[name][at]) < 2e-3, name


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels)
    held = {r.doc_id: r.toxic for r in labels.where("crc32(cast(doc_id as string)) % 3 = 1").collect()}
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(got) == docs.count()
    hits = [(got[d] >= 0.7) == bool(y) for d, y in held.items()]
    assert sum(hits) / len(hits) > 0.9
    odd = spark.createDataFrame([(1, None, 2.0), (2, "", 1.0), (3, "x " * 50000, 0.0)], "doc_id long, text string, score double")
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd, model).collect())
    assert toxicity.score(odd, None).count() == 3 and toxicity.fit(docs.where("false"), labels) is None
