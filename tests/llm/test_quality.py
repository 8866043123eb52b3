import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimbrook.llm import quality
from claimbrook.llm.queries import QUERIES
from tests.oracle import ROOT

FOLDER = f"{ROOT}/sf0.01"


def test_terms_count_whole_texts():
    text = "Ab  12 ab!! ab!!"
    raw = text.encode()
    found = quality.terms(text)
    assert found[: quality.GRAMS].sum() == len(raw) - 2
    # "Aa  0 a!! a!!" has 13 codes.
    assert found[quality.GRAMS : quality.GRAMS + quality.SHAPES].sum() == 10
    long = "xy " * 1_000_000
    assert quality.terms(long)[: quality.GRAMS].sum() == len(long) - 2
    assert quality.terms(None).sum() == quality.terms("").sum() == 1


def test_hashed_in_chunks(monkeypatch):
    codes = np.random.default_rng(1).integers(0, 256, 1000).astype(np.uint8)
    want = quality._hashed(codes, 3, 64)
    monkeypatch.setattr(quality, "CHUNK", 7)
    assert (quality._hashed(codes, 3, 64) == want).all()
    x = [codes[i : i + 3].astype(int) for i in range(998)]
    seen = {}
    for run in x:
        seen[tuple(run)] = seen.get(tuple(run), 0) + 1
    assert want.sum() == sum(seen.values()) == 998


def test_votes_beside_brute_force():
    rng = np.random.default_rng(2)
    similarity = np.round(rng.uniform(-1, 1, (40, 30)), 1)
    similarity[0] = -1.0
    labels = rng.integers(0, 2, 30).astype(float)
    got = quality.vote(similarity, labels)
    for row, score in zip(similarity, got):
        last = sorted(row, reverse=True)[quality.NEIGHBOURS - 1]
        near = [(max(s, 0.0) ** quality.POWER, y) for s, y in zip(row, labels) if s >= last]
        total = sum(w for w, _ in near)
        assert score == pytest.approx(sum(w * y for w, y in near) / total if total else labels.mean())


def test_latent_cosines_beside_full_decomposition():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.7, (20, quality.TERMS)).astype(float)
    model = quality.train(counts, np.arange(20) % 2)
    x = quality.weighted(counts, model["weight"])
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    want = quality._unit(u * s)
    assert np.allclose(np.abs(model["vectors"] @ model["vectors"].T), np.abs(want @ want.T), atol=1e-8)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score string, y int, at int")


def test_odd_rows(spark):
    good, bad = "the quick fox sees a dog and runs", "BUY!! NOW!! NOW!! NOW!!"
    rows = [(i, (good if i % 2 else bad) + f" {i}", "s", 0, 0) for i in range(40)]
    rows += [(40, None, "s", 0, 0), (41, "", "s", 0, 0), (42, bad * 50_000, "s", 0, 0), (None, good, "s", 0, 0), rows[3], rows[3]]
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(40)] + [(3, 1), (7, None), (None, 1), (8, 5), (777, 0)], "doc_id long, quality int"
    )
    docs = table(spark, rows)
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score for r in got}
    assert all((by_id[i] >= 0.5) == bool(i % 2) for i in range(40))
    assert by_id[42] < 0.5 <= by_id[None]
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert quality.fit(docs, labels.where("false")) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(table(spark, []), model).count() == 0
    assert quality.fit(table(spark, []), labels) is None


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = QUERIES["op12_quality"](spark, FOLDER).join(labels, "doc_id").where("held_out and quality is not null")
    right, wrong_bad, n_bad, n = rows.agg(
        F.sum((F.col("predicted") == F.col("quality")).cast("int")),
        F.sum(((F.col("quality") == 0) & (F.col("predicted") == 1)).cast("int")),
        F.sum((F.col("quality") == 0).cast("int")),
        F.count("*"),
    ).first()
    assert right / n > 0.97 and wrong_bad / n_bad < 0.15
