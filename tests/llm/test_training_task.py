"""The toxicity model is trained in a task, and what scoring does for each word is done for many at once."""

import numpy as np
from pyspark.sql import DataFrame

from claimbrook.llm import toxicity as tx


def test_only_the_model_reaches_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"calm day {i % 7}" if i % 2 else f"foul slur {i % 7}") for i in range(200)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(1 - doc_id % 2 as int) toxic")
    collected, plain = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: collected.append(plain(df)) or collected[-1])
    model = tx.fit(docs, labels)
    assert sum(map(len, collected)) == 1 and not {"t", "text"} & set(collected[0][0].asDict())
    clean, toxic = tx.score_texts(model, ["calm day", "foul slur"])
    assert clean < 0.5 < toxic
    assert isinstance(docs, DataFrame) and tx.fit(docs.where("false"), labels) is None


def test_trigrams_of_many_words():
    rng = np.random.default_rng(3)
    some = [97, 98, 122, 48, 233, 1078, 20013, 128512]
    words = ["", "a", "x" * 64, "日本語文"] + ["".join(map(chr, rng.choice(some, n))) for n in rng.integers(1, 12, 500)] + [""]
    assert tx.all_trigrams(words).tolist() == [g for w in words for g in tx.trigrams(w)]
    assert tx.all_trigrams([]).tolist() == [] and tx.all_trigrams([""]).tolist() == []


def test_windows_score_as_in_training():
    rng = np.random.default_rng(4)
    p = tx.fresh(40)
    words = tx.Words({f"w{i}": i + 2 for i in range(30)})
    ids = words.add([f"w{i}" for i in rng.integers(0, 60, 20000)])
    grid = tx.windows(ids)
    flat = words.flat()
    want = tx.forward(p, (tx.inputs(p, flat) @ p["into"] + p["bias"])[grid])
    assert len(grid) > 2 * tx.BATCH and np.allclose(tx.read_windows(p, tx.weights(p), tx.projected(p, flat), grid), want, atol=1e-5)


def test_equal_texts_are_read_once(monkeypatch):
    model = {"p": tx.fresh(3), "index": {"one": 2}, "scale": 1.0, "shift": 0.0}
    read, plain = [], tx.words_of
    monkeypatch.setattr(tx, "words_of", lambda t: read.append(t) or plain(t))
    scores = tx.score_texts(model, ["one two", None, "one two", "", None, "one two"])
    assert len(read) == 3 and len(set(scores[[0, 2, 5]])) == 1 and scores[1] == scores[3] == scores[4]
    assert len(tx.score_texts(model, [])) == 0


def test_many_different_words(monkeypatch):
    """Scores do not depend on which words were read before."""
    model = {"p": tx.fresh(3), "index": {"one": 2}, "scale": 1.0, "shift": 0.0}
    texts = [" ".join(f"w{i}x{j}" for j in range(10 * i)) for i in range(300)]
    want = tx.score_texts(model, texts)
    monkeypatch.setattr(tx, "KNOWN", 500)
    assert np.allclose(np.concatenate([tx.score_texts(model, texts[at : at + 7]) for at in range(0, 300, 7)]), want, atol=1e-6)
    assert np.allclose(tx.score_texts(model, texts), want, atol=1e-6)
