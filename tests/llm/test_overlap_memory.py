"""A task holds the words of one text at a time, and components found once are not found again."""

import weakref

import numpy as np
import pyarrow as pa

from claimbrook.llm import common, overlap
from tests.llm.test_near import reach
from tests.llm.test_overlap import alike


class Words(list):
    """A list that can be referred to weakly."""


def test_words_of_one_text_at_a_time(monkeypatch):
    texts = [None, "", *(f"Some text of number {i} and more words" for i in range(600))]
    held, most, plain = [], [], overlap.words_of

    def watched(text):
        words = Words(plain(text))
        held.append(weakref.ref(words))
        most.append(sum(r() is not None for r in held[-50:]))
        return words

    monkeypatch.setattr(overlap, "words_of", watched)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["k", "t"])
    rows = [r for out in overlap.marks(iter([batch, batch.slice(0, 0)])) for r in out.to_pylist()]
    assert [r["k"] for r in rows] == list(range(len(texts))) and max(most) <= 2
    assert rows[0]["mark"] == rows[1]["mark"] and len({r["mark"] for r in rows}) == len(texts) - 1
    assert [len(r["keys"]) for r in rows] == [0, 0] + [overlap.BANDS] * 600


def test_components_are_carried_on(spark, monkeypatch):
    rng = np.random.default_rng(9)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    chain, texts = word(200), []
    for _ in range(24):
        chain = list(chain)
        for i in rng.integers(0, 200, 3):
            chain[i] = word(1)[0]
        texts.append(" ".join(chain))
    written, plain = [], common.stage
    monkeypatch.setattr(common, "stage", lambda df, label: written.append(label) or plain(df, label))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    linked = [(i, j) for i in range(24) for j in range(i) if alike(texts[i], texts[j])]
    assert {r.doc_id: r.component_id for r in overlap.near_duplicates(df).collect()} == reach(range(24), linked)
    # A first look, a round, and one that finds nothing new.
    assert written.count("overlap-all") == 3 <= written.count("overlap-first")
