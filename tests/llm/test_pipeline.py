import re

import corpus_pipeline as cp
from claimbrook.llm import packing
from tests.llm.test_near import reach
from tests.llm.test_overlap import shingled


def test_stages_take_effect(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(400)
    docs = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "src1", 0)], docs.schema))
    columns = docs.columns
    for name, function in cp.STAGES[:-1]:
        out = cp.stage(function(spark, docs, folder), f"test-{name}")
        assert out.columns == columns and 0 < out.count()
        before, after = {r.doc_id for r in docs.collect()}, [r.doc_id for r in out.collect()]
        assert set(after) <= before
        if name == "near_duplicates":
            # Brute force over all pairs: one of each group of similar texts is left, its first.
            texts = sorted((r.doc_id, shingled(r.text)) for r in docs.collect())
            alike = [(i, j) for i, a in texts for j, b in texts if i < j and (a == b or 5 * len(a & b) >= 4 * len(a | b))]
            assert sorted(after) == sorted(set(reach([i for i, _ in texts], alike).values()))
        if name == "personal_data":
            assert sorted(after) == sorted(before)
            assert not any(re.search(r"[a-z0-9]+@[a-z0-9]+\.[a-z]+", r.text or "") for r in out.collect())
        docs = out
    last = cp.pack(spark, docs, folder)
    assert last.agg({"length": "sum"}).first()[0] == packing.pieces(docs, "doc_id", "text", packing.tokenizer_path(), 2048).agg({"length": "sum"}).first()[0]


def test_empty_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, function in cp.STAGES[1:]:
        assert function(spark, docs, folder).count() == 0
