import re

from claimbrook.llm import licenses


def brute(text):
    cut = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    have = grams(cut(text))
    out = []
    for name, t in licenses.TEMPLATES.items():
        own = set(grams(cut(t)))
        span = len(own) + 4
        if any(len(own & set(have[max(0, i - span) : i + span])) >= 0.8 * len(own) for i in range(len(have))):
            out.append(name)
    return out


def test_licenses_match_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    grant = licenses.TEMPLATES["mit-grant"].upper()
    extra = [(-1, None), (-2, ""), (-3, "x " * 30000 + grant + " y" * 9), (-4, "free of charge to any person"), (-5, grant.replace("SOFTWARE", "WORK"))]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).selectExpr("*", "1 as licenses")
    rows = licenses.find_licenses(docs.drop("licenses")).collect()
    assert sum(bool(r.licenses) for r in rows) >= 10
    for r in rows:
        assert r.licenses == brute(r.text), r.doc_id
    assert licenses.find_licenses(docs).count() == docs.count()
    assert licenses.find_licenses(docs.where("false")).count() == 0
