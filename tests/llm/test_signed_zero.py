from claimbrook.llm import vectors


def test_negative_zero_is_zero(spark):
    rows = [(1, [0.0, 1.0, 0.0]), (2, [-0.0, 1.0, 0.0]), (3, [0.01, 1.0, -0.0]), (4, [-0.0, -0.0, 0.0]), (5, [-1.0, 0.0, -0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicate_vectors(df).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), 4: (0, 4, True), 5: (0, 5, True)}
