"""The plans behind the operators: pushed filters, pruned folders, shuffles."""

from pyspark.sql import functions as F

from claimbrook.functions import dates
from claimbrook.operators import cohort, linking, utilization
from claimbrook.plans import registry, table_queries  # noqa: F401
from claimbrook.sources import csv_scan, lake
from tests.oracle import ROOT

FOLDER = f"{ROOT}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


def test_year_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).select((F.col("id") + 20080101).alias("CLM_THRU_DT")).write.parquet(f"{tmp_path}/c")
    rows = spark.read.parquet(f"{tmp_path}/c").where(dates.in_year(F.col("CLM_THRU_DT"), 2008))
    assert "GreaterThanOrEqual(CLM_THRU_DT,20080000)" in plan(rows)


def test_sample_filter_prunes_folders(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 3 + 1).cast("int").alias("sample"))
    lake.write_dataset(df, f"{tmp_path}/x.parquet", 100, "t")
    text = plan(lake.read_dataset(spark, f"{tmp_path}/x.parquet", [1, 2]))
    assert "PartitionFilters: [sample" in text


def test_a_clustered_dataset_prunes_files(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.col("id"), (F.lit(20080000) + F.pmod(F.xxhash64("id"), F.lit(30_000))).cast("bigint").alias("CLM_THRU_DT"),
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 20 + 1)).cast("int").alias("sample"),
    )
    found = {}
    for name, df in (("loose", rows), ("clustered", lake.clustered(rows, "CLM_THRU_DT", 24))):
        lake.write_dataset(df, f"{tmp_path}/{name}.parquet", 10**6, name)
        year = lake.read_dataset(spark, f"{tmp_path}/{name}.parquet").where(dates.in_year(F.col("CLM_THRU_DT"), 2008))
        assert "GreaterThanOrEqual(CLM_THRU_DT,20080000)" in plan(year)
        assert sorted(r.id for r in year.collect()) == sorted(r.id for r in rows.where(dates.in_year(F.col("CLM_THRU_DT"), 2008)).collect())
        # Rows that come out of the row groups read, before the filter looks at them.
        scan = year._jdf.queryExecution().executedPlan().collectLeaves().toList().apply(0)
        found[name] = scan.metrics().get("numOutputRows").get().value()
    assert found["clustered"] <= found["loose"] * 2 / 3


def test_ingest_has_no_shuffle(spark, tmp_path):
    (tmp_path / "DE1_0_2008_Beneficiary_Summary_File_Sample_1.csv").write_text("a,n\nx,1\n")
    raw = csv_scan.raw_csv(spark, [str(tmp_path)], ["a", "n"])
    assert "Exchange" not in plan(csv_scan.typed_rows(raw, csv_scan.infer_schema(raw, ["a", "n"])))


def test_aggregates_combine_before_one_shuffle(spark):
    orders = registry.table(spark, FOLDER, "orders").withColumn("yr", F.year("o_orderdate"))
    for df in (
        utilization.claim_counts(orders, ["o_custkey", "yr"]),
        utilization.spend(orders, ["o_custkey"], {"cents": F.col("o_totalprice")}),
        linking.attrition(orders, 2001, "o_custkey", "yr"),
        cohort.index_claims(orders, "o_orderdate", "o_orderkey", "o_custkey"),
        cohort.follow_up(orders, "o_orderdate", F.col("yr"), "o_custkey"),
    ):
        assert shuffles(df) == 1
        assert "partial_" in plan(df)


def test_columns_are_pruned(spark):
    df = registry.QUERIES["q_spend_by_bene_year"](spark, FOLDER)
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan(df)


def test_no_query_pairs_rows_without_a_key(spark):
    for name, run in registry.QUERIES.items():
        if run.__module__.endswith("table_queries"):
            text = plan(run(spark, FOLDER))
            assert "CartesianProduct" not in text and "NestedLoopJoin" not in text, name
            assert "PythonUDF" not in text and "InPandas" not in text, name


def test_spread_joins_are_lazy_and_read_what_they_need(spark, tmp_path):
    rows = spark.range(1000).select(
        F.lit("a").alias("DESYNPUF_ID"), F.col("id").alias("CLM_ID"), F.lit("wide").alias("unused"), F.current_date().alias("svc")
    )
    rows.write.parquet(f"{tmp_path}/c")
    claims = spark.read.parquet(f"{tmp_path}/c")
    people = spark.createDataFrame([("a", "M")], "DESYNPUF_ID string, sex string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "no job while the join is put together")
    try:
        joined = linking.claims_with_beneficiary(claims, people).select("CLM_ID", "sex")
        assert not tracker.getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    text = plan(joined)
    assert "unused" not in text and "approx_top_k" not in text and "SinglePartition" not in text
    assert joined.count() == 1000


def test_a_files_digest_does_not_depend_on_its_splits(spark, tmp_path):
    lines = [f"{i},{i % 7}" for i in range(5000)] + ["5,5", "5,5"]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "a" / "y.csv").write_text("\r\n".join(reversed(lines)))
    (tmp_path / "a" / "z.csv").write_text("\n".join(lines[:-1]) + "\n")
    whole = {r["path"].rsplit("/", 1)[-1]: r for r in lake.line_digests(spark, f"{tmp_path}/a").collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        split = lake.line_digests(spark, f"{tmp_path}/a")
        assert split.rdd.getNumPartitions() >= 1
        cut = {r["path"].rsplit("/", 1)[-1]: r for r in split.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert cut == whole and set(whole) == {"x.csv", "y.csv", "z.csv"}
    assert whole["x.csv"]["sha256"] == whole["y.csv"]["sha256"] != whole["z.csv"]["sha256"]
    files = spark.read.format("binaryFile").load(f"{tmp_path}/a")
    logged = lake.file_manifest(files, "landed", lake.line_digests(spark, f"{tmp_path}/a")).collect()
    assert {r["part_name"]: (r["size_bytes"] > 0, r["lines"]) for r in logged} == {
        "x.csv": (True, 5002), "y.csv": (True, 5002), "z.csv": (True, 5001),
    }
