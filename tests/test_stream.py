from claimbrook.functions.naming import schema_for
from claimbrook.plans.convert import convert_deliveries
from claimbrook.sources import lake
from claimbrook.sources.kinds import KIND_BY_NAME
from claimbrook.streaming import ingest

KIND = KIND_BY_NAME["beneficiary_2008"]
NAME = "DE1_0_2008_Beneficiary_Summary_File_Sample_{}.csv"
SCHEMA = schema_for(["BENE_ID", "n"], {"n": "bigint"})


def test_two_runs_equal_one_batch_conversion(spark, tmp_path):
    landing = tmp_path / "land"
    landing.mkdir()
    paths = {k: str(tmp_path / k) for k in ("lake", "check", "log", "batch")}

    def run():
        ingest.ingest_stream(
            spark, str(landing), KIND, SCHEMA, paths["lake"], paths["check"], paths["log"]
        ).awaitTermination()

    (landing / NAME.format(1)).write_text("BENE_ID,n\n0001,1\n0002,\n")
    (landing / "DE1_0_2009_Beneficiary_Summary_File_Sample_1.csv").write_text("other\n1\n")
    run()
    (landing / NAME.format(2)).write_text("BENE_ID,n\n0003,3\n")
    (landing / NAME.format(21)).write_text("BENE_ID,n\n0004,4\n")
    run()
    run()
    streamed = ingest.read_streamed(spark, f"{paths['lake']}/{KIND.output_name}")
    convert_deliveries(spark, str(landing), paths["batch"])
    batch = lake.read_dataset(spark, f"{paths['batch']}/{KIND.output_name}")
    assert sorted(map(tuple, streamed.collect()), key=str) == sorted(map(tuple, batch.collect()), key=str)
    log = spark.read.parquet(paths["log"]).collect()
    assert sorted((r[ingest.BATCH], r["deliveries"], r["rows"]) for r in log) == [(0, 1, 2), (1, 1, 1)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    landing = tmp_path / "land"
    landing.mkdir()
    (landing / NAME.format(1)).write_text("BENE_ID,n\n0001,1\n")
    # A second checkpoint replays batch 0 into the same lake, as after a failure.
    for check in ("c1", "c2"):
        ingest.ingest_stream(
            spark, str(landing), KIND, SCHEMA, str(tmp_path / "lake"), str(tmp_path / check), str(tmp_path / "log")
        ).awaitTermination()
    assert ingest.read_streamed(spark, f"{tmp_path}/lake/{KIND.output_name}").count() == 1
    assert spark.read.parquet(str(tmp_path / "log")).count() == 1


def streamed(spark, tmp_path, check, **more):
    ingest.ingest_stream(
        spark, str(tmp_path / "land"), KIND, SCHEMA, str(tmp_path / "lake"), str(tmp_path / check), str(tmp_path / "log"), **more
    ).awaitTermination()


def taken(spark, tmp_path):
    return sorted(tuple(r) for r in ingest.read_streamed(spark, f"{tmp_path}/lake/{KIND.output_name}").collect())


def test_bad_rows_are_set_aside_and_later_runs_go_on(spark, tmp_path):
    (tmp_path / "land").mkdir()
    aside = str(tmp_path / "aside")
    (tmp_path / "land" / NAME.format(1)).write_text("BENE_ID,n\n0001,1\n0002,oops\nshort\n")
    streamed(spark, tmp_path, "c", quarantine=aside)
    (tmp_path / "land" / NAME.format(2)).write_text("BENE_ID,n\n0003,3\n")
    streamed(spark, tmp_path, "c", quarantine=aside)
    assert taken(spark, tmp_path) == [("0001", 1, 1), ("0003", 3, 2)]
    bad = spark.read.parquet(f"{aside}/{KIND.output_name}").collect()
    assert sorted((r["sample"], r["bad_columns"], r["raw"]) for r in bad) == [
        (1, ["_corrupt"], "short"), (1, ["n"], '{"BENE_ID":"0002","n":"oops"}'),
    ]
    log = spark.read.parquet(str(tmp_path / "log")).collect()
    assert sorted((r[ingest.BATCH], r["deliveries"], r["rows"], r["rejected"]) for r in log) == [(0, 1, 1, 2), (1, 1, 1, 0)]


def test_a_repeated_batch_replaces_both_outputs(spark, tmp_path):
    (tmp_path / "land").mkdir()
    aside, file = str(tmp_path / "aside"), tmp_path / "land" / NAME.format(1)
    file.write_text("BENE_ID,n\n0001,1\n0002,oops\n")
    streamed(spark, tmp_path, "c1", quarantine=aside)
    # The same batch again, as after a failure between its outputs; this time every cell converts.
    file.write_text("BENE_ID,n\n0001,1\n0002,2\n")
    streamed(spark, tmp_path, "c2", quarantine=aside)
    assert taken(spark, tmp_path) == [("0001", 1, 1), ("0002", 2, 1)]
    import glob

    assert not glob.glob(f"{aside}/**/*.parquet", recursive=True) or not glob.glob(f"{aside}/*/sample=*/*/*.parquet")


def test_part_files_of_one_delivery_count_once(spark, tmp_path):
    folder = tmp_path / "land" / NAME.format(3)
    folder.mkdir(parents=True)
    for i in range(3):
        (folder / f"part-{i}.csv").write_text(f"BENE_ID,n\n000{i},{i}\n")
    streamed(spark, tmp_path, "c")
    assert [r["deliveries"] for r in spark.read.parquet(str(tmp_path / "log")).collect()] == [1]


def test_without_a_quarantine_a_bad_row_stops_the_stream(spark, tmp_path):
    import pytest

    (tmp_path / "land").mkdir()
    (tmp_path / "land" / NAME.format(1)).write_text("BENE_ID,n\n0001,oops\n")
    with pytest.raises(Exception, match="not a bigint"):
        streamed(spark, tmp_path, "c")
