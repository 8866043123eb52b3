"""Conversions of small hand-written deliveries, the edge cases included."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from claimbrook.functions.naming import schema_for
from claimbrook.plans.convert import Options, conversion_summary, convert_deliveries
from claimbrook.sources import csv_scan, inventory, lake

BENE = "DE1_0_2008_Beneficiary_Summary_File_Sample_{}.csv"
CARRIER = "DE1_0_2008_to_2010_Carrier_Claims_Sample_{}.csv"
INPATIENT = "DE1_0_2008_to_2010_Inpatient_Claims_Sample_{}.csv"


@pytest.fixture
def land(tmp_path):
    landing = tmp_path / "csv_files"
    landing.mkdir()

    def write(name, text):
        data = text if isinstance(text, bytes) else text.encode()
        (landing / name).write_bytes(data)
        return str(landing)

    write.landing, write.lake = str(landing), str(tmp_path / "parquets")
    return write


def run(spark, land, **options):
    results = convert_deliveries(spark, land.landing, land.lake, Options(**options))
    return {r["kind"]: r for r in results.collect()}


def rows(spark, land, name):
    return lake.read_dataset(spark, f"{land.lake}/{name}.parquet")


def bene(spark, land):
    return rows(spark, land, "DE1_0_2008_Beneficiary_Summary_File")


def carrier(spark, land):
    return rows(spark, land, "DE1_0_2008_to_2010_Carrier_Claims")


def convert_one(spark, land, text, **options):
    land(BENE.format(1), text)
    return run(spark, land, **options)["beneficiary_2008"]


def test_beneficiary_and_both_carrier_halves(spark, land):
    land(BENE.format(1), "BENE_ID,CLAIM_COUNT\n0001,2\n")
    land(CARRIER.format("1A"), "BENE_ID,CLM_ID,TOTAL_PMT\n0001,100,10.5\n")
    land(CARRIER.format("1B"), "BENE_ID,CLM_ID,TOTAL_PMT\n0002,101,20.5\n")
    results = convert_deliveries(spark, land.landing, land.lake)
    found = {r["kind"]: r for r in results.collect()}
    assert [r["kind"] for r in results.collect()][-1] == "carrier_claims"
    assert found["beneficiary_2008"]["status"] == "written"
    assert found["beneficiary_2008"]["row_count"] == 1
    assert found["beneficiary_2008"]["column_count"] == 2
    assert found["carrier_claims"]["row_count"] == 2
    assert found["inpatient_claims"]["status"] == "skipped"
    assert tuple(conversion_summary(results).first()) == (2, 0, 5)
    assert [tuple(r) for r in bene(spark, land).collect()] == [("0001", 2, 1)]
    assert bene(spark, land).dtypes == [("BENE_ID", "string"), ("CLAIM_COUNT", "bigint"), ("sample", "int")]
    assert sorted(tuple(r) for r in carrier(spark, land).collect()) == [
        ("0001", "100", 10.5, 1), ("0002", "101", 20.5, 1),
    ]


def test_one_carrier_half_is_enough(spark, land):
    land(CARRIER.format("1A"), "BENE_ID,CLM_ID,TOTAL_PMT\n0001,100,10.5\n")
    assert run(spark, land)["carrier_claims"]["row_count"] == 1


def test_nothing_delivered(spark, land, tmp_path):
    assert run(spark, land, report_missing=False) == {}
    missing = convert_deliveries(spark, str(tmp_path / "nowhere"), land.lake)
    assert {r["status"] for r in missing.collect()} == {"skipped"}


def test_other_files_are_ignored_and_listed(spark, land):
    land(BENE.format(1), "BENE_ID\n1\n")
    land(BENE.format(21), "BENE_ID\n2\n")
    land("ignored.csv", "x\n1\n")
    assert run(spark, land)["beneficiary_2008"]["row_count"] == 1
    listed = inventory.file_inventory(spark, land.landing).collect()
    reasons = {r["file_name"]: r["reject_reason"] for r in listed}
    assert reasons == {
        BENE.format(1): None,
        BENE.format(21): "sample out of range",
        "ignored.csv": "unrecognised file name",
    }


def test_null_tokens_in_text_and_numbers(spark, land):
    text = 'w,n\n"NA",1\n,2\n"",3\nNULL,null\nna,N/A\nNa,4\nn/a,5\n a ,\n'
    assert convert_one(spark, land, text)["status"] == "written"
    got = [tuple(r)[:2] for r in bene(spark, land).collect()]
    assert got == [
        (None, 1), (None, 2), (None, 3), (None, None), (None, None),
        ("Na", 4), ("n/a", 5), (" a ", None),
    ]


def test_types_of_first_delivery(spark, land):
    text = (
        "empty,n,flag,day,clock,moment,x,words,code_cd\n"
        ",1,true,2008-01-01,12:30:00,2008-01-01 10:00:00,1.5,hello,007\n"
        "NA,2,False,2008-12-31,00:00:00,2008-01-02 11:30:00,-2,world,8\n"
    )
    assert convert_one(spark, land, text)["status"] == "written"
    assert [t for _, t in bene(spark, land).dtypes] == [
        "string", "bigint", "boolean", "date", "string", "timestamp_ntz", "double", "string", "string", "int",
    ]
    first = bene(spark, land).orderBy("n").first()
    assert first["code_cd"] == "007" and first["day"] == dt.date(2008, 1, 1)
    assert first["moment"] == dt.datetime(2008, 1, 1, 10)


def test_nan_makes_a_column_double(spark, land):
    assert convert_one(spark, land, "n\n1\nNaN\n")["status"] == "written"
    got = [r["n"] for r in bene(spark, land).collect()]
    assert got[0] == 1.0 and math.isnan(got[1])


def test_quotes_and_blank_lines(spark, land):
    text = 'a,b\n"a ""b"" c",1\n\n"d \\"e\\" f",2\n"x,y",3\n'
    assert convert_one(spark, land, text)["status"] == "written"
    assert [r["a"] for r in bene(spark, land).orderBy("b").collect()] == ['a "b" c', 'd "e" f', "x,y"]


@pytest.mark.parametrize("late", ["1.5", "1.0", "+5", "x", " NA"])
def test_late_misfit_fails_the_dataset(spark, land, late):
    land(BENE.format(1), "w,n\na,1\n")
    land(BENE.format(2), f"w,n\na,{late}\n")
    result = run(spark, land)["beneficiary_2008"]
    assert result["status"] == "failed" and "n: not a bigint" in result["detail"]


def test_types_over_all_deliveries(spark, land):
    land(BENE.format(1), "w,n\na,1\n")
    land(BENE.format(2), "w,n\na,1.5\n")
    assert run(spark, land, infer="all")["beneficiary_2008"]["status"] == "written"
    assert dict(bene(spark, land).dtypes)["n"] == "double"


def test_samples_are_ordered_by_number(spark, land):
    # Sample 2 comes before sample 10 and decides that n is whole.
    land(BENE.format(10), "w,n\na,1.5\n")
    land(BENE.format(2), "w,n\na,1\n")
    assert run(spark, land)["beneficiary_2008"]["status"] == "failed"


def test_later_boolean_words(spark, land):
    land(BENE.format(1), "w,b\na,true\na,false\n")
    land(BENE.format(2), "w,b\na,yes\na,No\na,1\n")
    assert run(spark, land)["beneficiary_2008"]["status"] == "written"
    got = bene(spark, land).where("sample = 2").collect()
    assert sorted(r["b"] for r in got) == [False, True, True]


@pytest.mark.parametrize("line", ["only", "1,2,3"])
def test_short_and_long_rows_fail(spark, land, line):
    result = convert_one(spark, land, f"a,b\nx,y\n{line}\n")
    assert result["status"] == "failed" and "malformed row" in result["detail"]


@pytest.mark.parametrize(
    "second, problem",
    [
        ("b,a\n1,x\n", "another order"),
        ("a\nx\n", "missing columns: b"),
        ("a,b,c\nx,1,2\n", "extra columns: c"),
        ("", "empty file"),
        ("A,b\nx,1\n", "missing columns: a"),
    ],
)
def test_header_drift_fails_before_writing(spark, land, second, problem):
    land(BENE.format(1), "a,b\nx,1\n")
    land(BENE.format(2), second)
    result = run(spark, land)["beneficiary_2008"]
    assert result["status"] == "failed" and problem in result["detail"]


def test_repeated_header_name(spark, land):
    assert "repeated column" in convert_one(spark, land, "x,x\n1,2\n")["detail"]


def test_empty_file_and_header_only(spark, land):
    assert convert_one(spark, land, "")["status"] == "failed"
    result = convert_one(spark, land, "x,y\n")
    assert (result["status"], result["row_count"], result["column_count"]) == ("written", 0, 2)


def test_byte_order_mark(spark, land):
    assert convert_one(spark, land, b"\xef\xbb\xbfx,y\n1,2\n")["status"] == "written"
    assert bene(spark, land).columns == ["x", "y", "sample"]


def test_negative_money_and_bad_days_are_kept(spark, land):
    convert_one(spark, land, "amount,day\n-994.28,20081301\n")
    assert tuple(bene(spark, land).first()) == (-994.28, 20081301, 1)


@pytest.mark.parametrize("replace", ["dataset", "in_place", "snapshot"])
def test_rerun_replaces_and_failure_keeps(spark, land, replace):
    convert_one(spark, land, "a,n\nx,1\n", replace=replace)
    land(BENE.format(2), "a,n\ny,2\n")
    assert run(spark, land, replace=replace)["beneficiary_2008"]["row_count"] == 2
    assert bene(spark, land).count() == 2
    land(BENE.format(2), "a,n\ny,oops\n")
    assert run(spark, land, replace=replace)["beneficiary_2008"]["status"] == "failed"
    assert sorted(r["n"] for r in bene(spark, land).collect()) == [1, 2]
    import os

    assert os.listdir(land.lake) == ["DE1_0_2008_Beneficiary_Summary_File.parquet"]


def test_one_bad_dataset_does_not_stop_the_others(spark, land):
    land(BENE.format(1), "a,n\nx,1\n")
    land(CARRIER.format("1A"), "a,b\n1\n")
    land(INPATIENT.format(1), "a,n\nx,1\n")
    found = run(spark, land, at_once=3)
    assert found["carrier_claims"]["status"] == "failed"
    assert found["beneficiary_2008"]["status"] == found["inpatient_claims"]["status"] == "written"


def test_quarantine_keeps_the_good_rows(spark, land, tmp_path):
    text = "w,n,x\na,1,1.5\nb,2,2d\nc,+3,1\nshort\nd,4,2\ne,,\n"
    known = schema_for(["w", "n", "x"], {"n": "bigint", "x": "double"})
    result = convert_one(
        spark, land, text, schemas={"beneficiary_2008": known}, quarantine=str(tmp_path / "q")
    )
    assert (result["status"], result["row_count"], result["rejected_rows"]) == ("written", 3, 3)
    assert sorted(r["w"] for r in bene(spark, land).collect()) == ["a", "d", "e"]
    aside = spark.read.parquet(f"{tmp_path}/q/DE1_0_2008_Beneficiary_Summary_File.parquet").collect()
    assert sorted(r["bad_columns"][0] for r in aside) == ["_corrupt", "n", "x"]
    assert any(r["raw"] == "short" for r in aside)


def test_known_schema_must_match(spark, land):
    known = schema_for(["a", "b"], {"a": "bigint"})
    result = convert_one(spark, land, "b,a\nx,1\n", schemas={"beneficiary_2008": known})
    assert result["status"] == "failed" and "another order" in result["detail"]


def test_sample_refresh_leaves_the_others(spark, land):
    land(BENE.format(1), "a,n\nx,1\n")
    land(BENE.format(2), "a,n\ny,2\n")
    run(spark, land)
    land(BENE.format(2), "a,n\nz,3\n")
    import os

    os.remove(f"{land.landing}/{BENE.format(1)}")
    run(spark, land, replace="samples")
    assert sorted(tuple(r) for r in bene(spark, land).collect()) == [("x", 1, 1), ("z", 3, 2)]


def test_rows_per_file_and_inspection(spark, tmp_path):
    df = spark.range(25).select("id", (F.col("id") % 2 + 1).cast("int").alias("sample")).coalesce(1)
    target = str(tmp_path / "out" / "x.parquet")
    lake.write_dataset(df, target, 5, "t")
    found = lake.inspect_dataset(spark, target).first()
    assert (found["row_count"], found["column_count"], found["partition_count"]) == (25, 1, 2)
    assert found["parquet_files"] == 6 and found["size_bytes"] > 0


def test_inspection_of_two_samples(spark, tmp_path):
    df = spark.createDataFrame([("0001", 2, 1), ("0002", 3, 2)], "BENE_ID string, CLAIM_COUNT long, sample int")
    target = str(tmp_path / "x.parquet")
    lake.write_dataset(df, target, 1000, "t")
    found = lake.inspect_dataset(spark, target).first()
    assert (found["parquet_files"], found["row_count"], found["column_count"]) == (2, 2, 2)


def test_header_reads_like_the_file(spark, land):
    land(BENE.format(1), '\n"a", b ,"c,d"\n1,2,3\n')
    assert csv_scan.read_header(spark, f"{land.landing}/{BENE.format(1)}") == ["a", "b", "c,d"]


def test_subfolders_are_not_deliveries(spark, land, tmp_path):
    (tmp_path / "csv_files" / "old").mkdir()
    (tmp_path / "csv_files" / "old" / BENE.format(1)).write_text("a\nx\n")
    assert inventory.file_inventory(spark, land.landing).count() == 0


def test_null_tokens_that_look_like_values(spark, land):
    from claimbrook.functions.text_types import NullTokens

    result = convert_one(spark, land, "w,n\na,-999\nb,5\n-999,\n", nulls=NullTokens(("", "-999")))
    assert result["status"] == "written"
    assert sorted((tuple(r)[:2] for r in bene(spark, land).collect()), key=str) == [
        ("a", None), ("b", 5), (None, None),
    ]


def test_options_are_checked():
    for wrong in ({"infer": "some"}, {"replace": "all"}):
        with pytest.raises(ValueError):
            Options(**wrong)


def only(spark, land, name, text, **options):
    """Deliver this file alone, the others being gone."""
    import os

    for other in os.listdir(land.landing):
        os.remove(f"{land.landing}/{other}")
    land(name, text)
    return run(spark, land, **options)["beneficiary_2008"]


def test_refresh_keeps_the_stored_type(spark, land):
    land(BENE.format(1), "a,n\nx,1.5\n")
    land(BENE.format(2), "a,n\ny,2.5\n")
    run(spark, land)
    assert only(spark, land, BENE.format(2), "a,n\nz,3\n", replace="samples")["status"] == "written"
    assert sorted(tuple(r) for r in bene(spark, land).collect()) == [("x", 1.5, 1), ("z", 3.0, 2)]
    drifted = only(spark, land, BENE.format(2), "a,m\nz,3\n", replace="samples")
    assert drifted["status"] == "failed" and bene(spark, land).count() == 2


@pytest.mark.parametrize("replace", ["dataset", "in_place", "samples", "snapshot", "snapshot_samples"])
def test_a_delivery_without_rows_empties_its_sample(spark, land, replace):
    land(BENE.format(1), "a,n\nx,1\n")
    land(BENE.format(2), "a,n\ny,2\n")
    run(spark, land)
    land(BENE.format(2), "a,n\n")
    assert run(spark, land, replace=replace)["beneficiary_2008"]["row_count"] == 1
    assert [tuple(r) for r in bene(spark, land).collect()] == [("x", 1, 1)]


@pytest.mark.parametrize("replace", ["dataset", "in_place", "samples", "snapshot", "snapshot_samples"])
def test_a_dataset_without_rows_can_be_read(spark, land, replace):
    found = convert_one(spark, land, "a,n\n", replace=replace)
    assert (found["status"], found["row_count"]) == ("written", 0)
    assert bene(spark, land).columns == ["a", "n", "sample"] and bene(spark, land).count() == 0


@pytest.mark.parametrize("replace", ["dataset", "in_place", "samples", "snapshot", "snapshot_samples"])
def test_only_bad_rows_keep_the_old_ones(spark, land, tmp_path, replace):
    aside = str(tmp_path / "aside")
    schemas = {"beneficiary_2008": schema_for(["a", "n"], {"n": "bigint"})}
    convert_one(spark, land, "a,n\nx,1\n", schemas=schemas)
    found = convert_one(spark, land, "a,n\ny,oops\n", schemas=schemas, quarantine=aside, replace=replace)
    assert found["status"] == "failed" and "no row converts" in found["detail"]
    assert [tuple(r) for r in bene(spark, land).collect()] == [("x", 1, 1)]
    assert spark.read.parquet(f"{aside}/*.parquet").count() == 1


def test_rejects_are_those_of_the_last_run(spark, land, tmp_path):
    import os

    aside = str(tmp_path / "aside")
    schemas = {"beneficiary_2008": schema_for(["a", "n"], {"n": "bigint"})}
    land(BENE.format(1), "a,n\nx,1\nx,bad\n")
    land(BENE.format(2), "a,n\ny,2\ny,worse\n")
    run(spark, land, schemas=schemas, quarantine=aside)
    only(spark, land, BENE.format(2), "a,n\ny,2\n", schemas=schemas, quarantine=aside, replace="samples")
    place = f"{aside}/{os.listdir(aside)[0]}"
    assert [r["sample"] for r in spark.read.parquet(place).collect()] == [1]
    only(spark, land, BENE.format(1), "a,n\nx,1\n", schemas=schemas, quarantine=aside)
    assert os.listdir(aside) == []


def test_in_place_failure_keeps_the_old_files(spark, tmp_path):
    target = str(tmp_path / "x.parquet")
    old = spark.range(4).select("id", F.lit(1).alias("sample"))
    lake.overwrite_dataset(old, target, 10)
    broken = old.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("late")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="late"):
        lake.overwrite_dataset(broken, target, 10)
    assert spark.read.parquet(target).count() == 4


@pytest.mark.parametrize("replace", ["in_place", "snapshot", "snapshot_samples"])
def test_a_failing_second_step_takes_the_new_rows_back(spark, land, tmp_path, replace):
    """Rejects cannot be set aside, so the step after the rows are written fails."""
    schemas = {"beneficiary_2008": schema_for(["a", "n"], {"n": "bigint"})}
    convert_one(spark, land, "a,n\nx,1\ny,2\n", schemas=schemas)
    blocked = tmp_path / "blocked"
    blocked.write_text("no folder")
    found = convert_one(spark, land, "a,n\nz,3\nz,bad\n", schemas=schemas, quarantine=f"{blocked}/q", replace=replace)
    assert found["status"] == "failed"
    assert sorted(tuple(r) for r in bene(spark, land).collect()) == [("x", 1, 1), ("y", 2, 1)]
