import pytest

from claimbrook.plans.convert import conversion_summary, delivery_failures, delivery_summary
from claimbrook.sources import inventory, manifest
from claimbrook.sources.kinds import KINDS, family_schema, field_catalog, kinds_table


def test_samples_keep_request_order():
    assert manifest.pick_samples([3, 1, 3, 20]) == [3, 1, 20]
    assert manifest.pick_samples([3], everything=True) == list(range(1, 21))
    with pytest.raises(ValueError):
        manifest.pick_samples(None)


@pytest.mark.parametrize("sample", [0, 21, -1])
def test_samples_out_of_range(sample):
    with pytest.raises(ValueError):
        manifest.pick_samples([sample])


def test_manifest_has_its_exceptions(spark):
    rows = manifest.expected_manifest(spark, [1, 11, 20]).collect()
    assert len(rows) == 24
    found = {(r["sample"], r["dataset_kind"], r["part"]): r for r in rows}
    upper = found[1, "beneficiary_2010", None]
    assert upper["filename"] == "DE1_0_2010_Beneficiary_Summary_File_Sample_1.zip"
    assert "/sites/default/files/2020-09/" in upper["url"]
    assert "/statistics-trends-and-reports/" in found[20, "beneficiary_2008", None]["url"]
    assert "/statistics-trends-and-reports/" in found[20, "inpatient_claims", None]["url"]
    assert "/statistics-trends-and-reports/" not in found[20, "outpatient_claims", None]["url"]
    assert found[11, "carrier_claims", "A"]["filename"].endswith("_11A.csv.zip")
    assert found[11, "carrier_claims", "B"]["filename"].endswith("_11B.zip")
    assert found[1, "carrier_claims", "A"]["url"].startswith("http://downloads.cms.gov/files/")
    assert all(r["url"].endswith(r["filename"]) for r in rows)
    ordered = sorted(rows, key=lambda r: r["position"])
    assert [r["sample"] for r in ordered] == [1] * 8 + [11] * 8 + [20] * 8
    assert ordered[0]["dataset_kind"] == "beneficiary_2008"


def test_plan_leaves_out_what_is_there(spark):
    wanted = manifest.expected_manifest(spark, [1])
    name = "de1_0_2008_beneficiary_summary_file_sample_1.zip"
    there = spark.createDataFrame([(name,), (name,), ("other.zip",)], "filename string")
    assert manifest.plan_fetch(wanted, there).count() == 7
    assert manifest.plan_fetch(wanted, there, validate_only=True).count() == 8
    assert manifest.plan_fetch(wanted, there, skip_existing=False).count() == 8
    upper = spark.createDataFrame([(name.upper(),)], "filename string")
    assert manifest.plan_fetch(wanted, upper).count() == 8
    status = manifest.fetch_status(wanted, there).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in status} == {"skipped": 1, "planned": 7}


def test_status_counts(spark):
    rows = [("skipped", 0), ("extracted", 5), ("extract_failed", 1), ("download_failed", 0), ("validated", 0)]
    results = spark.createDataFrame(rows, "status string, bytes long")
    assert delivery_summary(results).first().asDict() == {
        "total_files": 5, "skipped_files": 1, "attempted_files": 4, "successful_downloads": 2,
        "failed_downloads": 1, "successful_extractions": 1, "failed_extractions": 1,
        "validated_files": 1, "failed_validations": 1,
    }
    assert delivery_failures(results).count() == 2
    done = spark.createDataFrame([("written",), ("failed",), ("skipped",)], "status string")
    assert tuple(conversion_summary(done).first()) == (1, 1, 1)


def test_names_are_parsed(spark):
    names = [
        ("DE1_0_2008_Beneficiary_Summary_File_Sample_1.csv", "beneficiary_2008", 1, None, None),
        ("DE1_0_2008_to_2010_Carrier_Claims_Sample_1A.csv", "carrier_claims", 1, "A", None),
        ("DE1_0_2008_to_2010_Carrier_Claims_Sample_1B.csv", "carrier_claims", 1, "B", None),
        ("DE1_0_2008_to_2010_Carrier_Claims_Sample_1.csv", None, None, None, "unrecognised file name"),
        ("DE1_0_2008_to_2010_Inpatient_Claims_Sample_2A.csv", None, None, None, "unrecognised file name"),
        ("DE1_0_2008_to_2010_Inpatient_Claims_Sample_07.csv", "inpatient_claims", 7, None, None),
        ("DE1_0_2008_to_2010_Inpatient_Claims_Sample_21.csv", "inpatient_claims", 21, None, "sample out of range"),
        ("DE1_0_2008_to_2010_Inpatient_Claims_Sample_99999999999.csv", "inpatient_claims", None, None, "sample out of range"),
        ("de1_0_2008_beneficiary_summary_file_sample_1.csv", None, None, None, "unrecognised file name"),
        ("ignored.csv", None, None, None, "unrecognised file name"),
    ]
    got = inventory.parse_names(spark.createDataFrame([(n[0],) for n in names], "file_name string"))
    by_name = {r["file_name"]: tuple(r)[1:] for r in got.collect()}
    assert by_name == {n[0]: n[1:] for n in names}


def test_kinds_and_families(spark):
    table = {r["kind"]: r for r in kinds_table(spark).collect()}
    assert len(table) == 7 and KINDS[-1].name == "carrier_claims"
    assert table["carrier_claims"]["max_rows_per_file"] == 2_000_000
    assert table["inpatient_claims"]["max_rows_per_file"] == 1_000_000
    assert table["carrier_claims"]["output_name"] == "DE1_0_2008_to_2010_Carrier_Claims.parquet"
    widths = {f: len(family_schema(f)) for f in {k.family for k in KINDS}}
    assert widths == {"beneficiary": 32, "inpatient": 81, "outpatient": 76, "carrier": 142, "prescription": 8}
    strings = {
        f: sum(1 for c in family_schema(f) if c.metadata["semantic"] == "string_code") for f in widths
    }
    assert strings == {"beneficiary": 4, "inpatient": 68, "outpatient": 67, "carrier": 62, "prescription": 3}
    carrier = family_schema("carrier")
    assert carrier["TAX_NUM_3"].dataType.simpleString() == "bigint"
    assert carrier["LINE_NCH_PMT_AMT_13"].dataType.simpleString() == "double"
    assert family_schema("inpatient")["NCH_BENE_PTA_COINSRNC_LBLTY_AM"].dataType.simpleString() == "double"
    where = field_catalog(spark).where("column = 'HCPCS_CD_1'").collect()
    assert sorted(r["family"] for r in where) == ["carrier", "inpatient", "outpatient"]
