import zipfile

import pytest

from claimbrook.plans.convert import Options, convert_archives
from claimbrook.sources import archives, lake, manifest
from claimbrook.sources.inventory import archive_files

BENE = "DE1_0_2008_Beneficiary_Summary_File_Sample_{}.csv"
OUT = "DE1_0_2008_Beneficiary_Summary_File.parquet"


@pytest.fixture
def zips(tmp_path):
    folder = tmp_path / "zip_files"
    folder.mkdir()

    def write(name, members):
        with zipfile.ZipFile(folder / name, "w", zipfile.ZIP_DEFLATED) as z:
            for member, text in members.items():
                z.writestr(member, text)

    write.folder = folder
    return write


def convert(spark, zips, tmp_path, source=None, **options):
    results = convert_archives(
        spark, str(zips.folder), str(tmp_path / "lake"), str(tmp_path / "work"), Options(**options), **(source or {})
    )
    return {r["kind"]: r for r in results.collect()}


@pytest.mark.parametrize("run_bytes", [archives.RUN_BYTES, 0])
def test_archives_become_a_dataset(spark, zips, tmp_path, run_bytes):
    zips("a.zip", {BENE.format(1): '\ufeffBENE_ID,N\r\n0001,2\r\n"0,2",3\r\n\r\n'})
    zips("b.csv.zip", {f"sub/{BENE.format(2)}": "BENE_ID,N\n0003,4\n", "notes.txt": "x"})
    result = convert(spark, zips, tmp_path, {"run_bytes": run_bytes})["beneficiary_2008"]
    assert (result["status"], result["row_count"]) == ("written", 3)
    rows = lake.read_dataset(spark, str(tmp_path / "lake" / OUT)).collect()
    assert sorted(tuple(r) for r in rows) == [("0,2", 3, 1), ("0001", 2, 1), ("0003", 4, 2)]
    assert not list((tmp_path / "work").glob("lines-*"))


def test_partitions_are_runs_of_members(zips):
    zips("a.zip", {f"{i}.csv": "x" * 100 for i in range(6)})
    zips("b.zip", {"big.csv": "x" * 1000})
    plan = lambda most: [
        [m.name for m in run.members] for run in archives.Reader({"path": str(zips.folder), "run_bytes": most, "least_runs": 1}).partitions()
    ]
    assert plan(250) == [["0.csv", "1.csv"], ["2.csv", "3.csv"], ["4.csv", "5.csv"], ["big.csv"]]
    assert [len(x) for x in plan(10**6)] == [7] and [len(x) for x in plan(0)] == [1] * 7


def test_drift_and_bad_cells_fail(spark, zips, tmp_path):
    zips("a.zip", {BENE.format(1): "a,n\nx,1\n"})
    zips("b.zip", {BENE.format(2): "n,a\n1,x\n"})
    assert "different headers" in convert(spark, zips, tmp_path)["beneficiary_2008"]["detail"]


def test_first_sample_decides_the_types(spark, zips, tmp_path):
    zips("a.zip", {BENE.format(10): "a,n\nx,1.5\n"})
    zips("b.zip", {BENE.format(2): "a,n\nx,1\n"})
    assert "not a bigint" in convert(spark, zips, tmp_path)["beneficiary_2008"]["detail"]
    assert convert(spark, zips, tmp_path, infer="all")["beneficiary_2008"]["status"] == "written"


def test_report_on_good_broken_and_unsafe(spark, zips):
    zips("good.zip", {"a.csv": "x\n1\n", "b.csv": "y\n"})
    zips("unsafe.zip", {"../up.csv": "x\n", "/abs.csv": "x\n", "c/../../d.csv": "x", "ok.csv": "z\n"})
    (zips.folder / "broken.zip").write_bytes(b"this is no archive")
    report = archives.archive_report(archives.members(spark, str(zips.folder))).collect()
    by_name = {r["filename"]: r for r in report}
    assert by_name["good.zip"]["status"] == "extracted"
    assert by_name["good.zip"]["members"] == ["a.csv", "b.csv"]
    assert by_name["good.zip"]["bytes"] == 6
    assert by_name["broken.zip"]["status"] == "extract_failed" and by_name["broken.zip"]["detail"]
    assert by_name["unsafe.zip"]["members"] == ["ok.csv"]
    assert len(by_name["unsafe.zip"]["rejected"]) == 3


def test_broken_archive_counts_as_missing(spark, zips):
    name = "de1_0_2008_beneficiary_summary_file_sample_1.zip"
    (zips.folder / name).write_bytes(b"PK broken")
    wanted = manifest.expected_manifest(spark, [1])
    by_name = archive_files(spark, str(zips.folder))
    assert manifest.plan_fetch(wanted, by_name).count() == 7
    report = archives.archive_report(archives.members(spark, str(zips.folder)))
    planned = manifest.member_status(wanted, report).where("status = 'planned'")
    assert planned.count() == 8


def test_lines_come_in_batches(spark, zips):
    zips("a.zip", {BENE.format(1): "n\n" + "\n".join(str(i) for i in range(1000))})
    lines = archives.archive_lines(spark, str(zips.folder), batch_lines=7)
    assert lines.where("line is not null").count() == 1000
    assert lines.select("header").distinct().collect()[0]["header"] == "n"


def test_header_only_and_empty_members(spark, zips, tmp_path):
    zips("a.zip", {BENE.format(1): "a,n\n"})
    result = convert(spark, zips, tmp_path)["beneficiary_2008"]
    assert (result["status"], result["row_count"], result["column_count"]) == ("written", 0, 2)
    zips("a.zip", {BENE.format(1): ""})
    result = convert(spark, zips, tmp_path)["beneficiary_2008"]
    assert result["status"] == "failed" and "empty file" in result["detail"]


def damaged(path):
    """One wrong byte inside the first member."""
    content = bytearray(path.read_bytes())
    content[30 + content[26] + 5] ^= 0xFF
    path.write_bytes(bytes(content))


def test_going_on_without_broken_archives(spark, zips, tmp_path):
    zips("a.zip", {BENE.format(1): "a,n\nx,1\n"})
    (zips.folder / "b.zip").write_bytes(b"PK broken")
    # The first member is whole, the second is not: the archive is left out whole.
    zips("c.zip", {BENE.format(3): "a,n\n" + "y,2\n" * 50, BENE.format(4): "a,n\nz,3\n"})
    damaged(zips.folder / "c.zip")
    zips("d.zip", {BENE.format(5): b"a,n\n\xff\xfe,4\n"})
    found = convert(spark, zips, tmp_path)
    assert (found["beneficiary_2008"]["status"], found["beneficiary_2008"]["row_count"]) == ("written", 1)
    left = {n: r["status"] for n, r in found.items() if n.endswith(".zip")}
    assert left == {n: "extract_failed" for n in ("b.zip", "c.zip", "d.zip")} and all(found[n]["detail"] for n in left)
    assert not list((tmp_path / "work").glob("lines-*"))


def test_only_broken_archives(spark, zips, tmp_path):
    (zips.folder / "b.zip").write_bytes(b"")
    found = convert(spark, zips, tmp_path)
    assert found["b.zip"]["status"] == "extract_failed" and found["beneficiary_2008"]["status"] == "skipped"


def test_an_empty_folder_has_no_archives(spark, zips, tmp_path):
    assert archives.members(spark, str(zips.folder)).count() == 0
    assert {r["status"] for r in convert(spark, zips, tmp_path).values()} == {"skipped"}
