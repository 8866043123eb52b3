"""The deliveries a complete release consists of, and how they compare with what is there."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimbrook.sources.kinds import SAMPLES

# Where the archives are published.
SITE = "https://www.cms.gov/"
STANDARD_PATH = "research-statistics-data-and-systems/downloadable-public-use-files/synpufs/downloads/"
LEGACY_PATH = "research-statistics-data-and-systems/statistics-trends-and-reports/synpufs/downloads/"
UPLOAD_PATH = "sites/default/files/2020-09/"
FILE_SERVER = "http://downloads.cms.gov/files/"

# Dataset, half, archive name with %s for the sample, address in front of it.
ARCHIVES = [
    ("beneficiary_2008", None, "de1_0_2008_beneficiary_summary_file_sample_%s.zip", SITE + STANDARD_PATH),
    ("beneficiary_2009", None, "de1_0_2009_beneficiary_summary_file_sample_%s.zip", SITE + STANDARD_PATH),
    ("beneficiary_2010", None, "de1_0_2010_beneficiary_summary_file_sample_%s.zip", SITE + STANDARD_PATH),
    ("carrier_claims", "A", "DE1_0_2008_to_2010_Carrier_Claims_Sample_%sA.zip", FILE_SERVER),
    ("carrier_claims", "B", "DE1_0_2008_to_2010_Carrier_Claims_Sample_%sB.zip", FILE_SERVER),
    ("inpatient_claims", None, "de1_0_2008_to_2010_inpatient_claims_sample_%s.zip", SITE + STANDARD_PATH),
    ("outpatient_claims", None, "de1_0_2008_to_2010_outpatient_claims_sample_%s.zip", SITE + STANDARD_PATH),
    ("prescription_drug_events", None, "DE1_0_2008_to_2010_Prescription_Drug_Events_Sample_%s.zip", FILE_SERVER),
]

# The four archives that are named or placed differently
# (dataset, half, sample) -> (archive name, address).
EXCEPTIONS = {
    ("beneficiary_2010", None, 1): ("DE1_0_2010_Beneficiary_Summary_File_Sample_1.zip", SITE + UPLOAD_PATH),
    ("beneficiary_2008", None, 20): ("de1_0_2008_beneficiary_summary_file_sample_20.zip", SITE + LEGACY_PATH),
    ("inpatient_claims", None, 20): ("de1_0_2008_to_2010_inpatient_claims_sample_20.zip", SITE + LEGACY_PATH),
    ("carrier_claims", "A", 11): ("DE1_0_2008_to_2010_Carrier_Claims_Sample_11A.csv.zip", FILE_SERVER),
}


def pick_samples(samples: Iterable[int] | None = None, everything: bool = False) -> list[int]:
    """Requested samples in request order without repeats; `everything` beats a list."""
    if everything:
        return list(SAMPLES)
    if samples is None:
        raise ValueError("name the samples wanted, or ask for everything")
    picked: list[int] = []
    for sample in samples:
        if sample not in SAMPLES:
            raise ValueError(f"sample {sample} is not between {SAMPLES[0]} and {SAMPLES[-1]}")
        if sample not in picked:
            picked.append(sample)
    return picked


def expected_manifest(spark: SparkSession, samples: Iterable[int]) -> DataFrame:
    """Expected archives, eight per sample, at most 160 rows.

    position gives the order of the request: sample by sample, datasets as listed.
    """
    wanted = pick_samples(samples)
    specs = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                F.lit(half).cast("string").alias("part"),
                F.lit(name).alias("name"),
                F.lit(address).alias("address"),
            )
            for kind, half, name, address in ARCHIVES
        ]
    )
    rows = (
        spark.range(1)
        .select(F.posexplode(F.array(*[F.lit(s) for s in wanted])).alias("request", "sample"))
        .select("request", "sample", F.posexplode(specs).alias("spec_no", "spec"))
        .select("*", "spec.*")
    )
    filename = F.replace(F.col("name"), F.lit("%s"), F.col("sample").cast("string"))
    address = F.col("address")
    for (kind, half, sample), (other_name, other_address) in EXCEPTIONS.items():
        here = (
            (F.col("kind") == kind) & F.col("part").eqNullSafe(half) & (F.col("sample") == sample)
        )
        filename = F.when(here, other_name).otherwise(filename)
        address = F.when(here, other_address).otherwise(address)
    return rows.select(
        (F.col("request") * len(ARCHIVES) + F.col("spec_no")).alias("position"),
        "sample",
        F.col("kind").alias("file_kind"),
        F.col("kind").alias("dataset_kind"),
        "part",
        filename.alias("filename"),
        F.concat(address, filename).alias("url"),
    )


def _present(manifest: DataFrame, archives: DataFrame) -> DataFrame:
    """Expected names that are there: never more rows than the manifest has."""
    names = manifest.select("filename")
    return archives.select("filename").join(F.broadcast(names), "filename", "left_semi").distinct()


def plan_fetch(
    manifest: DataFrame,
    archives: DataFrame,
    validate_only: bool = False,
    skip_existing: bool = True,
) -> DataFrame:
    """Archives still to be fetched; all of them when validating or starting over."""
    if validate_only or not skip_existing:
        return manifest
    return manifest.join(_present(manifest, archives), "filename", "left_anti").select(
        *manifest.columns
    )


def fetch_status(manifest: DataFrame, archives: DataFrame) -> DataFrame:
    """Every expected archive with status 'skipped' (there already) or 'planned'."""
    present = _present(manifest, archives).withColumn("present", F.lit(True))
    status = F.when(F.col("present"), "skipped").otherwise("planned")
    return (
        manifest.join(present, "filename", "left")
        .withColumn("status", status)
        .withColumn("detail", F.when(F.col("present"), "Skipped existing archive").otherwise(""))
        .select(*manifest.columns, "status", "detail")
    )


def member_status(manifest: DataFrame, archive_report: DataFrame) -> DataFrame:
    """Status by what an archive really holds, so a broken archive counts as not there."""
    good = archive_report.where("status = 'extracted'").select("filename")
    return fetch_status(manifest, good)


def missing_deliveries(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """Expected (dataset, sample, half) combinations without an accepted CSV delivery."""
    keys = ["dataset_kind", "sample", "part_key"]
    wanted = manifest.withColumn("part_key", F.coalesce("part", F.lit("")))
    have = (
        inventory.where("reject_reason is null")
        .select(
            F.col("kind").alias("dataset_kind"),
            "sample",
            F.coalesce("part", F.lit("")).alias("part_key"),
        )
        .distinct()
    )
    return wanted.join(have, keys, "left_anti").select("position", "dataset_kind", "sample", "part")
