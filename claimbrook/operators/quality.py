"""Checks before analysis: keys, splits, time leakage, published counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimbrook.operators.beneficiary import ANNUAL_AMOUNTS
from claimbrook.sources.kinds import SAMPLES

# Published rows per family and year.
PUBLISHED_COUNTS = {
    "beneficiary": {2008: 2_326_856, 2009: 2_291_320, 2010: 2_255_098},
    "inpatient": {2008: 547_800, 2009: 504_941, 2010: 280_081},
    "outpatient": {2008: 5_673_808, 2009: 6_519_340, 2010: 3_633_839},
    "carrier": {2008: 34_276_324, 2009: 37_304_993, 2010: 23_282_135},
    "prescription": {2008: 39_927_827, 2009: 43_379_293, 2010: 27_778_849},
}


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; none if the rows have the grain claimed."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def split_leaks(rows: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Beneficiaries found in more than one split."""
    ends = rows.groupBy(key).agg(F.min(split).alias("_low"), F.max(split).alias("_high"))
    return ends.where(F.col("_low") < F.col("_high")).select(key)


def late_rows(features: DataFrame, date: str, index_date: str = "index_date") -> DataFrame:
    """Feature rows dated after the index date, which a model could not have known."""
    return features.where(F.col(date) > F.col(index_date))


def drop_hindsight(features: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Features without the columns known only after the year: annual totals, death date."""
    return features.drop(*ANNUAL_AMOUNTS, "BENE_DEATH_DT", *more)


def expected_counts(spark: SparkSession, counts: dict[int, int]) -> DataFrame:
    return spark.createDataFrame(sorted(counts.items()), "year int, expected long")


def count_difference(actual: DataFrame, expected: DataFrame, year: str = "year") -> DataFrame:
    """Rows found minus rows published, for each published year.

    actual has a year per row of data; it is counted before it meets the few years.
    """
    counted = actual.groupBy(F.col(year).alias("year")).agg(F.count("*").alias("n"))
    return (
        expected.join(counted, "year", "left")
        .select(
            "year",
            "expected",
            F.coalesce("n", F.lit(0)).alias("n"),
            (F.coalesce("n", F.lit(0)) - F.col("expected")).alias("diff"),
        )
    )


def missing_samples(dataset: DataFrame) -> DataFrame:
    """Samples 1 to 20 without a row."""
    spark = dataset.sparkSession
    wanted = spark.range(SAMPLES[0], SAMPLES[-1] + 1).select(F.col("id").cast("int").alias("sample"))
    have = dataset.groupBy("sample").agg(F.count("*").alias("n"))
    return wanted.join(have, "sample", "left_anti")
