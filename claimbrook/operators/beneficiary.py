"""Profiles over the beneficiary snapshot: reimbursement, conditions, coverage, amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimbrook.functions.amounts import cents

# Column groups of the beneficiary summary.
CONDITIONS = [
    "SP_ALZHDMTA", "SP_CHF", "SP_CHRNKIDN", "SP_CNCR", "SP_COPD", "SP_DEPRESSN",
    "SP_DIABETES", "SP_ISCHMCHT", "SP_OSTEOPRS", "SP_RA_OA", "SP_STRKETIA",
]
COVERAGE_MONTHS = [
    "BENE_HI_CVRAGE_TOT_MONS",
    "BENE_SMI_CVRAGE_TOT_MONS",
    "BENE_HMO_CVRAGE_TOT_MONS",
    "PLAN_CVRG_MOS_NUM",
]
ANNUAL_SETTINGS = ["IP", "OP", "CAR"]
ANNUAL_PAYERS = ["MEDREIMB", "BENRES", "PPPYMT"]
ANNUAL_AMOUNTS = [f"{p}_{s}" for s in ANNUAL_SETTINGS for p in ANNUAL_PAYERS]


def annual_totals(snapshot: DataFrame) -> DataFrame:
    """Adds cents_ip, cents_op, cents_car over payers, and cents_total over all nine."""
    def total(columns: list[str]) -> Column:
        out = F.lit(0).cast("bigint")
        for c in columns:
            out = out + F.coalesce(cents(F.col(c)), F.lit(0))
        return out

    per_setting = {
        f"cents_{s.lower()}": total([f"{p}_{s}" for p in ANNUAL_PAYERS]) for s in ANNUAL_SETTINGS
    }
    return snapshot.withColumns(per_setting | {"cents_total": total(ANNUAL_AMOUNTS)})


def reimbursement_by(snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Annual reimbursement sums per group, by payer and setting, in cents."""
    return snapshot.groupBy(*keys).agg(
        *[F.coalesce(F.sum(cents(F.col(c))), F.lit(0)).alias(f"{c}_cents") for c in ANNUAL_AMOUNTS]
    )


def condition_prevalence(
    snapshot: DataFrame, keys: Sequence[str], flags: Sequence[str], yes
) -> DataFrame:
    """Members with each condition, and members, per group. `yes` is the code for having it.

    All flags are counted in one aggregate and the small result is turned into rows.
    """
    counted = snapshot.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        *[F.count_if(F.col(f) == yes).alias(f"_yes_{i}") for i, f in enumerate(flags)],
    )
    rows = [
        F.struct(F.lit(f).alias("flag"), F.col(f"_yes_{i}").alias("n_yes"), F.col("_n").alias("n"))
        for i, f in enumerate(flags)
    ]
    return counted.select(*keys, F.inline(F.array(*rows)))


def condition_count(flags: Sequence[str], yes) -> Column:
    """Number of conditions of a person; a missing flag does not count."""
    total = F.lit(0)
    for f in flags:
        total = total + F.when(F.col(f) == yes, 1).otherwise(0)
    return total


def full_year(columns: Sequence[str]) -> Column:
    """Covered in all twelve months by every plan part named."""
    test = F.lit(True)
    for c in columns:
        test = test & F.coalesce(F.col(c) == 12, F.lit(False))
    return test


def coverage_summary(
    snapshot: DataFrame, keys: Sequence[str], months: Sequence[str]
) -> DataFrame:
    """Members, covered months, full-year members per group and plan part."""
    counted = snapshot.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        *[F.sum(c).cast("bigint").alias(f"_sum_{i}") for i, c in enumerate(months)],
        *[F.count_if(F.col(c) == 12).alias(f"_full_{i}") for i, c in enumerate(months)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("plan"),
            F.col("_n").alias("n"),
            F.col(f"_sum_{i}").alias("months"),
            F.col(f"_full_{i}").alias("n_full_year"),
        )
        for i, c in enumerate(months)
    ]
    return counted.select(*keys, F.inline(F.array(*rows)))


def sign_profile(rows: DataFrame, keys: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """Negative, zero, positive and missing amounts per group and column, in one pass."""
    aggregates = []
    for i, c in enumerate(amounts):
        aggregates += [
            F.count_if(F.col(c) < 0).alias(f"_neg_{i}"),
            F.count_if(F.col(c) == 0).alias(f"_zero_{i}"),
            F.count_if(F.col(c) > 0).alias(f"_pos_{i}"),
            F.count_if(F.col(c).isNull()).alias(f"_nul_{i}"),
        ]
    counted = rows.groupBy(*keys).agg(*aggregates)
    out = [
        F.struct(
            F.lit(c).alias("amount"),
            *[F.col(f"_{s}_{i}").alias(s) for s in ("neg", "zero", "pos", "nul")],
        )
        for i, c in enumerate(amounts)
    ]
    return counted.select(*keys, F.inline(F.array(*out)))
