"""Counts, distinct counts and sums over claims. Every aggregate combines map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimbrook.functions.amounts import cents
from claimbrook.functions.codes import pack_codes


def union_families(families: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Claims of several families under one another, the family named in a column."""
    parts = [df.select(F.lit(name).alias("family"), *columns) for name, df in families.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def claim_counts(claims: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return claims.groupBy(*keys).agg(F.count("*").alias(name))


def distinct_counts(
    rows: DataFrame, keys: Sequence[str], counted: dict[str, Column], approximate: bool = False
) -> DataFrame:
    """Distinct values of several expressions per group.

    The exact form first removes repeats by key and value, so a heavy key is spread by
    its values before anything meets on the key alone.
    """
    count = F.approx_count_distinct if approximate else F.countDistinct
    return rows.groupBy(*keys).agg(*[count(c).alias(name) for name, c in counted.items()])


def distinct_code_counts(
    claims: DataFrame, keys: Sequence[str], code_columns: list[str], name: str = "n_codes"
) -> DataFrame:
    """Distinct codes per group over numbered code columns; groups without codes are absent."""
    codes = claims.select(*keys, F.explode(pack_codes(code_columns)).alias("_code"))
    return codes.groupBy(*keys).agg(F.countDistinct("_code").alias(name))


def spend(claims: DataFrame, keys: Sequence[str], amounts: dict[str, Column]) -> DataFrame:
    """Sums in whole cents, exact in any order of the rows. Negative amounts count."""
    return claims.groupBy(*keys).agg(*[F.sum(cents(c)).alias(name) for name, c in amounts.items()])


def code_counts(claims: DataFrame, code_columns: list[str], name: str = "code") -> DataFrame:
    """How often each code occurs over all numbered columns."""
    codes = claims.select(F.explode(pack_codes(code_columns)).alias(name))
    return codes.groupBy(name).agg(F.count("*").alias("n"))


def top_codes(counts: DataFrame, n: int, name: str = "code") -> DataFrame:
    """The n most frequent codes, ties by code."""
    return counts.orderBy(F.desc("n"), name).limit(n)
