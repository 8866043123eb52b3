"""Repeatable assignment of beneficiaries to data splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SHARES = {"train": 70, "validation": 15, "test": 15}


def split_bucket(beneficiary: Column, buckets: int = 100) -> Column:
    """Bucket from the id alone, so every row of a beneficiary gets the same one."""
    digest = F.substring(F.md5(beneficiary.cast("string")), 1, 8)
    return (F.conv(digest, 16, 10).cast("bigint") % buckets).cast("int")


def split_of(beneficiary: Column, shares: dict[str, int] | None = None) -> Column:
    """Split name from percent shares, which have to add up to 100."""
    shares = dict(shares or DEFAULT_SHARES)
    if sum(shares.values()) != 100 or min(shares.values()) < 0:
        raise ValueError("split shares must be non-negative and add up to 100")
    bucket = split_bucket(beneficiary)
    names = list(shares)
    upper, chosen = 0, None
    for name in names[:-1]:
        upper += shares[name]
        test = bucket < upper
        chosen = F.when(test, name) if chosen is None else chosen.when(test, name)
    last = F.lit(names[-1])
    return last if chosen is None else chosen.otherwise(last)
