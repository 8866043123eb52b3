"""Money is stored as double; sums that must be exact are taken over whole cents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """Whole cents; a NaN counts as missing."""
    return F.round(F.when(~F.isnan(amount), amount) * 100).cast("bigint")


def keep_amount(amount: Column, drop_negative: bool = False) -> Column:
    """Filter for an amount column: negatives stay unless asked otherwise."""
    return (amount.isNull() | (amount >= 0)) if drop_negative else F.lit(True)
