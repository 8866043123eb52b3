"""Dates held as YYYYMMDD integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_yyyymmdd(number: Column) -> Column:
    """DATE of a YYYYMMDD integer; null where the digits are no calendar day."""
    return F.try_to_date(number.cast("string"), "yyyyMMdd")


def to_yyyymmdd(date: Column) -> Column:
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("bigint")


def year_of(number: Column) -> Column:
    """Year of a YYYYMMDD integer, valid also when month or day are not."""
    return F.floor(number / 10000).cast("int")


def in_year(number: Column, year: int) -> Column:
    """Membership of a year as an integer range, which reaches the Parquet scan."""
    return number.between(year * 10000, year * 10000 + 9999)


def days_between(start: Column, end: Column) -> Column:
    """Days from one YYYYMMDD integer to another, null when either is invalid."""
    return F.datediff(parse_yyyymmdd(end), parse_yyyymmdd(start))


def length_of_stay(
    admitted: str = "CLM_ADMSN_DT", discharged: str = "NCH_BENE_DSCHRG_DT"
) -> Column:
    return days_between(F.col(admitted), F.col(discharged))


def age_at_year_end(birth: Column, year: Column | int) -> Column:
    """Completed years on 31 December; nobody is between birthdays on that day."""
    year_col = F.lit(year) if isinstance(year, int) else year
    return F.when(
        parse_yyyymmdd(birth).isNotNull(), (year_col - year_of(birth)).cast("int")
    )


def days_to_death_or_end(
    index: Column, death: Column, study_end: int
) -> Column:
    """Follow-up days from an index date to death, or to the study end when alive.

    Null when either comes before the index date.
    """
    end = F.to_date(F.lit(str(study_end)), "yyyyMMdd")
    stop = F.least(F.coalesce(parse_yyyymmdd(death), end), end)
    days = F.datediff(stop, parse_yyyymmdd(index))
    return F.when(days >= 0, days)
