"""Cohorts: index dates, washout, follow-up, splits.

Where an order of claims matters, claims are reduced to one row per beneficiary and day
first. A window then sees at most the calendar days of a beneficiary, however many claims.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimbrook.functions.splits import split_of

ID = "DESYNPUF_ID"
SPAN = 64


def calendar(rows: DataFrame, keys: Sequence[str], year: Column) -> DataFrame:
    """(keys, _low, _high, _bits): the years of a group as one long, a bit for each year.

    Year y has bit y mod 64, which tells years apart where a group spans no more than 64 of
    them; a longer span is an error. Fixed-size buffers: a hash aggregate with one shuffle.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(year, F.lit(SPAN)).cast("int"))
    found = rows.groupBy(*keys).agg(
        F.min(year).cast("int").alias("_low"), F.max(year).cast("int").alias("_high"), F.bit_or(bit).alias("_bits")
    )
    told = F.raise_error(F.concat(F.lit("years of one group span more than 64: "), F.col("_low"), F.lit(" to "), F.col("_high")))
    checked = F.when(F.col("_high") - F.col("_low") >= SPAN, told.cast("bigint")).otherwise(F.col("_bits"))
    return found.withColumn("_bits", checked)


def has_year(year: Column) -> Column:
    """Whether a calendar's group has a year."""
    inside = year.between(F.col("_low"), F.col("_high"))
    return inside & (F.getbit("_bits", F.pmod(year, F.lit(SPAN)).cast("int")) == 1)


def calendar_years() -> Column:
    """The years of a calendar's group, ascending; none for a group without any."""
    every = F.sequence("_low", "_high")
    return F.when(F.col("_low").isNotNull(), F.filter(every, has_year)).otherwise(F.array().cast("array<int>"))


def index_claims(
    claims: DataFrame,
    date: str,
    claim: str = "CLM_ID",
    key: str = ID,
    qualifies: Column | None = None,
    index_date: str = "index_date",
    keep: Sequence[str] = (),
) -> DataFrame:
    """First qualifying claim per beneficiary, ties by claim id; undated claims never qualify.

    A smallest-row aggregate, which combines map-side, in the place of ranking all claims.
    """
    chosen = claims.where(F.col(date).isNotNull())
    if qualifies is not None:
        chosen = chosen.where(qualifies)
    first = F.min(F.struct(F.col(date).alias(index_date), F.col(claim), *keep))
    out = chosen.groupBy(key).agg(first.alias("_first"))
    return out.select(key, "_first.*")


def washed_out_claims(
    claims: DataFrame, date: str, days: int, claim: str = "CLM_ID", key: str = ID
) -> DataFrame:
    """Claims with no earlier claim of the beneficiary in the `days` days before.

    On a day with several claims only the one with the smallest id can be such a claim.
    """
    daily = (
        claims.where(F.col(date).isNotNull())
        .groupBy(key, date)
        .agg(F.min(claim).alias(claim))
    )
    previous = F.lag(date).over(Window.partitionBy(key).orderBy(date))
    marked = daily.withColumn("_previous", previous)
    quiet = F.col("_previous").isNull() | (F.datediff(date, "_previous") > days)
    return marked.where(quiet).select(key, claim, date)


def follow_up(claims: DataFrame, date: str, year: Column, key: str = ID) -> DataFrame:
    """First and last claim date and number of years with claims, per beneficiary."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(year, F.lit(SPAN)).cast("int"))
    return claims.groupBy(key).agg(
        F.min(date).alias("first_dt"),
        F.max(date).alias("last_dt"),
        F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)).cast("bigint").alias("n_years"),
    )


def days_to_next(claims: DataFrame, date: str, key: str = ID) -> DataFrame:
    """Per beneficiary and service day: claims, and days until the next service day."""
    daily = (
        claims.where(F.col(date).isNotNull()).groupBy(key, date).agg(F.count("*").alias("n"))
    )
    following = F.lead(date).over(Window.partitionBy(key).orderBy(date))
    return daily.withColumn("gap_days", F.datediff(following, F.col(date)))


def year_presence(claims: DataFrame, year: Column, key: str = ID) -> DataFrame:
    """Per beneficiary and year with claims: whether there were claims the year after."""
    entries = F.transform(
        calendar_years(), lambda y: F.struct(y.alias("year"), has_year(y + F.lit(1)).alias("next_year"))
    )
    return calendar(claims, [key], year).select(key, F.inline(entries))


def with_split(rows: DataFrame, key: str = ID, shares: dict[str, int] | None = None) -> DataFrame:
    """Rows with the split of their beneficiary."""
    return rows.withColumn("split", split_of(F.col(key), shares))
