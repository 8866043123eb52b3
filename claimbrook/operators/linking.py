"""Joins between claims and beneficiaries.

Two habits keep them even when one beneficiary holds a large share of the claims:
summaries are taken before the join wherever the result is a summary, and row-level
joins spread the claims of heavy beneficiaries over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimbrook.operators.cohort import calendar, calendar_years, has_year

ID = "DESYNPUF_ID"


TARGET = 1_000_000
CLAIM = "CLM_ID"


def heavy_table(rows: DataFrame, key: str, target: int = TARGET) -> DataFrame:
    """(_heavy, _fan): values of a column on more than `target` rows, and how many tasks to
    deal each over.

    An exact count, hash-partitioned and combined map-side, that runs with the join it serves.
    It has at most one row for every `target` rows of the input: 24 bytes a million rows.
    """
    if target < 1:
        raise ValueError("target is a number of rows, at least 1")
    counts = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_heavy")).agg(F.count("*").alias("_n"))
    return counts.where(F.col("_n") > target).select("_heavy", F.ceil(F.col("_n") / target).cast("int").alias("_fan"))


def _given_table(rows: DataFrame, key: str, heavy: Sequence) -> DataFrame:
    spark = rows.sparkSession
    fan = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.createDataFrame([(k, fan) for k in heavy], f"_heavy {rows.schema[key].dataType.simpleString()}, _fan int")


def spread_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    heavy: Sequence | None = None,
    target: int = TARGET,
) -> DataFrame:
    """Join many rows to a lookup side with few rows per key.

    Rows of a heavy first key are dealt over as many tasks as it has `target` rows, by a hash
    of `spread_by` (all columns unless given; columns that tell the key's rows apart serve
    best, and no others are read for it), and only its lookup rows are repeated to meet them.
    The hash is the same on a retry. Rows without a key match nothing and are dealt out too.
    Heavy keys are counted as the join runs; pass `heavy` to name them, or an empty list where
    there are none, to save the count.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("rows are on the left: inner, left, left_semi or left_anti")
    on = list(on)
    if heavy is not None and not len(heavy) and how in ("inner", "left_semi"):
        return rows.join(lookup, on, how)
    known = F.broadcast(heavy_table(rows, on[0], target) if heavy is None else _given_table(rows, on[0], heavy))
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mark = F.xxhash64(*(spread_by or rows.columns))
    fan = F.when(F.col(on[0]).isNull(), F.lit(spread)).otherwise(F.coalesce("_fan", F.lit(1)))
    marked = rows.join(known, F.col(on[0]) == F.col("_heavy"), "left")
    dealt = marked.withColumn("_slot", F.pmod(mark, fan).cast("int")).drop("_heavy", "_fan")
    slots = F.sequence(F.lit(0), F.coalesce("_fan", F.lit(1)) - 1)
    met = lookup.join(known, F.col(on[0]) == F.col("_heavy"), "left")
    repeated = met.withColumn("_slot", F.explode(slots)).drop("_heavy", "_fan")
    return dealt.join(repeated, [*on, "_slot"], how).drop("_slot")


def _told_apart(rows: DataFrame, claim: str | None) -> list[str] | None:
    return [claim] if claim in rows.columns else None


def claims_with_beneficiary(
    claims: DataFrame,
    beneficiaries: DataFrame,
    key: str = ID,
    same_sample: bool = False,
    how: str = "inner",
    heavy: Sequence | None = None,
    claim: str | None = CLAIM,
) -> DataFrame:
    """Claim rows with the attributes of their beneficiary (one snapshot, one row per id).

    sample is taken from the claims. It joins as part of the key only on request, which
    is right where an id never occurs in two samples.
    """
    on = [key, "sample"] if same_sample else [key]
    lookup = beneficiaries
    if not same_sample and "sample" in claims.columns and "sample" in beneficiaries.columns:
        lookup = beneficiaries.drop("sample")
    return spread_join(claims, lookup, on, how, _told_apart(claims, claim), heavy)


def union_snapshots(snapshots: dict[int, DataFrame]) -> DataFrame:
    """The yearly beneficiary files as one table with a year column."""
    tagged = [df.withColumn("year", F.lit(y).cast("int")) for y, df in sorted(snapshots.items())]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def join_snapshot_year(
    per_year: DataFrame, snapshots: DataFrame, key: str = ID, how: str = "inner"
) -> DataFrame:
    """Yearly claim summaries with the snapshot of the same year.

    Both sides have one row per beneficiary and year, so no key is heavy.
    """
    return per_year.join(snapshots, [key, "year"], how)


def claims_with_snapshot_year(
    claims: DataFrame, snapshots: DataFrame, year: Column, key: str = ID, how: str = "inner", claim: str | None = CLAIM
) -> DataFrame:
    """Claim rows with the snapshot of their claim year."""
    return spread_join(claims.withColumn("year", year), snapshots, [key, "year"], how, _told_apart(claims, claim))


def attach_features(
    beneficiaries: DataFrame, features: DataFrame, key: str = ID, zero: Sequence[str] = ()
) -> DataFrame:
    """Beneficiaries as the base table with claim features; members without claims stay,
    with zero in the columns named. features has one row per beneficiary."""
    joined = beneficiaries.join(features, key, "left")
    return joined.fillna(0, list(zero)) if zero else joined


def link_snapshots(snapshots: DataFrame, years: Sequence[int], key: str = ID) -> DataFrame:
    """One row per beneficiary with a 0/1 column per snapshot year."""
    return snapshots.groupBy(key).agg(
        *[
            F.max(F.when(F.col("year") == y, 1).otherwise(0)).alias(f"y{y}")
            for y in years
        ]
    )


def widen_snapshots(
    snapshots: DataFrame, columns: Sequence[str], years: Sequence[int], key: str = ID
) -> DataFrame:
    """One row per beneficiary with each column once per snapshot year (column_year)."""
    return snapshots.groupBy(key).agg(
        *[
            F.max(F.when(F.col("year") == y, F.col(c))).alias(f"{c}_{y}")
            for c in columns
            for y in years
        ]
    )


def attrition(
    activity: DataFrame, last_year: int, key: str = ID, year: str = "year"
) -> DataFrame:
    """Beneficiary-years without activity in the year after, up to the last year covered.

    The years of a beneficiary are the bits of one long, so the activity is not joined to itself.
    """
    gone = F.filter(calendar_years(), lambda y: (y < last_year) & ~has_year(y + F.lit(1)))
    years = calendar(activity, [key], F.col(year))
    kind = activity.schema[year].dataType
    return years.select(key, F.explode(F.transform(gone, lambda y: y.cast(kind))).alias(year))


def attrition_reason(
    gone: DataFrame, deaths: DataFrame, death_date: str = "BENE_DEATH_DT", key: str = ID
) -> DataFrame:
    """Attrition rows marked death (a death date up to the end of the next year) or dropout."""
    dates = deaths.groupBy(key).agg(F.min(death_date).alias("_death"))
    died = F.floor(F.col("_death") / 10000) <= F.col("year") + 1
    return gone.join(dates, key, "left").select(
        *gone.columns, F.when(died, "death").otherwise("dropout").alias("reason")
    )


def restrict_to_cohort(
    rows: DataFrame, cohort: DataFrame, key: str = ID, heavy: Sequence | None = None, claim: str | None = CLAIM
) -> DataFrame:
    """Rows of cohort members only."""
    return spread_join(rows, cohort.select(key).distinct(), [key], "left_semi", _told_apart(rows, claim), heavy)


def claims_in_window(
    claims: DataFrame,
    index: DataFrame,
    date: str,
    before: int,
    after: int,
    key: str = ID,
    index_date: str = "index_date",
    heavy: Sequence | None = None,
    claim: str | None = CLAIM,
) -> DataFrame:
    """Claims from `before` days ahead of the index date to `after` days past it.

    The join is on the beneficiary and the window a filter on the pairs; index has one
    row per beneficiary, so there is one pair per claim. day_offset counts from the index
    date. after=0 leaves nothing later than the index date, and after=-1 nothing on it.
    """
    pairs = spread_join(claims, index.select(key, index_date), [key], spread_by=_told_apart(claims, claim), heavy=heavy)
    offset = F.datediff(F.col(date), F.col(index_date))
    return pairs.withColumn("day_offset", offset).where(
        F.col("day_offset").between(-before, after)
    )


def window_counts(
    claims: DataFrame,
    index: DataFrame,
    date: str,
    before: int,
    after: int,
    key: str = ID,
    index_date: str = "index_date",
) -> DataFrame:
    """Claims before and from the index date on, per cohort member with any in the window.

    Claims are counted per beneficiary and day first, so at most one row per calendar day
    of a beneficiary meets the index date.
    """
    daily = claims.groupBy(key, F.col(date).alias("_day")).agg(F.count("*").alias("_n"))
    offset = F.datediff(F.col("_day"), F.col(index_date))
    pairs = daily.join(index.select(key, index_date), key).withColumn("_offset", offset)
    inside = pairs.where(F.col("_offset").between(-before, after))
    return inside.groupBy(key).agg(
        F.sum(F.when(F.col("_offset") < 0, F.col("_n")).otherwise(0)).alias("n_pre"),
        F.sum(F.when(F.col("_offset") >= 0, F.col("_n")).otherwise(0)).alias("n_post"),
    )


def claims_in_episodes(
    claims: DataFrame,
    episodes: DataFrame,
    date: str,
    before: int,
    after: int,
    key: str = ID,
    index_date: str = "index_date",
    heavy: Sequence | None = None,
    claim: str | None = CLAIM,
) -> DataFrame:
    """Claims around any number of index dates per beneficiary, once for each window they are in.

    Days are cut into bins as long as a window, so a window touches two bins at most and a
    claim lies in one. Beneficiary and bin are the join key, so a beneficiary with many claims
    and many episodes has pairs only where they are near each other, and the exact window is a
    filter on those. Rows of `episodes` that repeat a beneficiary and date count once; claims
    or episodes without a date are in no window.
    """
    width = before + after + 1
    if width < 1:
        raise ValueError("the window has no days")
    day = lambda c: F.unix_date(F.col(c).cast("date"))
    bin_of = lambda d: F.floor(d / width)
    windows = episodes.select(key, index_date).where(F.col(index_date).isNotNull()).distinct()
    bins = F.sequence(bin_of(day(index_date) - before), bin_of(day(index_date) + after))
    windows = windows.withColumn("_bin", F.explode(bins))
    rows = claims.where(F.col(date).isNotNull()).withColumn("_bin", bin_of(day(date)))
    pairs = spread_join(rows, windows, [key, "_bin"], spread_by=_told_apart(claims, claim), heavy=heavy).drop("_bin")
    offset = F.datediff(F.col(date), F.col(index_date))
    return pairs.withColumn("day_offset", offset).where(F.col("day_offset").between(-before, after))
