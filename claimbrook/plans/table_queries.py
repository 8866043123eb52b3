"""Queries of the claims operators on the sample tables.

customer stands for the beneficiary snapshot, orders for claim headers, lineitem for claim
lines, events for prescription events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimbrook.functions import dates
from claimbrook.functions.amounts import cents, keep_amount
from claimbrook.functions.codes import (
    block,
    distinct_codes,
    has_any_code,
    normalise_code,
    pack_codes,
)
from claimbrook.functions.splits import split_of
from claimbrook.operators import beneficiary, cohort, lines, linking, quality, utilization
from claimbrook.plans.registry import query, table

YEARS = (1995, 1996, 1997)
URGENT = "1-URGENT"


def _claims(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as claims: a service day and its year beside the stored columns."""
    orders = table(spark, folder, "orders")
    return orders.withColumns({"svc_date": F.to_date("o_orderdate"), "yr": _year("o_orderdate")})


def _year(column: str) -> Column:
    return F.year(column).cast("int")


@query(
    "q_claims_by_bene_year",
    "SELECT o_custkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS yr, COUNT(*) AS n "
    "FROM orders GROUP BY 1,2",
)
def claims_by_bene_year(spark: SparkSession, folder: str) -> DataFrame:
    return utilization.claim_counts(_claims(spark, folder), ["o_custkey", "yr"])


@query(
    "q_family_counts",
    """
    SELECT family, id, yr, COUNT(*) AS n FROM (
      SELECT 'carrier' AS family, o_custkey AS id, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS yr
      FROM orders
      UNION ALL
      SELECT 'prescription', user_id, CAST(EXTRACT(YEAR FROM ts) AS INT) FROM events) t
    GROUP BY 1,2,3
    """,
)
def family_counts(spark: SparkSession, folder: str) -> DataFrame:
    carrier = _claims(spark, folder).select(F.col("o_custkey").alias("id"), "yr")
    drugs = table(spark, folder, "events").select(
        F.col("user_id").alias("id"), _year("ts").alias("yr")
    )
    rows = utilization.union_families({"carrier": carrier, "prescription": drugs}, ["id", "yr"])
    return utilization.claim_counts(rows, ["family", "id", "yr"])


@query(
    "q_distinct_features",
    """
    SELECT o_custkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS yr,
      COUNT(DISTINCT CAST(l_shipdate AS DATE)) AS n_dates,
      COUNT(DISTINCT l_suppkey) AS n_prov, COUNT(DISTINCT l_partkey) AS n_codes
    FROM orders JOIN lineitem ON o_orderkey=l_orderkey GROUP BY 1,2
    """,
)
def distinct_features(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_shipdate", "l_suppkey", "l_partkey"
    )
    headers = _claims(spark, folder).select("o_orderkey", "o_custkey", "yr")
    # A claim has few lines, so no header key is heavy.
    joined = linking.spread_join(items, headers, ["o_orderkey"], heavy=[])
    return utilization.distinct_counts(
        joined,
        ["o_custkey", "yr"],
        {
            "n_dates": F.to_date("l_shipdate"),
            "n_prov": F.col("l_suppkey"),
            "n_codes": F.col("l_partkey"),
        },
    )


@query(
    "q_spend_by_bene_year",
    """
    SELECT o_custkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS yr,
      CAST(SUM(CAST(ROUND(o_totalprice*100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders GROUP BY 1,2
    """,
)
def spend_by_bene_year(spark: SparkSession, folder: str) -> DataFrame:
    return utilization.spend(
        _claims(spark, folder), ["o_custkey", "yr"], {"cents": F.col("o_totalprice")}
    )


@query(
    "q_bene_features",
    """
    SELECT c_custkey, c_mktsegment, COALESCE(n,0) AS n, COALESCE(cents,0) AS cents
    FROM customer LEFT JOIN (
      SELECT o_custkey, COUNT(*) AS n,
        CAST(SUM(CAST(ROUND(o_totalprice*100) AS BIGINT)) AS BIGINT) AS cents
      FROM orders WHERE CAST(EXTRACT(YEAR FROM o_orderdate) AS INT)=1996 GROUP BY 1) f
    ON c_custkey=o_custkey
    """,
)
def bene_features(spark: SparkSession, folder: str) -> DataFrame:
    in_1996 = F.col("o_orderdate").between(
        F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31 23:59:59.999999").cast("timestamp_ntz")
    )
    features = (
        table(spark, folder, "orders")
        .where(in_1996)
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n"), F.sum(cents(F.col("o_totalprice"))).alias("cents"))
    )
    members = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return linking.attach_features(members, features, "c_custkey", zero=["n", "cents"])


@query(
    "q_claim_bene_join",
    """
    SELECT c_mktsegment, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS yr, COUNT(*) AS n,
      COUNT(DISTINCT c_custkey) AS n_bene,
      CAST(SUM(CAST(ROUND(o_totalprice*100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1,2
    """,
)
def claim_bene_join(spark: SparkSession, folder: str) -> DataFrame:
    # Claims shrink to one row per beneficiary and year before they meet the snapshot.
    per_year = (
        _claims(spark, folder)
        .groupBy(F.col("o_custkey").alias("c_custkey"), "yr")
        .agg(F.count("*").alias("n"), F.sum(cents(F.col("o_totalprice"))).alias("cents"))
    )
    members = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return (
        per_year.join(members, "c_custkey")
        .groupBy("c_mktsegment", "yr")
        .agg(F.sum("n").alias("n"), F.count("*").alias("n_bene"), F.sum("cents").alias("cents"))
    )


@query(
    "q_claim_rows_linked",
    """
    SELECT o_orderkey, o_custkey, c_mktsegment, c_nationkey
    FROM orders JOIN customer ON o_custkey=c_custkey
    """,
)
def claim_rows_linked(spark: SparkSession, folder: str) -> DataFrame:
    claims = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    members = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey"
    )
    return linking.claims_with_beneficiary(claims, members, "o_custkey", claim="o_orderkey")


_SNAPSHOT_SQL = """
    snapshots AS (
      SELECT c_custkey AS id, CAST(y AS INT) AS year, c_mktsegment,
        CAST((c_custkey + y) % 13 AS BIGINT) AS months FROM customer,
      (SELECT 1995 AS y UNION ALL SELECT 1996 UNION ALL SELECT 1997) years)
"""


def _snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Three yearly files out of customer; covered months differ from year to year."""
    members = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), "c_mktsegment"
    )
    return linking.union_snapshots(
        {y: members.withColumn("months", (F.col("id") + y) % 13) for y in YEARS}
    )


@query(
    "q_snapshot_year_join",
    f"""
    WITH {_SNAPSHOT_SQL}, per_year AS (
      SELECT o_custkey AS id, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS year, COUNT(*) AS n
      FROM orders GROUP BY 1,2)
    SELECT p.id, p.year, p.n, s.c_mktsegment, s.months FROM per_year p
    JOIN snapshots s ON p.id=s.id AND p.year=s.year
    """,
)
def snapshot_year_join(spark: SparkSession, folder: str) -> DataFrame:
    claims = _claims(spark, folder).select(F.col("o_custkey").alias("id"), F.col("yr").alias("year"))
    per_year = utilization.claim_counts(claims, ["id", "year"])
    return linking.join_snapshot_year(per_year, _snapshots(spark, folder), "id")


@query(
    "q_claim_rows_snapshot_year",
    f"""
    WITH {_SNAPSHOT_SQL}
    SELECT o_orderkey, o.o_custkey AS id, s.year, s.c_mktsegment, s.months FROM orders o
    JOIN snapshots s ON o.o_custkey=s.id AND CAST(EXTRACT(YEAR FROM o_orderdate) AS INT)=s.year
    """,
)
def claim_rows_snapshot_year(spark: SparkSession, folder: str) -> DataFrame:
    claims = _claims(spark, folder).select("o_orderkey", F.col("o_custkey").alias("id"), "yr")
    return linking.claims_with_snapshot_year(
        claims, _snapshots(spark, folder), F.col("yr"), "id", claim="o_orderkey"
    ).drop("yr")


@query(
    "q_snapshot_union",
    f"""
    WITH {_SNAPSHOT_SQL}
    SELECT year, COUNT(*) AS n, CAST(SUM(months) AS BIGINT) AS months FROM snapshots GROUP BY 1
    """,
)
def snapshot_union(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _snapshots(spark, folder)
        .groupBy("year")
        .agg(F.count("*").alias("n"), F.sum("months").alias("months"))
    )


@query(
    "q_snapshot_link",
    """
    SELECT o_custkey,
      MAX(CASE WHEN CAST(EXTRACT(YEAR FROM o_orderdate) AS INT)=1995 THEN 1 ELSE 0 END) AS y1995,
      MAX(CASE WHEN CAST(EXTRACT(YEAR FROM o_orderdate) AS INT)=1996 THEN 1 ELSE 0 END) AS y1996,
      MAX(CASE WHEN CAST(EXTRACT(YEAR FROM o_orderdate) AS INT)=1997 THEN 1 ELSE 0 END) AS y1997
    FROM orders GROUP BY 1
    """,
)
def snapshot_link(spark: SparkSession, folder: str) -> DataFrame:
    rows = _claims(spark, folder).select("o_custkey", F.col("yr").alias("year"))
    return linking.link_snapshots(rows, YEARS, "o_custkey")


@query(
    "q_snapshot_wide",
    f"""
    WITH {_SNAPSHOT_SQL}
    SELECT id, MAX(CASE WHEN year=1995 THEN months END) AS months_1995,
      MAX(CASE WHEN year=1996 THEN months END) AS months_1996,
      MAX(CASE WHEN year=1997 THEN months END) AS months_1997
    FROM snapshots GROUP BY 1
    """,
)
def snapshot_wide(spark: SparkSession, folder: str) -> DataFrame:
    return linking.widen_snapshots(_snapshots(spark, folder), ["months"], YEARS, "id")


@query(
    "q_attrition",
    """
    WITH p AS (
      SELECT DISTINCT o_custkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS yr FROM orders)
    SELECT a.o_custkey, a.yr FROM p a LEFT JOIN p b ON a.o_custkey=b.o_custkey AND b.yr=a.yr+1
    WHERE b.yr IS NULL AND a.yr<2001
    """,
)
def attrition(spark: SparkSession, folder: str) -> DataFrame:
    return linking.attrition(_claims(spark, folder), 2001, "o_custkey", "yr")


@query(
    "q_attrition_reason",
    """
    WITH p AS (
      SELECT DISTINCT o_custkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS year FROM orders),
    deaths AS (
      SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 1996 + c_custkey % 5 END AS death_year
      FROM customer)
    SELECT a.o_custkey, a.year,
      CASE WHEN d.death_year <= a.year + 1 THEN 'death' ELSE 'dropout' END AS reason
    FROM p a LEFT JOIN p b ON a.o_custkey=b.o_custkey AND b.year=a.year+1
    LEFT JOIN deaths d ON d.c_custkey=a.o_custkey
    WHERE b.year IS NULL AND a.year<2001
    """,
)
def attrition_reason(spark: SparkSession, folder: str) -> DataFrame:
    death_date = (F.lit(1996) + F.col("c_custkey") % 5) * 10000 + 701
    deaths = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.when(F.col("c_custkey") % 3 == 0, death_date).alias("BENE_DEATH_DT"),
    )
    rows = _claims(spark, folder).select("o_custkey", F.col("yr").alias("year"))
    gone = linking.attrition(rows, 2001, "o_custkey")
    return linking.attrition_reason(gone, deaths, key="o_custkey")


_CODES = [1, 2, 3, 5, 8]


@query(
    "q_cohort_semi",
    """
    SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (
      SELECT o_custkey FROM orders JOIN lineitem ON o_orderkey=l_orderkey
      WHERE l_partkey IN (1,2,3,5,8))
    """,
)
def cohort_semi(spark: SparkSession, folder: str) -> DataFrame:
    coded = table(spark, folder, "lineitem").where(has_any_code(["l_partkey"], _CODES))
    claims = coded.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    members = (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey")
        .join(claims, "o_orderkey", "left_semi")
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    people = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return people.join(members.distinct(), "c_custkey", "left_semi")


@query(
    "q_cohort_claims",
    """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
      SELECT c_custkey FROM customer WHERE c_mktsegment='BUILDING')
    """,
)
def cohort_claims(spark: SparkSession, folder: str) -> DataFrame:
    members = (
        table(spark, folder, "customer")
        .where("c_mktsegment = 'BUILDING'")
        .select(F.col("c_custkey").alias("o_custkey"))
    )
    claims = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return linking.restrict_to_cohort(claims, members, "o_custkey", claim="o_orderkey")


_INDEX_SQL = """
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS idx FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM orders WHERE o_orderpriority='1-URGENT') t WHERE rn=1
"""


def _index(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.index_claims(
        _claims(spark, folder),
        "svc_date",
        "o_orderkey",
        "o_custkey",
        qualifies=F.col("o_orderpriority") == URGENT,
        index_date="idx",
    )


@query("q_index_date", _INDEX_SQL)
def index_date(spark: SparkSession, folder: str) -> DataFrame:
    return _index(spark, folder)


@query(
    "q_washout",
    """
    SELECT o_custkey, o_orderkey FROM (
      SELECT *, LAG(CAST(o_orderdate AS DATE)) OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders) t
    WHERE prev IS NULL OR CAST(o_orderdate AS DATE) > prev + INTERVAL '180' DAY
    """,
)
def washout(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.washed_out_claims(
        _claims(spark, folder), "svc_date", 180, "o_orderkey", "o_custkey"
    ).drop("svc_date")


@query(
    "q_window_join",
    f"""
    WITH i AS ({_INDEX_SQL})
    SELECT i.o_custkey, COUNT(CASE WHEN CAST(c.o_orderdate AS DATE)<i.idx THEN 1 END) AS n_pre,
      COUNT(CASE WHEN CAST(c.o_orderdate AS DATE)>=i.idx THEN 1 END) AS n_post
    FROM i JOIN orders c ON c.o_custkey=i.o_custkey AND CAST(c.o_orderdate AS DATE)
      BETWEEN i.idx - INTERVAL '180' DAY AND i.idx + INTERVAL '365' DAY GROUP BY 1
    """,
)
def window_join(spark: SparkSession, folder: str) -> DataFrame:
    return linking.window_counts(
        _claims(spark, folder), _index(spark, folder), "svc_date", 180, 365, "o_custkey", "idx"
    )


@query(
    "q_window_rows",
    f"""
    WITH i AS ({_INDEX_SQL})
    SELECT c.o_orderkey, c.o_custkey,
      CAST(DATEDIFF('day', i.idx, CAST(c.o_orderdate AS DATE)) AS INT) AS day_offset
    FROM i JOIN orders c ON c.o_custkey=i.o_custkey AND CAST(c.o_orderdate AS DATE)
      BETWEEN i.idx - INTERVAL '180' DAY AND i.idx
    """,
)
def window_rows(spark: SparkSession, folder: str) -> DataFrame:
    claims = _claims(spark, folder).select("o_orderkey", "o_custkey", "svc_date")
    rows = linking.claims_in_window(
        claims, _index(spark, folder), "svc_date", 180, 0, "o_custkey", "idx", claim="o_orderkey"
    )
    return rows.select("o_orderkey", "o_custkey", "day_offset")


@query(
    "q_episode_windows",
    """
    WITH e AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS idx FROM orders WHERE o_orderpriority='1-URGENT')
    SELECT c.o_orderkey, c.o_custkey, e.idx, CAST(DATEDIFF('day', e.idx, CAST(c.o_orderdate AS DATE)) AS INT) AS day_offset
    FROM e JOIN orders c ON c.o_custkey=e.o_custkey AND CAST(c.o_orderdate AS DATE)
      BETWEEN e.idx - INTERVAL '30' DAY AND e.idx + INTERVAL '90' DAY
    """,
)
def episode_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Every urgent claim opens an episode; claims are in each episode they are near to."""
    claims = _claims(spark, folder)
    episodes = claims.where(F.col("o_orderpriority") == URGENT).select("o_custkey", F.col("svc_date").alias("idx"))
    rows = linking.claims_in_episodes(
        claims.select("o_orderkey", "o_custkey", "svc_date"), episodes, "svc_date", 30, 90, "o_custkey", "idx", claim="o_orderkey"
    )
    return rows.select("o_orderkey", "o_custkey", "idx", "day_offset")


@query(
    "q_time_leak",
    f"""
    WITH i AS ({_INDEX_SQL})
    SELECT c.o_orderkey, c.o_custkey FROM i JOIN orders c ON c.o_custkey=i.o_custkey
    WHERE CAST(c.o_orderdate AS DATE) > i.idx
    """,
)
def time_leak(spark: SparkSession, folder: str) -> DataFrame:
    claims = _claims(spark, folder).select("o_orderkey", "o_custkey", "svc_date")
    index = _index(spark, folder).select("o_custkey", "idx")
    features = linking.spread_join(claims, index, ["o_custkey"], spread_by=["o_orderkey"])
    return quality.late_rows(features, "svc_date", "idx").select("o_orderkey", "o_custkey")


@query(
    "q_followup",
    """
    SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS first_dt,
      CAST(MAX(o_orderdate) AS DATE) AS last_dt,
      COUNT(DISTINCT CAST(EXTRACT(YEAR FROM o_orderdate) AS INT)) AS n_years
    FROM orders GROUP BY 1
    """,
)
def followup(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.follow_up(_claims(spark, folder), "svc_date", F.col("yr"), "o_custkey")


@query(
    "q_gap_to_next",
    """
    SELECT o_custkey, svc_date, n, CAST(DATEDIFF('day', svc_date, nxt) AS INT) AS gap_days FROM (
      SELECT *, LEAD(svc_date) OVER (PARTITION BY o_custkey ORDER BY svc_date) AS nxt FROM (
        SELECT o_custkey, CAST(o_orderdate AS DATE) AS svc_date, COUNT(*) AS n
        FROM orders GROUP BY 1,2) d) t
    """,
)
def gap_to_next(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.days_to_next(_claims(spark, folder), "svc_date", "o_custkey")


@query(
    "q_year_presence",
    """
    WITH p AS (
      SELECT DISTINCT o_custkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS year FROM orders)
    SELECT a.o_custkey, a.year, (b.year IS NOT NULL) AS next_year
    FROM p a LEFT JOIN p b ON a.o_custkey=b.o_custkey AND b.year=a.year+1
    """,
)
def year_presence(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.year_presence(_claims(spark, folder), F.col("yr"), "o_custkey")


def _wide_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Lines side by side: amt_1..amt_7 and code_1..code_7 per order, in one aggregate."""
    items = table(spark, folder, "lineitem")
    at = {i: F.col("l_linenumber") == i for i in range(1, 8)}
    return items.groupBy("l_orderkey").agg(
        *[F.max(F.when(at[i], F.col("l_extendedprice"))).alias(f"amt_{i}") for i in at],
        *[F.min(F.when(at[i], F.col("l_partkey"))).alias(f"code_{i}") for i in at],
    )


@query(
    "q_line_unpivot",
    """
    SELECT l_orderkey, l_linenumber, MAX(l_extendedprice) AS amt, MIN(l_partkey) AS code
    FROM lineitem GROUP BY 1,2
    """,
)
def line_unpivot(spark: SparkSession, folder: str) -> DataFrame:
    return lines.unpivot_lines(
        _wide_claims(spark, folder), ["l_orderkey"], {"amt": "amt", "code": "code"}, 7, "l_linenumber"
    )


@query(
    "q_code_arrays",
    "SELECT l_orderkey, COUNT(DISTINCT l_partkey) AS n_codes FROM lineitem GROUP BY 1",
)
def code_arrays(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    cells = [
        F.when(F.col("l_linenumber") == i, F.col("l_partkey")).alias(f"code_{i}")
        for i in range(1, 8)
    ]
    wide = items.select("l_orderkey", *cells)
    return utilization.distinct_code_counts(wide, ["l_orderkey"], block(wide.columns, "code"))


@query(
    "q_code_pack",
    """
    SELECT l_orderkey, string_agg(CAST(code AS VARCHAR), ',' ORDER BY l_linenumber) AS codes,
      COUNT(*) AS n_codes, COUNT(DISTINCT code) AS n_distinct FROM (
      SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS code FROM lineitem GROUP BY 1,2) t
    GROUP BY 1
    """,
)
def code_pack(spark: SparkSession, folder: str) -> DataFrame:
    wide = _wide_claims(spark, folder)
    codes = block(wide.columns, "code")
    packed = pack_codes(codes)
    return wide.select(
        "l_orderkey",
        F.array_join(packed.cast("array<string>"), ",").alias("codes"),
        F.size(packed).cast("bigint").alias("n_codes"),
        F.size(distinct_codes(codes)).cast("bigint").alias("n_distinct"),
    )


@query(
    "q_code_member",
    """
    SELECT l_orderkey FROM (
      SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS code FROM lineitem GROUP BY 1,2) t
    GROUP BY 1 HAVING COUNT(CASE WHEN code IN (1,2,3,5,8) THEN 1 END) > 0
    """,
)
def code_member(spark: SparkSession, folder: str) -> DataFrame:
    wide = _wide_claims(spark, folder)
    return wide.where(has_any_code(block(wide.columns, "code"), _CODES)).select("l_orderkey")


@query(
    "q_code_freq",
    "SELECT l_partkey, COUNT(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 20",
)
def code_freq(spark: SparkSession, folder: str) -> DataFrame:
    counts = utilization.code_counts(table(spark, folder, "lineitem"), ["l_partkey"], "l_partkey")
    return utilization.top_codes(counts, 20, "l_partkey")


@query(
    "q_code_counts",
    "SELECT l_partkey, COUNT(*) AS n FROM lineitem GROUP BY 1",
)
def code_counts(spark: SparkSession, folder: str) -> DataFrame:
    return utilization.code_counts(table(spark, folder, "lineitem"), ["l_partkey"], "l_partkey")


@query(
    "q_normalise_codes",
    """
    SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS label,
      CASE WHEN LENGTH(CAST(p_partkey AS VARCHAR)) < 5 THEN LPAD(CAST(p_partkey AS VARCHAR), 5, '0')
        ELSE CAST(p_partkey AS VARCHAR) END AS padded FROM part
    """,
)
def normalise_codes(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        "p_partkey", normalise_code(key).alias("label"), normalise_code(key, 5).alias("padded")
    )


@query(
    "q_chronic",
    """
    SELECT c_nationkey, flag, COUNT(CASE WHEN v=1 THEN 1 END) AS n_yes, COUNT(*) AS n FROM (
      SELECT c_nationkey, 'f0' AS flag, c_custkey%2 AS v FROM customer
      UNION ALL SELECT c_nationkey,'f1',c_custkey%3 FROM customer
      UNION ALL SELECT c_nationkey,'f2',c_custkey%5 FROM customer) t GROUP BY 1,2
    """,
)
def chronic(spark: SparkSession, folder: str) -> DataFrame:
    return beneficiary.condition_prevalence(
        _flagged(spark, folder), ["c_nationkey"], ["f0", "f1", "f2"], yes=1
    )


def _flagged(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").withColumns(
        {"f0": key % 2, "f1": key % 3, "f2": key % 5}
    )


@query(
    "q_condition_count",
    """
    SELECT c_custkey, CAST((c_custkey%2=1)::INT + (c_custkey%3=1)::INT + (c_custkey%5=1)::INT AS INT)
      AS n_conditions FROM customer
    """,
)
def condition_count(spark: SparkSession, folder: str) -> DataFrame:
    return _flagged(spark, folder).select(
        "c_custkey", beneficiary.condition_count(["f0", "f1", "f2"], 1).alias("n_conditions")
    )


@query(
    "q_coverage",
    """
    SELECT c_mktsegment, plan, COUNT(*) AS n, CAST(SUM(m) AS BIGINT) AS months,
      COUNT(CASE WHEN m=12 THEN 1 END) AS n_full_year FROM (
      SELECT c_mktsegment, 'part_a' AS plan, c_custkey%13 AS m FROM customer
      UNION ALL SELECT c_mktsegment, 'part_b', (c_custkey*7)%13 FROM customer) t GROUP BY 1,2
    """,
)
def coverage(spark: SparkSession, folder: str) -> DataFrame:
    return beneficiary.coverage_summary(
        _covered(spark, folder), ["c_mktsegment"], ["part_a", "part_b"]
    )


def _covered(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").withColumns(
        {"part_a": key % 13, "part_b": (key * 7) % 13}
    )


@query(
    "q_full_year_members",
    "SELECT c_custkey FROM customer WHERE c_custkey%13=12 AND c_custkey%2=0",
)
def full_year_members(spark: SparkSession, folder: str) -> DataFrame:
    both = beneficiary.full_year(["part_a", "part_b"])
    part_b = F.when(F.col("c_custkey") % 2 == 0, 12).otherwise(F.col("c_custkey") % 12)
    return _covered(spark, folder).withColumn("part_b", part_b).where(both).select("c_custkey")


def _annual(spark: SparkSession, folder: str) -> DataFrame:
    """Nine annual amounts per customer out of the balance, some of them missing."""
    balance, key = F.col("c_acctbal"), F.col("c_custkey")
    amounts = {}
    for i, name in enumerate(beneficiary.ANNUAL_AMOUNTS):
        amounts[name] = F.when((key + i) % 10 != 0, F.round(balance) * (i + 1))
    return table(spark, folder, "customer").withColumns(amounts)


_ANNUAL_SQL = "\n".join(
    f"COALESCE(CAST(SUM(CASE WHEN (c_custkey+{i})%10<>0 THEN "
    f"CAST(ROUND(ROUND(c_acctbal)*{i + 1}*100) AS BIGINT) END) AS BIGINT),0) AS {name}_cents,"
    for i, name in enumerate(beneficiary.ANNUAL_AMOUNTS)
)


@query(
    "q_reimb_rollup",
    f"SELECT {_ANNUAL_SQL} c_mktsegment FROM customer GROUP BY c_mktsegment",
)
def reimb_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return beneficiary.reimbursement_by(_annual(spark, folder), ["c_mktsegment"])


def _setting_sql(setting: int) -> str:
    return " + ".join(
        f"CASE WHEN (c_custkey+{i})%10<>0 THEN CAST(ROUND(ROUND(c_acctbal)*{i + 1}*100) AS BIGINT) ELSE 0 END"
        for i in range(3 * setting, 3 * setting + 3)
    )


@query(
    "q_reimb_person",
    f"""
    SELECT *, cents_ip + cents_op + cents_car AS cents_total FROM (
      SELECT c_custkey, {_setting_sql(0)} AS cents_ip, {_setting_sql(1)} AS cents_op,
        {_setting_sql(2)} AS cents_car FROM customer) t
    """,
)
def reimb_person(spark: SparkSession, folder: str) -> DataFrame:
    totals = beneficiary.annual_totals(_annual(spark, folder))
    return totals.select("c_custkey", "cents_ip", "cents_op", "cents_car", "cents_total")


@query(
    "q_amount_sign",
    """
    SELECT c_mktsegment, 'c_acctbal' AS amount, COUNT(CASE WHEN c_acctbal<0 THEN 1 END) AS neg,
      COUNT(CASE WHEN c_acctbal=0 THEN 1 END) AS zero,
      COUNT(CASE WHEN c_acctbal>0 THEN 1 END) AS pos,
      COUNT(CASE WHEN c_acctbal IS NULL THEN 1 END) AS nul FROM customer GROUP BY 1
    """,
)
def amount_sign(spark: SparkSession, folder: str) -> DataFrame:
    return beneficiary.sign_profile(
        table(spark, folder, "customer"), ["c_mktsegment"], ["c_acctbal"]
    )


@query(
    "q_negative_policy",
    """
    SELECT c_mktsegment, CAST(SUM(CAST(ROUND(c_acctbal*100) AS BIGINT)) AS BIGINT) AS cents_all,
      CAST(SUM(CASE WHEN c_acctbal>=0 THEN CAST(ROUND(c_acctbal*100) AS BIGINT) END) AS BIGINT)
        AS cents_kept FROM customer GROUP BY 1
    """,
)
def negative_policy(spark: SparkSession, folder: str) -> DataFrame:
    balance = F.col("c_acctbal")
    kept = F.when(keep_amount(balance, drop_negative=True), balance)
    return utilization.spend(
        table(spark, folder, "customer"),
        ["c_mktsegment"],
        {"cents_all": F.when(keep_amount(balance), balance), "cents_kept": kept},
    )


@query(
    "q_reconcile",
    """
    WITH e AS (SELECT 1995 AS yr, 2000 AS expected UNION ALL SELECT 1996,2300 UNION ALL SELECT 2002,5),
    a AS (SELECT CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS yr, COUNT(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(e.yr AS INT) AS yr, CAST(COALESCE(n,0)-expected AS BIGINT) AS diff
    FROM e LEFT JOIN a ON a.yr=e.yr
    """,
)
def reconcile(spark: SparkSession, folder: str) -> DataFrame:
    expected = quality.expected_counts(spark, {1995: 2000, 1996: 2300, 2002: 5})
    found = quality.count_difference(_claims(spark, folder), expected, "yr")
    return found.select(F.col("year").alias("yr"), "diff")


@query(
    "q_yyyymmdd",
    """
    SELECT o_orderkey, d AS raw, CAST(try_strptime(CAST(d AS VARCHAR), '%Y%m%d') AS DATE) AS parsed,
      CAST(d // 10000 AS INT) AS yr FROM (
      SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT)
        + CASE WHEN o_orderkey % 11 = 0 THEN 1300 ELSE 0 END AS d FROM orders) t
    """,
)
def yyyymmdd(spark: SparkSession, folder: str) -> DataFrame:
    # Every eleventh date gets a month past December.
    shift = F.when(F.col("o_orderkey") % 11 == 0, 1300).otherwise(0)
    raw = _claims(spark, folder).select(
        "o_orderkey", (dates.to_yyyymmdd(F.col("svc_date")) + shift).alias("raw")
    )
    return raw.withColumns(
        {"parsed": dates.parse_yyyymmdd(F.col("raw")), "yr": dates.year_of(F.col("raw"))}
    )


@query(
    "q_los",
    """
    SELECT o_orderkey,
      CAST(MAX(DATEDIFF('day',CAST(o_orderdate AS DATE),CAST(l_shipdate AS DATE))) AS INT) AS days
    FROM orders JOIN lineitem ON o_orderkey=l_orderkey GROUP BY 1
    """,
)
def los(spark: SparkSession, folder: str) -> DataFrame:
    # The longest stay of a claim ends with its last date, so lines shrink to one first.
    last = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(dates.to_yyyymmdd(F.max("l_shipdate")).alias("discharged"))
    )
    claims = _claims(spark, folder).select(
        "o_orderkey", dates.to_yyyymmdd(F.col("svc_date")).alias("admitted")
    )
    stays = claims.join(last, "o_orderkey")
    return stays.select("o_orderkey", dates.length_of_stay("admitted", "discharged").alias("days"))


@query(
    "q_age_censoring",
    """
    SELECT c_custkey, CAST(2010 - (1920 + c_custkey % 60) AS INT) AS age,
      CAST(DATEDIFF('day', DATE '2008-01-01', CASE WHEN c_custkey % 4 = 0
        THEN MAKE_DATE(2008 + (c_custkey % 3)::INT, 6, 30) ELSE DATE '2010-12-31' END) AS INT) AS days
    FROM customer
    """,
)
def age_censoring(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    born = (F.lit(1920) + key % 60) * 10000 + 315
    died = F.when(key % 4 == 0, (F.lit(2008) + key % 3) * 10000 + 630)
    index = F.lit(20080101).cast("bigint")
    return table(spark, folder, "customer").select(
        "c_custkey",
        dates.age_at_year_end(born, 2010).alias("age"),
        dates.days_to_death_or_end(index, died, 20101231).alias("days"),
    )


_BUCKET_SQL = "('0x'||substr(md5(CAST({0} AS VARCHAR)),1,8))::BIGINT % 100"


def _split_sql(key: str) -> str:
    bucket = _BUCKET_SQL.format(key)
    return f"CASE WHEN {bucket} < 70 THEN 'train' WHEN {bucket} < 85 THEN 'validation' ELSE 'test' END"


@query(
    "q_split",
    f"SELECT {_split_sql('c_custkey')} AS split, COUNT(*) AS n FROM customer GROUP BY 1",
)
def split(spark: SparkSession, folder: str) -> DataFrame:
    people = cohort.with_split(table(spark, folder, "customer"), "c_custkey")
    return people.groupBy("split").agg(F.count("*").alias("n"))


@query(
    "q_split_rows",
    f"SELECT o_orderkey, o_custkey, {_split_sql('o_custkey')} AS split FROM orders",
)
def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return cohort.with_split(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_custkey"
    )


@query(
    "q_split_leak",
    f"""
    SELECT COUNT(*) AS n FROM (
      SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(DISTINCT {_split_sql('o_custkey')}) > 1) t
    """,
)
def split_leak(spark: SparkSession, folder: str) -> DataFrame:
    rows = cohort.with_split(table(spark, folder, "orders"), "o_custkey")
    return quality.split_leaks(rows, "o_custkey").agg(F.count("*").alias("n"))


@query(
    "q_split_leak_rows",
    f"""
    SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(DISTINCT {_split_sql('o_orderkey')}) > 1
    """,
)
def split_leak_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A split by claim row, the mistake the check is there to find."""
    rows = table(spark, folder, "orders").select(
        "o_custkey", split_of(F.col("o_orderkey")).alias("split")
    )
    return quality.split_leaks(rows, "o_custkey")


@query(
    "q_key_unique",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1,2 HAVING COUNT(*)>1",
)
def key_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.repeated_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "q_pde_spend",
    """
    SELECT c_custkey, COUNT(*) AS n, COUNT(DISTINCT CAST(ts AS DATE)) AS n_days,
      CAST(SUM(CAST(ROUND(value*100) AS BIGINT)) AS BIGINT) AS cents
    FROM events JOIN customer ON user_id=c_custkey GROUP BY 1
    """,
)
def pde_spend(spark: SparkSession, folder: str) -> DataFrame:
    # Daily sums first: the days of a person then count themselves.
    daily = (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("c_custkey"), F.to_date("ts").alias("day"))
        .agg(F.count("*").alias("n"), F.sum(cents(F.col("value"))).alias("cents"))
    )
    per_person = daily.groupBy("c_custkey").agg(
        F.sum("n").alias("n"), F.count("day").alias("n_days"), F.sum("cents").alias("cents")
    )
    people = table(spark, folder, "customer").select("c_custkey")
    return per_person.join(people, "c_custkey", "left_semi")


@query(
    "q_missing",
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey=o_orderkey)",
)
def missing(spark: SparkSession, folder: str) -> DataFrame:
    expected = table(spark, folder, "orders").select("o_orderkey")
    there = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return expected.join(there.distinct(), "o_orderkey", "left_anti")


@query(
    "q_beneficiary_table",
    f"""
    WITH i AS ({_INDEX_SQL}),
    w AS (
      SELECT i.o_custkey, COUNT(*) AS n_claims, COUNT(DISTINCT CAST(c.o_orderdate AS DATE)) AS n_days,
        CAST(SUM(CAST(ROUND(c.o_totalprice*100) AS BIGINT)) AS BIGINT) AS cents
      FROM i JOIN orders c ON c.o_custkey=i.o_custkey AND CAST(c.o_orderdate AS DATE)
        BETWEEN i.idx - INTERVAL '365' DAY AND i.idx GROUP BY 1)
    SELECT c_custkey, c_mktsegment, c_nationkey, i.idx, COALESCE(n_claims,0) AS n_claims,
      COALESCE(n_days,0) AS n_days, COALESCE(cents,0) AS cents, {_split_sql('c_custkey')} AS split
    FROM customer JOIN i ON i.o_custkey=c_custkey LEFT JOIN w ON w.o_custkey=c_custkey
    """,
)
def beneficiary_table(spark: SparkSession, folder: str) -> DataFrame:
    """The documented sequence in one: index date, members, windowed features, split."""
    index = _index(spark, folder).select(F.col("o_custkey").alias("c_custkey"), "idx")
    daily = (
        _claims(spark, folder)
        .groupBy(F.col("o_custkey").alias("c_custkey"), "svc_date")
        .agg(F.count("*").alias("n"), F.sum(cents(F.col("o_totalprice"))).alias("cents"))
    )
    pairs = daily.join(index, "c_custkey")
    inside = pairs.where(F.datediff("svc_date", "idx").between(-365, 0))
    features = inside.groupBy("c_custkey").agg(
        F.sum("n").alias("n_claims"), F.count("*").alias("n_days"), F.sum("cents").alias("cents")
    )
    members = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    base = members.join(index, "c_custkey")
    joined = linking.attach_features(
        base, features, "c_custkey", zero=["n_claims", "n_days", "cents"]
    )
    return cohort.with_split(joined, "c_custkey")
