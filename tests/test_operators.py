"""Operators against plain Python on small rows, heavy keys included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimbrook.functions import dates
from claimbrook.functions.codes import block, has_any_code, normalise_code
from claimbrook.functions.splits import split_of
from claimbrook.operators import beneficiary, cohort, lines, linking, quality, utilization
from claimbrook.sources.kinds import family_schema


@pytest.fixture(scope="module")
def claims(spark):
    """Half of the claims belong to one beneficiary, and some to none."""
    rng = random.Random(7)
    rows = []
    for i in range(2000):
        who = "hot" if rng.random() < 0.5 else f"b{rng.randrange(60)}"
        who = None if rng.random() < 0.05 else who
        day = None if rng.random() < 0.02 else dt.date(2008, 1, 1) + dt.timedelta(rng.randrange(900))
        rows.append((i, who, day, round(rng.uniform(-50, 500), 2)))
    df = spark.createDataFrame(rows, "CLM_ID int, DESYNPUF_ID string, svc date, amt double")
    return df, rows


@pytest.fixture(scope="module")
def people(spark):
    rows = [("hot", "M")] + [(f"b{i}", "F") for i in range(0, 60, 2)]
    return spark.createDataFrame(rows, "DESYNPUF_ID string, sex string"), dict(rows)


def test_heavy_keys_are_counted(spark, claims):
    df, rows = claims
    hot = sum(r[1] == "hot" for r in rows)
    found = linking.heavy_table(df, "DESYNPUF_ID", 100).collect()
    assert [(r["_heavy"], r["_fan"]) for r in found] == [("hot", -(-hot // 100))]
    assert linking.heavy_table(df, "DESYNPUF_ID", hot).count() == 0
    assert linking.heavy_table(spark.range(0), "id", 1).count() == 0
    with pytest.raises(ValueError):
        linking.heavy_table(df, "DESYNPUF_ID", 0)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("heavy", [["hot"], [], None])
def test_spread_join_equals_join(claims, people, how, heavy):
    df, rows = claims
    lookup, sexes = people
    got = linking.spread_join(df, lookup, ["DESYNPUF_ID"], how, heavy=heavy, target=50).collect()
    ids = sorted(r["CLM_ID"] for r in got)
    inside = [r[0] for r in rows if r[1] in sexes]
    outside = [r[0] for r in rows if r[1] not in sexes]
    wanted = {"inner": inside, "left_semi": inside, "left_anti": outside, "left": inside + outside}
    assert ids == sorted(wanted[how])
    if how == "left":
        assert all(r["sex"] == sexes.get(r["DESYNPUF_ID"]) for r in got)


@pytest.mark.parametrize("named", [{"heavy": ["hot"]}, {"target": 100}])
def test_spread_join_spreads(spark, claims, people, named):
    joined = linking.spread_join(claims[0], people[0], ["DESYNPUF_ID"], spread_by=["CLM_ID"], **named)
    dealt = claims[0].where("DESYNPUF_ID = 'hot'").count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = joined.where("DESYNPUF_ID = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) > 3 and max(r["count"] for r in sizes) < dealt / 2


def test_spread_join_refuses_other_joins(claims, people):
    with pytest.raises(ValueError):
        linking.spread_join(claims[0], people[0], ["DESYNPUF_ID"], "full")


def test_claims_with_beneficiary_keeps_claim_sample(spark):
    claims = spark.createDataFrame([("a", 1, 3), ("a", 2, 4)], "DESYNPUF_ID string, c int, sample int")
    people = spark.createDataFrame([("a", "M", 3)], "DESYNPUF_ID string, sex string, sample int")
    loose = linking.claims_with_beneficiary(claims, people)
    assert sorted((r["c"], r["sample"]) for r in loose.collect()) == [(1, 3), (2, 4)]
    assert [r["c"] for r in linking.claims_with_beneficiary(claims, people, same_sample=True).collect()] == [1]


def test_index_and_washout(claims):
    df, rows = claims
    by_id = {}
    for claim, who, day, _ in rows:
        if day is not None:
            by_id.setdefault(who, []).append((day, claim))
    first = {w: min(v) for w, v in by_id.items()}
    got = cohort.index_claims(df, "svc").collect()
    assert {r["DESYNPUF_ID"]: (r["index_date"], r["CLM_ID"]) for r in got} == first
    wanted = set()
    for who, v in by_id.items():
        v.sort()
        for i, (day, claim) in enumerate(v):
            if i == 0 or (day - v[i - 1][0]).days > 30:
                wanted.add(claim)
    assert {r["CLM_ID"] for r in cohort.washed_out_claims(df, "svc", 30).collect()} == wanted


def test_windows(claims):
    df, rows = claims
    index = cohort.index_claims(df.where("DESYNPUF_ID is not null"), "svc", qualifies=F.col("amt") > 200)
    start = {r["DESYNPUF_ID"]: r["index_date"] for r in index.collect()}
    offsets = [
        (c, (day - start[w]).days) for c, w, day, _ in rows if w in start and day is not None
    ]
    inside = sorted((c, o) for c, o in offsets if -60 <= o <= 90)
    got = linking.claims_in_window(df, index, "svc", 60, 90, heavy=["hot"]).collect()
    assert sorted((r["CLM_ID"], r["day_offset"]) for r in got) == inside
    counted = linking.window_counts(df, index, "svc", 60, 90).collect()
    assert sum(r["n_pre"] for r in counted) == sum(o < 0 for _, o in inside)
    assert sum(r["n_post"] for r in counted) == sum(o >= 0 for _, o in inside)
    before = linking.claims_in_window(df, index, "svc", 60, 0, heavy=[])
    assert quality.late_rows(before, "svc").count() == 0


def test_attrition_and_presence(spark):
    rows = [("a", 2008), ("a", 2008), ("a", 2009), ("b", 2008), ("b", 2010), ("c", 2010)]
    df = spark.createDataFrame(rows, "DESYNPUF_ID string, year int")
    gone = linking.attrition(df, 2010)
    assert sorted(map(tuple, gone.collect())) == [("a", 2009), ("b", 2008)]
    deaths = spark.createDataFrame([("a", 20100301), ("b", None)], "DESYNPUF_ID string, BENE_DEATH_DT long")
    reasons = {r["DESYNPUF_ID"]: r["reason"] for r in linking.attrition_reason(gone, deaths).collect()}
    assert reasons == {"a": "death", "b": "dropout"}
    present = cohort.year_presence(df, F.col("year")).collect()
    assert sorted(map(tuple, present)) == [
        ("a", 2008, True), ("a", 2009, False), ("b", 2008, False), ("b", 2010, False), ("c", 2010, False),
    ]


def test_calendars_beside_sets(spark):
    """Years across a multiple of 64, years missing, a group without any, and one that spans too many."""
    rng = random.Random(3)
    rows = [(f"b{i % 40}", rng.choice([None, *range(1960 + i % 40, 2010 + i % 40, 3)])) for i in range(900)]
    df = spark.createDataFrame(rows + [("none", None)], "DESYNPUF_ID string, year int")
    want = {}
    for who, year in rows:
        if year is not None:
            want.setdefault(who, set()).add(year)
    got = cohort.year_presence(df, F.col("year")).collect()
    assert sorted(map(tuple, got)) == sorted((w, y, y + 1 in ys) for w, ys in want.items() for y in ys)
    gone = linking.attrition(df, 2008).collect()
    assert sorted(map(tuple, gone)) == sorted((w, y) for w, ys in want.items() for y in ys if y < 2008 and y + 1 not in ys)
    counted = {r["DESYNPUF_ID"]: r["n_years"] for r in cohort.follow_up(df, "year", F.col("year")).collect()}
    assert counted == {w: len(ys) for w, ys in want.items()} | {"none": 0}
    for out in (cohort.year_presence(df, F.col("year")), linking.attrition(df, 2008)):
        text = out._jdf.queryExecution().executedPlan().toString()
        assert "collect_set" not in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text
    wide = spark.createDataFrame([("a", 1900), ("a", 1964)], "DESYNPUF_ID string, year int")
    with pytest.raises(Exception, match="span more than 64"):
        cohort.year_presence(wide, F.col("year")).collect()


def test_carrier_lines(spark):
    schema = family_schema("carrier")
    row = {f.name: None for f in schema}
    row |= {"DESYNPUF_ID": "x", "CLM_ID": "1", "CLM_FROM_DT": 20080101, "CLM_THRU_DT": 20080102}
    row |= {"HCPCS_CD_1": "A", "LINE_NCH_PMT_AMT_1": 5.0, "TAX_NUM_13": 9, "LINE_NCH_PMT_AMT_13": -1.0}
    empty = {f.name: None for f in schema} | {"CLM_ID": "2"}
    df = spark.createDataFrame([tuple(r[f.name] for f in schema) for r in (row, empty)], schema)
    got = lines.carrier_lines(df)
    assert got.columns == [
        "DESYNPUF_ID", "CLM_ID", "CLM_FROM_DT", "CLM_THRU_DT", "line_num", "prf_physn_npi", "tax_num",
        "hcpcs_cd", "nch_pmt_amt", "bene_ptb_ddctbl_amt", "bene_prmry_pyr_pd_amt", "coinsrnc_amt",
        "alowd_chrg_amt", "prcsg_ind_cd", "icd9_dgns_cd",
    ]
    assert sorted((r["line_num"], r["hcpcs_cd"], r["tax_num"], r["nch_pmt_amt"]) for r in got.collect()) == [
        (1, "A", None, 5.0), (13, None, 9, -1.0),
    ]
    assert lines.carrier_lines(df, ["HCPCS_CD"]).count() == 1
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_codes(spark):
    df = spark.createDataFrame([("1", None, "7"), (None, None, None)], "c_2 string, c_10 string, c_1 string")
    assert block(df.columns, "c") == ["c_1", "c_2", "c_10"]
    hits = df.select(has_any_code(["c_1", "c_2", "c_10"], ["7", "9"]).alias("h")).collect()
    assert [r["h"] for r in hits] == [True, False]
    codes = spark.createDataFrame([("7",), ("123456",)], "c string")
    assert [r[0] for r in codes.select(normalise_code(F.col("c"), 3)).collect()] == ["007", "123456"]


def test_distinct_and_spend(claims):
    df, rows = claims
    dated = [r for r in rows if r[1] == "hot"]
    n = utilization.distinct_counts(df, ["DESYNPUF_ID"], {"days": F.col("svc")}).where("DESYNPUF_ID='hot'")
    assert n.first()["days"] == len({r[2] for r in dated if r[2] is not None})
    cents = utilization.spend(df, ["DESYNPUF_ID"], {"cents": F.col("amt")}).where("DESYNPUF_ID='hot'")
    assert cents.first()["cents"] == sum(round(r[3] * 100) for r in dated)
    rough = utilization.distinct_counts(df, ["DESYNPUF_ID"], {"days": F.col("svc")}, approximate=True)
    assert rough.where("DESYNPUF_ID='hot'").first()["days"] > 0


def test_dates(spark):
    df = spark.createDataFrame([(20080229, 20080301), (20081301, None), (2008, 20080101)], "a long, b long")
    got = df.select(
        dates.parse_yyyymmdd(F.col("a")).alias("d"),
        dates.year_of(F.col("a")).alias("y"),
        dates.days_between(F.col("a"), F.col("b")).alias("n"),
        dates.age_at_year_end(F.lit(19400704), 2008).alias("age"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (dt.date(2008, 2, 29), 2008, 1, 68), (None, 2008, None, 68), (None, 0, None, 68),
    ]


def test_splits(spark):
    ids = spark.range(2000).select(F.col("id").cast("string").alias("DESYNPUF_ID"))
    shares = cohort.with_split(ids.union(ids)).groupBy("split").count().collect()
    assert {r["split"] for r in shares} == {"train", "validation", "test"}
    assert quality.split_leaks(cohort.with_split(ids.union(ids)), "DESYNPUF_ID").count() == 0
    with pytest.raises(ValueError):
        split_of(F.col("x"), {"train": 50, "test": 40})


def test_profiles(spark):
    df = spark.createDataFrame([(1, 12, -1.0), (2, 6, 0.0), (1, 12, None)], "SP_CHF int, m int, amt double")
    got = beneficiary.condition_prevalence(df, [], ["SP_CHF"], yes=1).first()
    assert tuple(got) == ("SP_CHF", 2, 3)
    assert tuple(beneficiary.sign_profile(df, [], ["amt"]).first()) == ("amt", 1, 1, 0, 1)
    assert df.where(beneficiary.full_year(["m"])).count() == 2
    assert "BENE_DEATH_DT" not in quality.drop_hindsight(
        spark.createDataFrame([(1, 2.0, 3)], "BENE_DEATH_DT int, MEDREIMB_IP double, x int")
    ).columns


def test_counts_against_published(spark):
    actual = spark.range(10).select(F.lit(2008).alias("year"))
    published = quality.PUBLISHED_COUNTS["inpatient"]
    diff = quality.count_difference(actual, quality.expected_counts(spark, published)).collect()
    assert {r["year"]: r["diff"] for r in diff} == {2008: 10 - 547800, 2009: -504941, 2010: -280081}
    assert sum(sum(v.values()) for v in quality.PUBLISHED_COUNTS.values()) == 229_982_504


def test_episodes_beside_plain_loops(claims):
    """Several index dates per beneficiary, windows that overlap, dates that are missing or repeated."""
    df, rows = claims
    spark = df.sparkSession
    starts = [(w, d) for _, w, d, _ in rows[::9] if w is not None] + [("nobody", dt.date(2009, 1, 1)), ("hot", None)]
    episodes = spark.createDataFrame(starts + starts[:3], "DESYNPUF_ID string, index_date date")
    want = sorted(
        (c, d, (day - d).days)
        for w, d in set(starts) if d is not None
        for c, who, day, _ in rows if who == w and day is not None and -20 <= (day - d).days <= 45
    )
    for heavy in (None, [], ["hot"]):
        got = linking.claims_in_episodes(df, episodes, "svc", 20, 45, heavy=heavy).collect()
        assert sorted((r["CLM_ID"], r["index_date"], r["day_offset"]) for r in got) == want
    text = linking.claims_in_episodes(df, episodes, "svc", 20, 45)._jdf.queryExecution().optimizedPlan().toString()
    assert "_bin" in text.split("Join Inner")[1].split("\n")[0]
    late = linking.claims_in_episodes(df, episodes, "svc", -1, 3).collect()
    assert {r["day_offset"] for r in late} <= {1, 2, 3}
    with pytest.raises(ValueError):
        linking.claims_in_episodes(df, episodes, "svc", -5, 3)


def test_nan_amounts_count_as_missing(spark):
    rows = spark.createDataFrame([("a", float("nan")), ("a", 1.25), ("b", None)], "id string, paid double")
    out = utilization.spend(rows, ["id"], {"cents": F.col("paid")}).collect()
    assert {r.id: r.cents for r in out} == {"a": 125, "b": None}


def test_follow_up_ends_before_index(spark):
    days = dates.days_to_death_or_end(F.col("i"), F.col("d"), 20101231).alias("n")
    rows = spark.createDataFrame([(20090101, 20080630), (20090101, 20090102), (20090101, None)], "i long, d long")
    assert [r.n for r in rows.select(days).collect()] == [None, 1, 729]
