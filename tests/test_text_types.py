import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from claimbrook.functions import text_types as tt
from claimbrook.functions.naming import CodePolicy, rule_for, schema_for, semantic_of


def cells(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")


@pytest.mark.parametrize(
    "kind, given, wanted",
    [
        ("bigint", ["5", " 5 ", "-7", "007", "\t3"], [5, 5, -7, 7, 3]),
        ("bigint", ["+5", "1.0", "1.5", "0x1F", "", "5-", "99999999999999999999"], [None] * 7),
        ("double", ["1", "2.5", ".5", "5.", "1e3", "-1E-2", " 2 "], [1, 2.5, 0.5, 5, 1000, -0.01, 2]),
        ("double", ["1d", "1F", "+5", "0x1p3", "abc", "1e", "--1", "2D"], [None] * 8),
        ("double", ["inf", "-Infinity", "1e+3"], [math.inf, -math.inf, 1000]),
        ("boolean", tt.TRUE_TOKENS, [True] * 7),
        ("boolean", tt.FALSE_TOKENS, [False] * 7),
        ("boolean", ["y", "t", "tRUE", "2", " true"], [None] * 5),
        ("date", ["2008-01-31", "2008-02-30", "20080131", "2008-1-1"], [dt.date(2008, 1, 31), None, None, None]),
        ("timestamp_ntz", ["2008-01-01 10:00:00", "2008-01-01T10:30", "2008-01-01 10", "2008-01-01", "2008-01-01 25:00:00"],
         [dt.datetime(2008, 1, 1, 10), dt.datetime(2008, 1, 1, 10, 30), dt.datetime(2008, 1, 1, 10), dt.datetime(2008, 1, 1), None]),
        ("string", [" a ", "Na", "n/a", "NaN"], [" a ", "Na", "n/a", "NaN"]),
    ],
)
def test_convert(spark, kind, given, wanted):
    rows = cells(spark, given).select("i", tt.convert(F.col("c"), kind).alias("v"))
    assert [r["v"] for r in rows.orderBy("i").collect()] == wanted


def test_nan_is_a_double(spark):
    row = cells(spark, ["NaN"]).select(tt.convert(F.col("c"), "double").alias("v")).first()
    assert math.isnan(row["v"])


def test_null_tokens_are_exact(spark):
    given = [*tt.NULL_TOKENS, "Na", "n/a", " NA", "None", "x"]
    rows = cells(spark, given).select("i", tt.NullTokens().apply(F.col("c")).alias("v"))
    assert [r["v"] for r in rows.orderBy("i").collect()] == [None] * 6 + given[6:]


def test_invalid_marks_filled_cells_only(spark):
    rows = cells(spark, ["5", "x", None]).select("i", tt.invalid(F.col("c"), "bigint").alias("v"))
    assert [r["v"] for r in rows.orderBy("i").collect()] == [False, True, False]


@pytest.mark.parametrize(
    "column, wanted",
    [
        (["1", "2", None], "bigint"),
        (["0", "1"], "bigint"),
        (["true", "False"], "boolean"),
        (["true", "1"], "boolean"),
        (["yes", "no"], "string"),
        (["2008-01-01"], "date"),
        (["2008-01-01 10:00:00"], "timestamp_ntz"),
        (["2008-01-01 10:00:00", "2008-01-01"], "timestamp_ntz"),
        (["12:30:00", "23:59"], "time"),
        (["20080101"], "bigint"),
        (["12345678901234567890"], "double"),
        (["1", "NaN"], "double"),
        (["1", "1.5"], "double"),
        (["1", "+5"], "string"),
        (["1", "x"], "string"),
        (["2008-01-01", "7"], "string"),
        ([None, None], "null"),
    ],
)
def test_first_type(spark, column, wanted):
    bits = cells(spark, column).agg(F.bit_and(tt.fitting_types(F.col("c"))).alias("b")).first()["b"]
    assert tt.first_type(bits) == wanted


def test_names_decide_codes():
    schema = schema_for(
        ["BENE_ID", "CLAIM_COUNT", "TOTAL_PMT", "carr_num", "ICD9_DGNS_CD_1", "note", "t", "TAX_NUM_1"],
        {"BENE_ID": "bigint", "CLAIM_COUNT": "bigint", "TOTAL_PMT": "double", "carr_num": "bigint",
         "ICD9_DGNS_CD_1": "bigint", "note": "null", "t": "time", "TAX_NUM_1": "bigint"},
    )
    assert [f.dataType.simpleString() for f in schema] == [
        "string", "bigint", "double", "string", "string", "string", "string", "bigint",
    ]
    assert [semantic_of(f) for f in schema] == [
        "string_code", "integer", "float", "string_code", "string_code", "text", "text", "integer",
    ]
    assert all(f.nullable for f in schema)


def test_policy_can_be_extended():
    policy = CodePolicy().with_names("TAX_NUM_1")
    assert semantic_of(rule_for("TAX_NUM_1", "bigint", policy)) == "string_code"
    assert semantic_of(rule_for("OTHER", "bigint", policy)) == "integer"


def test_tokens_that_could_be_values():
    assert tt.NullTokens().never_values()
    for token in ("-999", "nan", "No", "9999-12-31"):
        assert not tt.NullTokens(("", token)).never_values()
