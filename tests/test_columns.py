import math

import pytest
from pyspark.sql import functions as F

from varstrata.functions.columns import (
    lenient_double,
    quota,
    resolve_roles,
    split_quoted,
    stratum_label,
    variation,
)

COLUMNS = ["Year", "District.Code", "District.Name", "Gender", "Number"]


def values(df):
    return [row[0] for row in df.collect()]


def test_roles_ignore_case_and_keep_the_callers_order():
    roles = resolve_roles(COLUMNS, "district.name, DISTRICT.CODE", "number")
    assert roles.keys == ("District.Name", "District.Code")
    assert roles.measure == "Number"
    assert roles.payload == ("Year", "Gender", "Number")


def test_payload_per_key_repeats_columns_and_holds_other_keys():
    roles = resolve_roles(["a", "b", "x"], ["a", "b"], "x", payload="per_key")
    assert roles.payload == ("b", "x", "a", "x")


@pytest.mark.parametrize(
    ("keys", "measure"), [("nope", "Number"), ("Year", "nope"), ("Year", "Year"), ([], "Number")]
)
def test_bad_roles_raise(keys, measure):
    with pytest.raises(ValueError):
        resolve_roles(COLUMNS, keys, measure)


def test_ambiguous_name_raises_but_exact_match_wins():
    assert resolve_roles(["a", "A", "x"], "A", "x").keys == ("A",)
    with pytest.raises(ValueError):
        resolve_roles(["ab", "AB", "x"], "Ab", "x")


def test_lenient_double(spark):
    texts = ["abc", "", " 7 ", "1.5d", "\t3\t", "1e2", "-4", "0x1p3", "1,5", None, "nan", "inf", "--1"]
    df = spark.createDataFrame([(t,) for t in texts], "x string").coalesce(1)
    assert values(df.select(lenient_double(F.col("x")))) == [
        0.0, 0.0, 7.0, 1.5, 3.0, 100.0, -4.0, 8.0, 0.0, 0.0, 0.0, 0.0, 0.0,
    ]
    special = spark.createDataFrame([("NaN",), ("Infinity",), ("-Infinity",)], "x string").coalesce(1)
    nan, plus, minus = values(special.select(lenient_double(F.col("x"))))
    assert math.isnan(nan) and plus == math.inf and minus == -math.inf


@pytest.mark.parametrize(
    ("line", "fields"),
    [
        ('a,"x, y",3,n', ["a", "x, y", "3", "n"]),
        ("a,b,3,", ["a", "b", "3", ""]),
        ('"say ""hi""",b', ["say hi", "b"]),
        ("\ta,b\t", ["a", "b"]),
        ("\x00 a , b \x1f", ["a ", " b"]),
        # with an odd number of quotes, a comma is outside if an even number follows it
        ('a,"b,c', ["a,b", "c"]),
        ("", [""]),
        (",,", ["", "", ""]),
    ],
)
def test_split_quoted(spark, line, fields):
    df = spark.createDataFrame([(line,)], "line string")
    assert values(df.select(split_quoted(F.col("line")))) == [fields]


def test_quota_rounds_half_up(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.49,), (float("nan"),)], "g double").coalesce(1)
    assert values(df.select(quota(F.col("g"), F.lit(10.0), 10))) == [3, -2, 0, 0]


def test_quota_of_a_zero_total_is_zero(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "g double")
    assert values(df.select(quota(F.col("g"), F.lit(0.0), 10))) == [0, 0]


def test_variation_guards_and_options(spark):
    rows = [(2.0, 1.0), (0.0, 1.0), (0.0, 0.0), (-2.0, 1.0), (float("nan"), float("nan"))]
    df = spark.createDataFrame(rows, "mean double, sd double").coalesce(1)
    mean, sd = F.col("mean"), F.col("sd")
    assert values(df.select(variation(mean, sd))) == [0.5, 0.0, 0.0, -0.5, 0.0]
    assert values(df.select(variation(mean, sd, abs_mean=True)))[3] == 0.5
    assert values(df.select(variation(mean, sd, weight=4.0)))[0] == 1.0
    raw = values(df.select(variation(mean, sd, degenerate="propagate")))
    assert raw[1] == math.inf and math.isnan(raw[2]) and math.isnan(raw[4])


def test_label_keeps_empty_places_for_nulls(spark):
    df = spark.createDataFrame([(None, "b"), ("a", None)], "k1 string, k2 string").coalesce(1)
    assert values(df.select(stratum_label(["k1", "k2"]))) == [",b", "a,"]
