"""Edge rows for the scalar functions and filters."""

from pyspark.sql import functions as F

from lendlens.functions import exprs as X
from lendlens.operators import filters as FL
from lendlens.sources.tables import normalize_na


def col_values(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_exclude_keeps_null(spark):
    df = spark.createDataFrame([(1,), (None,), (1111,), (2,)], "b int")
    out = sorted(col_values(FL.exclude(df, "b", [1, 1111]), "b"), key=lambda v: (v is None, v))
    assert out == [2, None]


def test_ne_keeps_null_after_na_normalisation(spark):
    df = normalize_na(spark.createDataFrame([("NA",), ("C",), (None,)], "c string"))
    out = col_values(FL.exclude_ne(df, "c", "NA"), "c")
    assert sorted(out, key=lambda v: (v is None, v)) == ["C", None, None]


def test_bin_dti(spark):
    cases = {"<20%": "<20%", "20%-<30%": "20%-<30%", "30%-<36%": None, "36": "30%-<40%",
             "49": "40%-<50%", "60": "50%-60%", "61": ">60%", "Exempt": None, None: None,
             "12": "<20%", "50%-60%": "50%-60%", ">60%": ">60%"}
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    got = {r[0]: r[1] for r in df.select("d", X.bin_dti("d")).collect()}
    assert got == cases


def test_bin_dti_keep_30_36(spark):
    df = spark.createDataFrame([("30%-<36%",)], "d string")
    assert df.select(X.bin_dti("d", keep_30_36=True)).first()[0] == "30%-<40%"


def test_ordinal_dti(spark):
    from lendlens.ml.features import dti_ordinal
    cases = {"<20%": 0, "30%-<36%": 2, "Exempt": 8, "36": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    assert {r[0]: r[1] for r in df.select("d", dti_ordinal("d")).collect()} == cases


def test_first_number(spark):
    cases = {"<20%": 20.0, ">60%": 60.0, "50%-60%": 50.0, "abc": None}
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    assert {r[0]: r[1] for r in df.select("d", X.first_number("d")).collect()} == cases


def test_cut_half_open(spark):
    edges, labels = [0, 20, 30, 40, 50, 65], ["<20%", "20-30%", "30-40%", "40-50%", "50-65%"]
    cases = {0.0: "<20%", 20.0: "20-30%", 64.9: "50-65%", 65.0: None, -1.0: None}
    df = spark.createDataFrame([(k,) for k in cases], "x double")
    assert {r[0]: r[1] for r in df.select("x", X.cut("x", edges, labels)).collect()} == cases


def test_to_number(spark):
    cases = {"1e3": 1000.0, " 7 ": 7.0, "1,234": None, "12d": None, "NA": None, "": None,
             "-3.5": -3.5, ".5": 0.5, "0x1A": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert {r[0]: r[1] for r in df.select("s", X.to_number("s")).collect()} == cases
    df2 = spark.createDataFrame([("1,234",)], "s string")
    assert df2.select(X.to_number_commas("s")).first()[0] == 1234.0


def test_zfill_never_truncates(spark):
    cases = {"7": "00007", "123456": "123456", "-7": "-0007", "37001": "37001"}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert {r[0]: r[1] for r in df.select("s", X.zfill("s", 5)).collect()} == cases


def test_round_half_even_like_numpy(spark):
    import numpy as np
    vals = [0.125, 2.5, 2.675, 0.0125, 1.005, -0.125, 3.14159]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(X.round_half_even("x", 2)).collect()]
    assert got == [float(np.round(v, 2)) for v in vals]
    assert df.select(X.round_half_even(F.lit(2.5), 0)).first()[0] == 2.0


def test_gap_label(spark):
    cases = {-2.9: "agree", -3.0: "main_higher", 3.0: "fair_higher", 0.0: "agree"}
    df = spark.createDataFrame([(k,) for k in cases], "g double")
    assert {r[0]: r[1] for r in df.select("g", X.gap_label("g")).collect()} == cases


def test_finite_and_safe_ratio(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,)], "x double")
    assert col_values(df.select(X.finite("x").alias("f")), "f") == [None, None, 1.0]
    df2 = spark.createDataFrame([(10.0, -1.0), (10.0, 4.0)], "a double, b double")
    assert col_values(df2.select(X.safe_ratio("a", "b").alias("r")), "r") == [None, 2.0]


def test_flag_and_map_codes(spark):
    df = spark.createDataFrame([(1,), (3,), (None,), (9,)], "a int")
    assert col_values(df.select(X.flag("a", [1, 2]).alias("f")), "f") == [1, 0, 0, 0]
    out = col_values(df.select(X.map_codes("a", {1: "one", 3: "three"}).alias("m")), "m")
    assert out == ["one", "three", None, None]
    out = col_values(df.select(X.map_codes("a", {1: "one"}, fallback_to_code=True).alias("m")), "m")
    assert out == ["one", "3", None, "9"]


def test_normalize_na_exact_tokens(spark):
    df = spark.createDataFrame([("NA",), ("na",), ("",), ("Exempt",), ("nan",), ("-",)], "s string")
    out = col_values(normalize_na(df), "s")
    assert out == [None, "na", None, "Exempt", None, "-"]
