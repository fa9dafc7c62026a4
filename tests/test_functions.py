from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from trialguard import functions as E


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("text", "ok"),
    [
        ("2025-01-31", True), ("2024-02-29", True), ("2025-02-29", False), ("2025-13-45", False),
        ("2025-2-3", False), ("2025-01-01\n", False), ("01/02/2025", False), ("0000-01-01", False),
        ("9999-12-31", True), ("", False), (None, False),
    ],
)
def test_iso_date(spark, text, ok):
    assert (one(spark, E.iso_date, text) is not None) == ok


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("30", 30.0), ("-2.5", -2.5), (".5", 0.5), ("5.", 5.0), ("+7", 7.0), ("1e3", 1000.0),
        ("<5", None), ("1d", None), ("1.0f", None), ("1_000", None), ("1e400", None), ("inf", None),
        ("nan", None), ("", None), (" 5", None), ("0x10", None),
    ],
)
def test_to_number(spark, text, value):
    assert one(spark, E.to_number, text) == value


@pytest.mark.parametrize(("text", "grade"), [("3", 3), ("3.0", 3), ("2.5", None), ("9", None), ("", None), ("0", None)])
def test_toxicity_grade(spark, text, grade):
    assert one(spark, E.toxicity_grade, text) == grade


def test_terminology_maps(spark):
    assert one(spark, E.sex_term, "Male") == "M"
    assert one(spark, E.sex_term, "female") == "F"
    assert one(spark, E.sex_term, "Q") is None
    assert one(spark, E.yes_no, "Yes") == "Y"
    assert one(spark, E.yes_no, "0") == "N"
    assert one(spark, E.yes_no, "maybe") is None
    assert one(spark, E.race_upper, "") == "NOT REPORTED"


def test_study_day_has_no_day_zero(spark):
    df = spark.createDataFrame(
        [("2025-01-08",), ("2025-01-09",), ("2025-01-10",), ("2025-01-11",), (None,)], "d string"
    ).select(E.study_day(F.col("d").cast("date"), F.lit("2025-01-10").cast("date")).alias("dy"))
    assert [r["dy"] for r in df.collect()] == [-2, -1, 1, 2, None]


def test_range_indicator_and_age_group(spark):
    df = spark.createDataFrame([(5.0, 7.0, 56.0), (60.0, 7.0, 56.0), (30.0, 7.0, 56.0), (30.0, None, 56.0)], "v double, lo double, hi double")
    got = [r[0] for r in df.select(E.range_indicator("v", "lo", "hi")).collect()]
    assert got == ["LOW", "HIGH", "NORMAL", ""]
    ages = spark.createDataFrame([(44,), (45,), (64,), (65,)], "a int")
    label, code = E.age_group("a")
    assert [tuple(r) for r in ages.select(label, code).collect()] == [("<45", 1), ("45-64", 2), ("45-64", 2), (">=65", 3)]


def test_n_pct_and_fixed(spark):
    df = spark.createDataFrame([(3, 12), (0, 0), (1, 16), (5, 8)], "n long, d long")
    assert [r[0] for r in df.select(E.n_pct("n", "d")).collect()] == ["3 (25.0%)", "0", "1 (6.2%)", "5 (62.5%)"]
    half = spark.createDataFrame([(40.5,), (41.5,), (None,)], "x double")
    assert [r[0] for r in half.select(E.fixed("x", 0)).collect()] == ["40", "42", "nan"]


def _wilson(spark, x, n):
    lo, hi = E.wilson(F.lit(x), F.lit(n))
    return spark.range(1).select(lo, hi).first()


def test_wilson_known_values(spark):
    lo, hi = _wilson(spark, 0, 10)
    assert lo == 0.0 and hi == pytest.approx(0.2775, abs=1e-4)
    lo, hi = _wilson(spark, 81, 263)
    assert lo == pytest.approx(0.2553, abs=1e-4) and hi == pytest.approx(0.3662, abs=1e-4)
    assert tuple(_wilson(spark, 0, 0)) == (None, None)
    with pytest.raises(Exception, match="between 0 and n"):
        _wilson(spark, 5, 3)


def test_newcombe_matches_published_example(spark):
    d, lo, hi = spark.range(1).select(*E.newcombe_diff(F.lit(56), F.lit(70), F.lit(48), F.lit(80))).first()
    assert d == pytest.approx(0.2)
    assert lo == pytest.approx(0.0524, abs=1e-4) and hi == pytest.approx(0.3339, abs=1e-4)
    row = spark.range(1).select(*E.newcombe_diff(F.lit(1), F.lit(0), F.lit(1), F.lit(1))).first()
    assert all(v is None or math.isnan(v) for v in row)


def test_transport_projection(spark):
    df = spark.createDataFrame([("2025-01-01", True, 3, None)], "d string, b boolean, n int, s string").select(
        F.col("d").cast("date").alias("TRTSDT"), F.col("b").alias("FLAG"), F.col("n").alias("AGE"), F.col("s").alias("SEX")
    )
    out = E.for_transport(df)
    row = out.first()
    import datetime as dt

    assert row["TRTSDT"] == float((dt.date(2025, 1, 1) - dt.date(1960, 1, 1)).days) and row["FLAG"] == "Y" and row["AGE"] == 3.0 and row["SEX"] == ""
    meta = {f.name: f.metadata for f in out.schema.fields}
    assert meta["TRTSDT"]["format"] == "DATE9" and meta["AGE"]["label"] == "Age"
