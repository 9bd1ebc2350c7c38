import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sitewell.functions import exprs
from sitewell.functions.names import normalize_columns, raw_table, snake
from tests.conftest import rows


@pytest.mark.parametrize("given_name, wanted", [
    ("ClinicNum", "clinic_num"), ("Date of Service", "date_of_service"), ("Patient #", "patient_no"),
    ("RECORDNO", "recordno"), ("OrgLevel1", "org_level1"), ("PatGUID", "pat_guid"), ("ADACode", "adacode"),
    ("Date", "date_col"), ("order", "order_col"), ("utm_source", "utm_source"), (" a  b ", "a_b"), ("a#b", "a_nob"),
    ("#1A", "no1_a"), ("__x__", "x")])
def test_snake(given_name, wanted):
    assert snake(given_name) == wanted


@given(st.text(alphabet="abAB09 _#-", max_size=12))
def test_snake_is_stable(name):
    once = snake(name)
    assert snake(once) in (once, once + "_col") or once.endswith("_col")


def test_raw_table_and_collisions(spark):
    assert raw_table("pms_open_dental", "procedures") == "pms_open_dental__procedures"
    with pytest.raises(ValueError, match="a_b"):
        normalize_columns(spark.createDataFrame([(1, 2)], "`A B` int, `a-b` int"))


@pytest.mark.parametrize("text, kind, wanted", [
    ("2025-04-01", "iso", (2025, 4, 1)), ("2025-04-01T00:00:00Z", "iso_prefix", (2025, 4, 1)),
    ("5-Mar-2025", "day_mon_year", (2025, 3, 5)), ("05-Mar-2025", "day_mon_year", (2025, 3, 5)),
    ("3/5/2025", "slash_mdy", (2025, 3, 5)), ("20250305", "compact_ymd", (2025, 3, 5)),
    ("03-05-2025", "dash_mdy", (2025, 3, 5)), ("03/05/2025", "slash_or_iso", (2025, 3, 5)),
    ("2025-03-05", "slash_or_iso", (2025, 3, 5)), ("202503", "period", (2025, 3, 1))])
def test_parse_date(spark, text, kind, wanted):
    df = spark.createDataFrame([(text,)], "t string").select(exprs.parse_date("t", kind).alias("d"))
    assert df.first()["d"] == dt.date(*wanted)


def test_bad_text_fails(spark):
    with pytest.raises(PySparkException):
        spark.createDataFrame([("12x",)], "t string").select(exprs.amount("t")).collect()
    with pytest.raises(PySparkException):
        spark.createDataFrame([("2025-13-01",)], "t string").select(exprs.parse_date("t", "iso")).collect()


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 9),)], "d date")  # a Sunday
    got = df.select(exprs.week_of("d").alias("w"), exprs.month_of("d").alias("m"), exprs.month_text("d").alias("t"),
                    exprs.shift_month_text(exprs.month_text("d"), 11).alias("later"),
                    exprs.months_apart("d", F.lit("2024-12-31").cast("date")).alias("apart")).first()
    assert tuple(got) == (dt.date(2025, 3, 3), dt.date(2025, 3, 1), "2025-03", "2026-02", 3)


def test_ratio_and_words(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 4, "b"), (None, 4, "c")], "x int, y int, w string")
    got = rows(df.select("w", exprs.ratio("x", "y").alias("r"), exprs.words_to("w", {"a": "A"}).alias("v"),
                         exprs.words_to("w", {"a": "A"}, "other").alias("o")))
    assert got == [{"w": "a", "r": None, "v": "A", "o": "A"}, {"w": "b", "r": 0.25, "v": None, "o": "other"},
                   {"w": "c", "r": None, "v": None, "o": "other"}]


def test_pseudonyms(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c")], "s string, p string")
    plain = [r[0] for r in df.select(exprs.pseudonym("s", "p")).collect()]
    salted = [r[0] for r in df.select(exprs.salted_pseudonym("x", "s", "p")).collect()]
    assert plain[0] == plain[1] and salted[0] != salted[1]


def test_rounded(spark):
    df = spark.createDataFrame([(1.005, 2.345, "t")], "a double, b double, c string")
    assert tuple(exprs.rounded(df, 2, {"b": 0}).first()) == (1.01, 2.0, "t")
