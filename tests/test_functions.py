"""Column functions, above all where engines differ on nulls, ties and text."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import d
from pyspark.sql import functions as F

from tallyward import functions as fn


def one(spark, col, **values):
    """Value of a column over one row of literals."""
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return df.select(col.alias("x")).first().x


def text(spark, col, value):
    schema = "c string"
    return spark.createDataFrame([(value,)], schema).select(col.alias("x")).first().x


C = F.col("c")


@pytest.mark.parametrize(
    ("value", "want"),
    [(0.5, 0.0), (1.5, 2.0), (2.5, 2.0), (-2.5, -2.0), (3.4999, 3.0)],
)
def test_whole_numbers_round_to_even(spark, value, want):
    assert one(spark, fn.round_half_even(C), c=value) == want


def test_two_places(spark):
    assert one(spark, fn.round_half_even(C, 2), c=0.125) == 0.12
    assert one(spark, fn.round_half_even(C, 2), c=0.375) == 0.38


def test_ratio_of_nothing_is_null(spark):
    assert one(spark, fn.ratio(C, F.lit(0)), c=3) is None
    assert one(spark, fn.percent(F.lit(1), C), c=8) == 12.0


@pytest.mark.parametrize(("value", "want"), [("a", True), ("z", False), (None, False)])
def test_membership_is_never_null(spark, value, want):
    assert text(spark, fn.is_in(C, ["a", "b"]), value) is want


@pytest.mark.parametrize(
    ("value", "want"), [("Yes, partly", True), ("No", False), ("yes", False), (None, False)]
)
def test_baseline_flag_is_never_null(spark, value, want):
    assert text(spark, fn.not_null_and_prefix(C, "Yes"), value) is want


def test_first_match_ignores_unknown_conditions(spark):
    rules = [(C > "m", "late"), (C.isNull(), "none")]
    assert text(spark, fn.first_match(rules, "early"), None) == "none"
    assert text(spark, fn.first_match(rules, "early"), "a") == "early"
    assert text(spark, fn.first_match([], "only"), "a") == "only"


def test_unknown_or_true_is_true(spark):
    assert text(spark, (C == "a") | F.lit(True), None) is True


def test_row_counts_read_missing_as_not_done(spark):
    flags = spark.createDataFrame(
        [(True, None, False)], "a boolean, b boolean, c boolean"
    )
    cols = [F.col(c) for c in "abc"]
    assert flags.select(fn.count_done(cols)).first()[0] == 1
    assert flags.select(fn.all_true(cols)).first()[0] is False
    assert flags.select(fn.all_true(cols[:2])).first()[0] is None


def test_recode(spark):
    assert text(spark, fn.recode(C, {"a": "A"}), "b") is None
    assert text(spark, fn.recode(C, {"a": "A"}, F.upper(C)), "b") == "B"
    assert text(spark, fn.recode(C, {"a": None}, F.lit("other")), "a") == "other"
    assert text(spark, fn.recode(C, {}, F.lit("x")), "a") == "x"
    assert text(spark, fn.recode(C, {"a": "A"}, F.lit("x")), None) == "x"


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("2017-03-05", "2017-03-05"),
        ("2017-3-5", "2017-03-05"),
        ("03/05/2017", None),
        ("2017-13-05", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, value, want):
    assert text(spark, fn.parse_date(C), value) == d(want)


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("2018-03-10 09:05", dt.datetime(2018, 3, 10, 9, 5)),
        ("2018-3-10 9:05", dt.datetime(2018, 3, 10, 9, 5)),
        ("2018-03-10", None),
        ("soon", None),
        (None, None),
    ],
)
def test_datetimes(spark, value, want):
    assert text(spark, fn.parse_datetime(C), value) == want


def test_months(spark):
    for value, key, label in (
        ("2018-03-31", "2018-03", "Mar 2018"),
        ("2018-04-01", "2018-04", "Apr"),
        (None, "NA-NA", None),
    ):
        day = C.cast("date")
        assert text(spark, fn.month_key(day), value) == key
        assert text(spark, fn.month_label(day), value) == label


def test_date_parts(spark):
    parts = fn.date_parts(C.cast("timestamp"))
    got = [text(spark, parts[p], "2018-03-05 07:08:09") for p in ("year", "month", "day", "time")]
    assert got == ["2018", "03", "05", "07:08:09"]


def test_date_in_words(spark):
    assert text(spark, fn.date_text(C.cast("date")), "2019-03-01") == "March 01, 2019"


def test_days_between(spark):
    assert text(spark, fn.days_between(F.lit(d("2018-03-05")), C.cast("date")), "2018-02-28") == 5


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("Enrollment/Day 1", "Day 1"),
        ("Day 5 only", "Day 5"),
        ("Enrollment/Day 1 only", "Day 1 only"),
        ("two\nlines only only", "two\nlines only"),
        ("Day 3", "Day 3"),
        (None, None),
    ],
)
def test_remove_first_match_only(spark, value, want):
    assert text(spark, fn.remove_first(C, "Enrollment/| only"), value) == want


def test_replace_first_takes_the_replacement_literally(spark):
    assert text(spark, fn.replace_first(C, " in ", ", "), "Died in bed in town") == (
        "Died, bed in town"
    )
    assert text(spark, fn.replace_first(C, "x", "$1\\"), "axbx") == "a$1\\bx"


@pytest.mark.parametrize(
    ("value", "want"),
    [("12 Month Assessment", 12), ("1 Month Phone Call", 1), ("12Month", None), ("x 1 ", None),
     (None, None), ("99999999999 Month", None)],
)
def test_leading_integer(spark, value, want):
    assert text(spark, fn.leading_integer(C), value) == want


def test_missing_text_prints_as_na(spark):
    assert text(spark, fn.as_text(C), None) == "NA"


@pytest.mark.parametrize(
    ("value", "want"), [("PT-Test1", True), ("TEST9", True), ("PT-1", False), (None, False)]
)
def test_contains_any_case(spark, value, want):
    assert text(spark, fn.contains_any_case(C, "test"), value) is want


CUTS = ((">", 0.90, "Excellent"), (">", 0.80, "Okay"))


@pytest.mark.parametrize(
    ("value", "want"),
    [
        (0.95, "Excellent"), (0.90, "Okay"), (0.80, "Uh-oh"), (float("nan"), "Uh-oh"),
        (None, "Uh-oh"),
    ],
)
def test_bands(spark, value, want):
    df = spark.createDataFrame([(value,)], "c double")
    assert df.select(fn.threshold_band(C, CUTS, "Uh-oh")).first()[0] == want


def test_alerts(spark):
    df = spark.createDataFrame([(v,) for v in (79.0, 80.0, 16.0, 21.0, 15.0, None)], "c double")
    got = [tuple(r) for r in df.select(fn.alert_below(C, 80), fn.alert_above(C, 20, 15)).collect()]
    assert got == [
        ("warn", "bad"), ("ok", "bad"), ("warn", "warn"), ("warn", "bad"), ("warn", "ok"),
        (None, None),
    ]


def test_number_text(spark):
    assert one(spark, fn.thousands(C), c=1234567) == "1,234,567"
    assert one(spark, fn.percent_text(C), c=0.985) == "98%"
    assert one(spark, fn.percent_text(C), c=1.0) == "100%"


def test_filled(spark):
    assert text(spark, fn.filled(C, "no", F.lit(True)), None) == "no"
    assert text(spark, fn.filled(C, "no", F.lit(None).cast("boolean")), None) is None
    assert text(spark, fn.filled(C, "no", F.lit(True)), "yes") == "yes"
