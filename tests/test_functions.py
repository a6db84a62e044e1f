"""Scalar rules, one row per trap."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicmart.functions import dates as FD
from civicmart.functions import rules as FR
from civicmart.functions import text as FT


def apply(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").coalesce(1)
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("x"))).collect()]


def test_keys_and_blanks(spark):
    values = [" nypd ", None, "  ", "HPD"]
    assert apply(spark, values, FT.norm_key) == ["NYPD", None, "", "HPD"]
    assert apply(spark, values, FT.blank_key) == ["nypd", "", "", "HPD"]
    assert apply(spark, values, FT.is_blank) == [False, True, True, False]


def test_both_date_forms_read_and_others_are_null(spark):
    values = ["2024-05-20T07:14:00.000", "01/15/2024 08:23:45 PM", "12/31/2023 12:00:00 AM", "not a date", "13/45/2024 01:00:00 AM", None, ""]
    assert apply(spark, values, FD.parse_ts) == [
        dt.datetime(2024, 5, 20, 7, 14), dt.datetime(2024, 1, 15, 20, 23, 45), dt.datetime(2023, 12, 31), None, None, None, None,
    ]


def test_coordinates(spark):
    values = ["40.694907", "0", "", "n/a", " -73.5 ", None]
    assert apply(spark, values, FD.parse_coord) == [
        Decimal("40.694907"), Decimal("0.000000"), None, None, Decimal("-73.500000"), None,
    ]


def test_resolution_counts_midnights(spark):
    rows = spark.createDataFrame(
        [("2024-01-01T23:59:00", "2024-01-02T00:01:00"), ("2024-01-01T00:00:00", "2024-01-01T23:59:59"), ("2024-01-01T00:00:00", None)],
        "a string, b string",
    ).coalesce(1)
    days = rows.select(FD.resolution_days(FD.parse_ts(F.col("a")), FD.parse_ts(F.col("b"))))
    assert [r[0] for r in days.collect()] == [1, 0, None]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.lists(st.dates(dt.date(1990, 1, 1), dt.date(2040, 12, 31)), min_size=1, max_size=30))
def test_us_week_against_calendar_rule(spark, days):
    def week(d):
        first = dt.date(d.year, 1, 1)
        lead = (first.weekday() + 1) % 7  # days of week 1 that belong to the year before
        return ((d - first).days + lead) // 7 + 1

    assert apply(spark, days, FD.us_week, "date") == [week(d) for d in days]


def test_year_end_is_week_53(spark):
    assert apply(spark, [dt.date(2024, 12, 31)], FD.us_week, "date") == [53]


def test_status_words(spark):
    values = ["closed", " Resolved ", "opened", "ON HOLD", "in-progress", "Started", "dispatched", None, " ", "unspecified", "UNSPECIFIED ", " Unspecified", "Bogus"]
    mapped = apply(spark, values, FR.normalise_status)
    assert mapped == [
        "Closed", "Closed", "Open", "Pending", "In Progress", "In Progress", "Assigned", "Unspecified", "Unspecified",
        "Unspecified", "Unspecified", " Unspecified", "Bogus",
    ]
    assert apply(spark, mapped, FR.valid_status) == [True] * 11 + [False, False]


@pytest.mark.parametrize(
    "text, category, legacy",
    [
        ("Noise - Vehicle", "Noise", "Noise"),
        ("illegal parking", "Vehicle", "Vehicle"),
        ("PAINT/PLASTER", "Housing", "Housing"),
        ("Street Light Condition", "Infrastructure", "Infrastructure"),
        ("WATER SYSTEM", "Infrastructure", "Housing"),
        ("Damaged Tree", "Environment", "Environment"),
        ("Fire Safety", "Safety", "Other"),
        ("HEATED STREET LIGHT", "Housing", "Housing"),
        ("Graffiti", "Other", "Other"),
    ],
)
def test_first_keyword_wins(spark, text, category, legacy):
    assert apply(spark, [text], lambda c: FR.categorise(c, FR.CATEGORY_RULES)) == [category]
    assert apply(spark, [text], lambda c: FR.categorise(c, FR.LEGACY_CATEGORY_RULES)) == [legacy]


def test_agency_lookup(spark):
    rows = spark.createDataFrame([("NYPD", "x"), ("ZZZ", " Zed "), ("QQQ", None)], "c string, n string").coalesce(1)
    names = rows.select(
        FR.agency_name(F.col("c"), F.col("n"), FR.AGENCY_NAMES), FR.sla_days(F.col("c"), FR.AGENCY_SLA_DAYS, 10)
    ).collect()
    assert [tuple(r) for r in names] == [("New York City Police Department", 2), ("Zed", 10), ("QQQ", 10)]


def test_buckets_and_bands(spark):
    days = [None, 0, 3, 4, 7, 8, 30, 31]
    assert apply(spark, days, FR.resolution_bucket, "int") == [
        "Open", "Same Day", "1-3 Days", "4-7 Days", "4-7 Days", "8-30 Days", "8-30 Days", "Over 30 Days",
    ]
    assert apply(spark, ["Same Day", "Open", "?"], FR.resolution_bucket_sort) == [1, 6, 99]
    ages = [None, 30, 31, 90, 180, 365, 366]
    assert apply(spark, ages, FR.aging_sort, "int") == [1, 1, 2, 2, 3, 4, 5]
    assert apply(spark, [None, 366], FR.aging_bucket, "int") == ["0–30 days", "Over 365 days"]
    breach = spark.createDataFrame([(3, 2), (2, 2), (None, 2)], "d int, s int").coalesce(1)
    assert [r[0] for r in breach.select(FR.is_sla_breach(F.col("d"), F.col("s"))).collect()] == [1, 0, 0]


def test_title_case(spark):
    assert apply(spark, ["  heat/HOT  water ", "", None, "o'neill ST"], FT.pascal_case) == [
        "Heat/hot Water", None, None, "O'neill St",
    ]


def test_number_texts(spark):
    assert apply(spark, [1234567.0, 1235.0, 12.0, -1500.0, None], FT.fmt_magnitude, "double") == [
        "1.23M", "1.24K", "12.00", "-1.50K", None,
    ]
    assert apply(spark, [0.125, None], FT.fmt_days, "double") == ["0.13 Days", " Days"]
    assert apply(spark, [1234567], FT.fmt_thousands, "bigint") == ["1,234,567"]
    assert apply(spark, [0.0761], FT.fmt_percent, "double") == ["7.6%"]
    assert apply(spark, [dt.date(2024, 3, 5)], FT.fmt_month_day_year, "date") == ["Mar 05, 2024"]


def test_safe_division(spark):
    rows = spark.createDataFrame([(1, 2), (1, 0), (None, 2)], "a int, b int").coalesce(1)
    assert [r[0] for r in rows.select(FT.safe_div(F.col("a"), F.col("b"))).collect()] == [0.5, None, None]


def test_calendar_row(spark):
    row = spark.range(1).select(*FD.calendar_columns(F.lit("2024-02-04").cast("date"))).first()
    assert tuple(row) == (
        20240204, dt.date(2024, 2, 4), 2024, 1, "Q1", 2, "February", "Feb", 6, 4, 1, "Sunday", True, False,
    )
